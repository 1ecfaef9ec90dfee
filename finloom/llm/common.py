"""What the corpus operators share: reading tables, cutting lineage, linking components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.sources.location import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; the file system drops it when the session ends."""
    path = shared_folder(spark, purpose).path
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(frame: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """The frame written as Parquet to the shared folder (or ``path``) and read again.

    Later steps then neither recompute it nor depend on the executors that made it. Shuffle files of the write go with
    its end: many cuts would otherwise fill the disks before the driver collects what refers to them.
    """
    spark = frame.sparkSession
    path = path or work_folder(spark, purpose)
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(frame.schema).parquet(path)


class Scratch:
    """Cuts that serve only the steps of a ``with`` block: their folders go when it ends.

    What the block hands on must be cut outside of it (by ``cut``), since nothing can be computed again afterwards.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def cut(self, frame: DataFrame, purpose: str) -> DataFrame:
        self.paths.append(work_folder(self.spark, purpose))
        return cut(frame, purpose, self.paths[-1])

    def __exit__(self, *failure) -> None:
        for path in self.paths:
            drop_folder(self.spark, path)


def fresh(frame: DataFrame, stem: str) -> str:
    """A column name that the frame does not have yet; names compare without case."""
    taken = {name.lower() for name in frame.columns}
    name, n = stem, 0
    while name.lower() in taken:
        n += 1
        name = f"{stem}_{n}"
    return name


def text_of(column: str = "text") -> Column:
    """A text with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def settled(value: Column) -> Column:
    """The value, computed once where it stands.

    Catalyst would copy a column's expression into each of its uses (into lambdas too, once per element, and into
    filters it pushes down). It leaves columns alone whose expression it can't move.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


FILTER_WORDS = 1 << 16  # longs of a filter: 512 KB


def among(values: list[Column], rows: DataFrame, keys: list[str]) -> Column:
    """True where the values are those of a row in ``rows`` (by ``keys``), and rarely elsewhere.

    A bit array of fixed size. It keeps most rows that a join would drop from its shuffle; with very many keys it keeps
    all, and the join alone decides.
    """

    def spot(columns: list[Column]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(FILTER_WORDS * 64))

    def bit(at: Column) -> Column:
        return F.pmod(at, F.lit(64)).cast("int")

    at = spot([F.col(key) for key in keys])
    words = (rows.select((at / 64).cast("int").alias("i"), bit(at).alias("b")).distinct()
             .groupBy("i").agg(F.expr("bit_or(shiftleft(1L, b))").alias("v")))
    bits = cut(array_of(words, FILTER_WORDS), "filter").scalar()
    own = spot(values)
    word = F.element_at(bits, (own / 64).cast("int") + 1)
    return F.call_function("shiftrightunsigned", word, bit(own)).bitwiseAND(F.lit(1)) == 1


def without(docs: DataFrame, values: list[Column], gone: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose values (nulls equal nulls) are not those of a row in ``gone``, which must be written.

    Only rows that may be among them are shuffled; all others stay where they are read.
    """
    likely = among(values, gone, keys)
    same = [value.eqNullSafe(gone[key]) for value, key in zip(values, keys, strict=True)]
    return docs.where(likely).join(gone, same, "left_anti").unionByName(docs.where(~likely))


def array_of(numbers: DataFrame, size: int) -> DataFrame:
    """One row with one array ``numbers``: column ``v`` by index ``i`` of at most ``size`` rows, zero where absent."""
    spark = numbers.sparkSession
    every = spark.range(size).select(F.col("id").cast("int").alias("i"))
    filled = every.join(numbers, "i", "left").select("i", F.coalesce("v", F.lit(0)).cast("long").alias("v"))
    return filled.agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("s")).select(
        F.expr("transform(s, x -> x.v)").alias("numbers"))


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """The smallest node reachable from each linked node that is not that node itself: ``node``, ``root``.

    ``links`` holds ``a`` and ``b`` (long, not null). Large and small stars alternate until the
    links no longer change: every round is two joins of the links with one row per node, so a hub
    is split like any skewed join and no group meets in one task. Rounds grow with the logarithm
    of the longest chain.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                purpose)
    before = None
    while True:
        # Large star: each node hands its smallest neighbour (or itself) to its larger neighbours.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Small star: each node hands its smallest smaller neighbour to the others and to itself.
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small_least, "a")
        edges = cut(joined.select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                    .select("e.a", "e.b").where("a <> b").distinct(), purpose)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) in (before, (0, None)):
            return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        before = tuple(state)
