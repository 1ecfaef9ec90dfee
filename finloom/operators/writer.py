"""Table writer: Parquet (zstd) by default, optionally partitioned."""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from finloom.operators.evolve import SchemaMismatch, fitted, stored_schema
from finloom.sources.location import Location

MODES = ("overwrite", "append", "slices")
MAX_ROWS_PER_FILE = 20_000_000

# HotSpot does not compile methods above 8000 bytes. A wide generated table
# exceeds that inside one whole-stage method and would run interpreted; with the
# limit set, Spark falls back to its split projection, which is compiled.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# A generated table is one projection: nothing to fuse it with, and its split
# form compiles faster than one whole-stage class.
BUILD_TUNING = {"spark.sql.codegen.wholeStage": "false"}


def tune_session(spark: SparkSession, shuffle_partitions: int | None = None) -> None:
    """Runtime settings for building and checking; shuffle partitions only when asked."""
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set runtime settings for one job and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def write_table(df: DataFrame, location: Location, table: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), codec: str = "zstd", table_format: str = "parquet",
                evolve: Collection[str] = (), rebalanced: bool = False) -> None:
    """Write one table.

    ``append`` adds rows; ``slices`` replaces just those partitions that the rows belong to, so writing a slice again
    leaves the table as it is. Both first fit the rows to the table's columns (``evolve``, see ``fitted``) and raise
    before anything is written where they don't. A table stored by path keeps a record of its columns, which is written
    ahead of rows that need it, so it can be read at any time; in a catalog columns can be added, not widened.

    A partitioned write first rebalances by the partition columns: each value lands in few files, and adaptive execution
    splits a value that holds a large share of the rows instead of handing it to one task. Rows that come ``rebalanced``
    stay where they are.
    """
    if mode not in MODES:
        raise ValueError(f"write mode is one of {MODES}, not {mode!r}")
    spark, parquet = df.sparkSession, table_format == "parquet"
    stored = location.find(spark, table) if parquet and mode != "overwrite" else None
    schema = stored_schema(df.schema)
    if stored is not None:
        held = location.partitioning(spark, table)
        if partition_by and held is not None and [c.lower() for c in partition_by] != [c.lower() for c in held]:
            raise SchemaMismatch(f"{table}: partitioned by {list(held)}, not {list(partition_by)}")
        partition_by = partition_by if held is None else held
        df, schema = fitted(df, stored.schema, evolve, partition_by, table)
    if mode == "slices" and not partition_by:
        raise ValueError(f"{table}: slices are partitions, and the table has none")
    if partition_by and not rebalanced:
        df = df.hint("rebalance", *partition_by)
    if stored is not None:
        location.take_on(spark, table, stored.schema, schema, partition_by)
    writer = (df.write.format(table_format).mode("overwrite" if mode == "slices" else mode)
              .option("compression", codec)
              .option("maxRecordsPerFile", MAX_ROWS_PER_FILE))
    if mode == "slices" and stored is not None:
        writer.option("partitionOverwriteMode", "dynamic")
        if location.schema is not None:
            df = df.select(*[c for c in df.columns if c not in partition_by], *partition_by)
            with session_settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):  # no option here
                df.write.mode("overwrite").insertInto(location.name(table))
            return
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if location.schema is not None:
        writer.option("overwriteSchema", "true").saveAsTable(location.name(table))
    else:
        writer.save(location.name(table))
        if parquet and stored is None:
            location.take_on(spark, table, None, schema, partition_by)
