"""Row-id sources and repeatable samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_ROWS_PER_PARTITION = 1_000_000
CELLS_PER_TASK = 1_000_000


def partitions_for(rows: int, columns: int = 1, parallelism: int = 1) -> int:
    """One partition per million rows; a smaller wide table is spread over the cores it can keep busy."""
    by_rows = -(-rows // TARGET_ROWS_PER_PARTITION)
    by_cells = -(-rows * columns // CELLS_PER_TASK)
    return max(1, by_rows, min(parallelism, by_cells))


def row_ids(spark: SparkSession, rows: int, partitions: int | None = None, name: str = "__row_id",
            columns: int = 1) -> DataFrame:
    """The ids ``1..rows``; partitions follow the size of the table unless given."""
    parts = partitions or partitions_for(rows, columns, spark.sparkContext.defaultParallelism)
    return spark.range(1, rows + 1, 1, parts).withColumnRenamed("id", name)


def dealt(ids: DataFrame, rows: int, columns: int = 1, name: str = "__row_id") -> DataFrame:
    """Given ids over as many partitions as ``row_ids`` would make for them.

    Ids read from files are few bytes, so the files' partitions are too few for a wide table. Only the ids move.
    """
    parts = partitions_for(rows, columns, ids.sparkSession.sparkContext.defaultParallelism)
    return ids.repartition(parts, name) if parts > 1 else ids


def bucket_count(total_rows: int, wanted_rows: int) -> int:
    """How many hash buckets leave about ``wanted_rows`` in each."""
    return max(1, total_rows // max(1, wanted_rows))


def hash_sample(table: DataFrame, keys: list[str], buckets: int, seed: int = 42) -> DataFrame:
    """One hash bucket out of ``buckets``.

    The same rows on every scan, spread over all partitions and without a
    shuffle, where a LIMIT funnels through one task and may differ per scan.
    """
    if buckets <= 1:
        return table
    marker = F.lit(seed).cast("bigint")
    draw = F.shiftrightunsigned(F.xxhash64(marker, *[F.col(k) for k in keys]), 1)
    return table.where(draw % buckets == 0)
