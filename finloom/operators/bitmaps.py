"""Exact key checks on bitmaps, for whole-number keys that lie close together.

A key is one bit in a bitmap of 32 768, so a dense key of 25 G rows travels as 3 GB of bitmaps in place of 25 G keys.
Tasks build the bitmaps of the keys they read and hand on one for each range of keys they met, so this pays where a task
reads neighbouring keys, as it does of tables written by id. Where keys lie scattered over the tasks each task meets every
range; ``bitmap_pays`` says which it is, from one look at the column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.operators.checks import INTEGRAL, UNIQUE, _report, key_check, reference_check
from finloom.operators.writer import write_table
from finloom.sources.location import passing_folder

BITMAP_BYTES = 4096
KEY_BYTES = 16  # of a key on its way through a shuffle, about


def _require_whole(df: DataFrame, column: str) -> None:
    kind = df.schema[column].dataType.simpleString()
    if kind not in INTEGRAL:
        raise TypeError(f"{column} is {kind}; a bitmap holds whole numbers")


def bucketed(df: DataFrame, column: str, *more: Column) -> DataFrame:
    """Bucket and place of each key in its bitmap; NULL keys have neither."""
    key = F.col(f"`{column}`").cast("bigint")
    return df.select(F.bitmap_bucket_number(key).alias("bucket"), F.bitmap_bit_position(key).alias("place"), *more)


def bitmap_pays(df: DataFrame, column: str) -> bool:
    """Is what the tasks would hand on as bitmaps less than their keys?"""
    _require_whole(df, column)
    met = (bucketed(df, column).where("bucket is not null").groupBy(F.spark_partition_id().alias("task"), "bucket")
           .agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("bitmaps"), F.sum("n").alias("keys")).first())
    return met["bitmaps"] * BITMAP_BYTES <= (met["keys"] or 0) * KEY_BYTES


def bitmap_key_check(df: DataFrame, table: str, key: str) -> DataFrame:
    """As ``key_check`` for one whole-number key: unique, never NULL, and there are rows."""
    _require_whole(df, key)
    counts = (bucketed(df, key).groupBy("bucket")
              .agg(F.count(F.lit(1)).alias("n"), F.bitmap_construct_agg("place").alias("keys"))
              .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                   F.coalesce(F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("keys"))), F.lit(0))
                   .alias("distinct_keys"))
              .selectExpr("row_count", "distinct_keys", "row_count - distinct_keys AS failures"))
    return _report(counts, "key", table, key, "", UNIQUE)


def bit_at(bitmap: Column, place: Column) -> Column:
    """Is the bit set?"""
    byte = F.conv(F.hex(F.substring(bitmap, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))).cast("int"), F.lit(2)) == 1


def orphan_bitmaps(fact: DataFrame, column: str, ref: DataFrame, ref_column: str) -> DataFrame:
    """Buckets with keys that have no parent: ``bucket, parents`` (bitmap) and ``orphan_keys``.

    What children and parents have together less what parents have is what only children have, so no key is joined.
    """
    _require_whole(fact, column)
    _require_whole(ref, ref_column)
    both = bucketed(fact, column, F.lit(False).alias("parent")).unionByName(
        bucketed(ref, ref_column, F.lit(True).alias("parent"))).where("bucket is not null")
    return (both.groupBy("bucket", "parent").agg(F.bitmap_construct_agg("place").alias("keys"))
            .groupBy("bucket").agg(F.bitmap_or_agg("keys").alias("either"),
                                   F.bitmap_or_agg(F.when(F.col("parent"), F.col("keys"))).alias("parents"))
            .withColumn("orphan_keys", F.bitmap_count("either") - F.bitmap_count("parents"))
            .where("orphan_keys > 0").select("bucket", "parents", "orphan_keys"))


def bitmap_reference_check(fact: DataFrame, table: str, column: str, ref: DataFrame, ref_table: str, ref_column: str,
                           nulls_are_orphans: bool = True) -> DataFrame:
    """As ``reference_check`` for whole-number keys. Runs the comparison of bitmaps at once.

    Only where that finds orphans are rows looked at again, and only those of their buckets.
    """
    spark = fact.sparkSession
    place = passing_folder(spark, "orphans")
    write_table(orphan_bitmaps(fact, column, ref, ref_column), place, "buckets")
    bad = place.read(spark, "buckets")
    keys = bucketed(fact, column).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"),
                                                       F.bitmap_construct_agg("place").alias("keys"))
    counts = keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("keys"))), F.lit(0)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col("bucket").isNull(), F.col("n"))), F.lit(0)).alias("nulls"))
    if bad.isEmpty():
        counts = counts.withColumn("unmatched", F.lit(0).cast("bigint"))
    else:
        rows = bucketed(fact, column).where("bucket is not null").groupBy("bucket", "place").agg(
            F.count(F.lit(1)).alias("n"))
        lost = rows.join(bad, "bucket").where(~bit_at(F.col("parents"), F.col("place")))
        counts = counts.crossJoin(lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unmatched")))  # one row each
    failures = "unmatched + nulls" if nulls_are_orphans else "unmatched"
    family = "foreign_key" if nulls_are_orphans else "natural_key"
    return _report(counts.selectExpr("row_count", "distinct_keys", f"{failures} AS failures"), family, table, column,
                   f"{ref_table}.{ref_column}", "failures = 0")


def checked_key(df: DataFrame, table: str, key: str) -> DataFrame:
    """The key check that moves less data."""
    whole = df.schema[key].dataType.simpleString() in INTEGRAL
    return bitmap_key_check(df, table, key) if whole and bitmap_pays(df, key) else key_check(df, table, [key])


def checked_reference(fact: DataFrame, table: str, column: str, ref: DataFrame, ref_table: str, ref_column: str,
                      nulls_are_orphans: bool = True) -> DataFrame:
    """The reference check that moves less data."""
    sides = ((fact, column), (ref, ref_column))
    pays = (all(df.schema[name].dataType.simpleString() in INTEGRAL for df, name in sides)
            and all(bitmap_pays(*side) for side in sides))
    check = bitmap_reference_check if pays else reference_check
    return check(fact, table, column, ref, ref_table, ref_column, nulls_are_orphans)
