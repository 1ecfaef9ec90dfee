"""Writing, reading back and gating, over the rows of the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver.star_queries import money
from driver.tables import read
from finloom import functions as fn
from finloom.operators import checks
from finloom.operators.evolve import SchemaMismatch
from finloom.operators.writer import write_table
from finloom.sources.location import Location, passing_folder

PERIOD = "fiscal_year_period_nbr"


def booked(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", money("o_totalprice").alias("order_amt"),
        fn.period_of_date(F.col("o_orderdate")).alias(PERIOD))


def per_period(orders: DataFrame) -> DataFrame:
    return orders.groupBy(PERIOD).agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("o_orderkey").alias("order_count"),
        F.sum("order_amt").cast("decimal(38,2)").alias("order_amt"))


def written_and_read(spark: SparkSession, sf: str, place: Location) -> DataFrame:
    """Open orders replace what an earlier run left, closed ones are appended; both partitioned by period."""
    orders = booked(spark, sf)
    write_table(orders.limit(1), place, "orders", "overwrite", [PERIOD])
    write_table(orders.where("o_orderstatus <=> 'O'"), place, "orders", "overwrite", [PERIOD])
    write_table(orders.where("not o_orderstatus <=> 'O'"), place, "orders", "append", [PERIOD])
    return per_period(place.read(spark, "orders"))


def dataset_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """By path, in the cluster's shared folder."""
    place = passing_folder(spark, "round-trip")
    return written_and_read(spark, sf, place).withColumn("found", F.lit(place.exists(spark, "orders"))).withColumn(
        "absent", F.lit(place.exists(spark, "no_such_table")))


def catalog_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """By catalog table, in a schema of its own that is dropped again; the report is one row per period."""
    place = Location(schema=f"finloom_{uuid.uuid4().hex}")
    place.ensure(spark)
    try:
        report = written_and_read(spark, sf, place).withColumn("found", F.lit(place.exists(spark, "orders"))).withColumn(
            "absent", F.lit(place.exists(spark, "no_such_table")))
        kept = passing_folder(spark, "catalog-report")
        write_table(report, kept, "report")
        return kept.read(spark, "report")
    finally:
        spark.sql(f"DROP SCHEMA {place.schema} CASCADE")


ROUND_TRIP_SQL = """SELECT (year(o_orderdate) * 100 + month(o_orderdate))::INTEGER AS fiscal_year_period_nbr,
  count(*) AS row_count, count(DISTINCT o_orderkey) AS order_count,
  sum(o_totalprice::DECIMAL(18,2))::DECIMAL(38,2) AS order_amt, true AS found, false AS absent
FROM orders GROUP BY 1"""


def evolving_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A table that takes on columns and wider types, refuses what does not fit, and has slices written again.

    Years count by the order's date. Orders to 1993 come with 32-bit keys and amounts of two places, later ones with
    64-bit keys, four places and a priority; 1995 is written twice more, the second time as the first.
    """
    place = passing_folder(spark, "evolving")
    orders = read(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", money("o_totalprice").alias("order_amt"),
        F.year("o_orderdate").alias("order_yr"))
    late = F.coalesce(F.col("order_yr") > 1993, F.lit(True))
    write_table(orders.where(~late).select(F.col("o_orderkey").cast("int").alias("o_orderkey"),
                                           F.col("order_amt").cast("decimal(12,2)").alias("order_amt"), "order_yr"),
                place, "orders", "overwrite", ["order_yr"])
    newer = orders.where(late).withColumn("order_amt", F.col("order_amt").cast("decimal(20,4)"))
    refused = []
    for rows, ways in ((newer, ()), (newer, ("add",)), (newer.withColumn("order_yr", F.lit("x")), ("add", "widen")),
                       (newer.withColumn("o_orderkey", F.lit("x")), ("add", "widen")),
                       (newer.drop("o_orderkey"), ("add", "widen"))):
        try:
            write_table(rows, place, "orders", "append", ["order_yr"], evolve=ways)
        except SchemaMismatch as error:
            refused.append(str(error))
    write_table(newer, place, "orders", "append", ["order_yr"], evolve=("add", "widen"))
    slice_ = newer.where("order_yr = 1995").withColumn("order_amt", F.col("order_amt") * 2)
    for _ in range(2):
        write_table(slice_.withColumn("order_amt", F.col("order_amt").cast("decimal(20,4)")), place, "orders", "slices")
    found = place.read(spark, "orders")
    types = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    return found.groupBy("order_yr").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("o_orderkey").alias("order_count"),
        F.count("o_orderpriority").alias("priority_count"),
        F.sum("order_amt").cast("decimal(38,4)").alias("order_amt")).select(
        "*", F.lit(types["o_orderkey"]).alias("key_type"), F.lit(types["order_amt"]).alias("amount_type"),
        F.lit(len(refused)).alias("refused"))


EVOLVING_SQL = """SELECT year(o_orderdate)::INTEGER AS order_yr, count(*) AS row_count,
  count(DISTINCT o_orderkey) AS order_count,
  count(o_orderpriority) FILTER (coalesce(year(o_orderdate) > 1993, true)) AS priority_count,
  sum(o_totalprice::DECIMAL(18,2) * CASE WHEN year(o_orderdate) = 1995 THEN 2 ELSE 1 END)::DECIMAL(38,4) AS order_amt,
  'bigint' AS key_type, 'decimal(20,4)' AS amount_type, 5 AS refused
FROM orders GROUP BY 1"""


def gate_report(spark: SparkSession, sf: str) -> DataFrame:
    """What the gate says to a sound report, one with failures and one with checks it could not run."""
    tables = {name: read(spark, sf, name) for name in ("nation", "region", "lineitem", "orders")}
    reports = {
        "sound": checks.integrity_report(spark, tables, {"nation": ("n_nationkey",)},
                                         [("nation", "n_regionkey", "region", "r_regionkey")]),
        "failing": checks.integrity_report(spark, tables, {"lineitem": ("l_orderkey",), "nation": ("n_nationkey",)}, ()),
        "skipped": checks.integrity_report(spark, tables, {"nation": ("n_nationkey",), "absent": ("id",)}, ()),
    }
    parts = []
    for name, report in reports.items():
        stopped = {}
        for skipped_ok in (False, True):
            try:
                checks.require_ok(report, skipped_ok=skipped_ok)
                stopped[skipped_ok] = False
            except checks.IntegrityError:
                stopped[skipped_ok] = True
        parts.append(report.select(F.lit(name).alias("report_nm"), "table_name", "row_count", "failures", "status",
                                   F.lit(stopped[False]).alias("stops"), F.lit(stopped[True]).alias("stops_leniently")))
    return checks.union_reports(parts)


GATE_SQL = """WITH n AS (SELECT count(*) AS n, count(DISTINCT n_nationkey) AS d FROM nation),
l AS (SELECT count(*) AS n, count(DISTINCT l_orderkey) AS d FROM lineitem),
o AS (SELECT count(*) AS n, count(*) FILTER (r_regionkey IS NULL) AS d
      FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
c AS (
  SELECT 'sound' AS report_nm, 'nation' AS table_name, n AS row_count, n - d AS failures FROM n
  UNION ALL SELECT 'sound', 'nation', n, d FROM o
  UNION ALL SELECT 'failing', 'lineitem', n, n - d FROM l
  UNION ALL SELECT 'failing', 'nation', n, n - d FROM n
  UNION ALL SELECT 'skipped', 'nation', n, n - d FROM n
  UNION ALL SELECT 'skipped', 'absent', NULL, NULL)
SELECT report_nm, table_name, row_count::BIGINT AS row_count, failures::BIGINT AS failures,
  CASE WHEN failures IS NULL THEN 'skipped' WHEN failures = 0 THEN 'ok' ELSE 'failed' END AS status,
  bool_or(failures IS NULL OR failures > 0) OVER (PARTITION BY report_nm) AS stops,
  bool_or(coalesce(failures, 0) > 0) OVER (PARTITION BY report_nm) AS stops_leniently FROM c"""


def dataset_queries() -> dict[str, tuple[Callable, str]]:
    return {
        "dataset_round_trip": (dataset_round_trip, ROUND_TRIP_SQL),
        "catalog_round_trip": (catalog_round_trip, ROUND_TRIP_SQL),
        "evolving_round_trip": (evolving_round_trip, EVOLVING_SQL),
        "gate_report": (gate_report, GATE_SQL),
    }
