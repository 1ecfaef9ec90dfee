"""Reading the driver's tables, and the key domains they stand in for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finloom.plans.tables import ROW_ID
from finloom.sources.values import DIVISION_ROWS

# Driver table whose row count is the size of each generated dimension.
DOMAIN_SOURCES = {
    "profit_center": "part",
    "cost_center_dim_v": "customer",
    "functional_area": "supplier",
    "version_forecast_mapping": "nation",
    "accounting_document_type": "nation",
    "finance_product_dim_v": "part",
    "finance_customer_dim_v": "customer",
    "company_code": "supplier",
    "copa_attribution_dim": "part",
    "geo_wholesale_value_business_dim": "supplier",
    "geo_marketplace_channel_dim": "nation",
    "gl_account_dim": "supplier",
    "gl_account_zfsm_measures_hierarchy_dim": "supplier",
    "finance_foreign_currency_exchange_rate": "customer",
}
# Domains of fixed size: the calendar's cap and the division seed.
FIXED_DOMAINS = {"calendar_fiscal_period_v": 192, "division_text": DIVISION_ROWS}
KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey",
        "part": "p_partkey", "orders": "o_orderkey", "events": "event_id"}


SCHEMAS: dict[tuple[str, str], StructType] = {}
SIZES: dict[tuple[str, str], int] = {}


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A driver table; its schema is inferred once, later reads need no job."""
    path = f"{sf}/{table}.parquet"
    if (sf, table) not in SCHEMAS:
        SCHEMAS[sf, table] = spark.read.parquet(path).schema
    return spark.read.schema(SCHEMAS[sf, table]).parquet(path)


def size(spark: SparkSession, sf: str, table: str) -> int:
    """Row count, answered from the Parquet footers; the driver's tables never change."""
    if (sf, table) not in SIZES:
        SIZES[sf, table] = read(spark, sf, table).count()
    return SIZES[sf, table]


def domain_sizes(spark: SparkSession, sf: str, needed=None) -> dict[str, int]:
    sources = {domain: source for domain, source in DOMAIN_SOURCES.items() if needed is None or domain in needed}
    counted = {source: size(spark, sf, source) for source in set(sources.values())}
    return FIXED_DOMAINS | {domain: counted[source] for domain, source in sources.items()}


def domain_sql() -> dict[str, str]:
    return {d: str(n) for d, n in FIXED_DOMAINS.items()} | {
        d: f"(SELECT count(*) FROM {source})" for d, source in DOMAIN_SOURCES.items()}


def row_ids_of(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """Row ids ``1..n`` taken from a driver table's dense key."""
    return read(spark, sf, table).select((F.col(KEYS[table]).cast("bigint") + 1).alias(ROW_ID))


def ids_sql(table: str) -> str:
    return f"SELECT {KEYS[table]}::BIGINT + 1 AS id FROM {table}"
