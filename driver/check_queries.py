"""Integrity and conformance checks over the driver tables, passing and failing cases alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver.generated import SHOWCASE, project
from driver.oracle import Rendering, stream_ctes, table_ctes
from driver.tables import KEYS, domain_sql, ids_sql, read, row_ids_of, size
from finloom import functions as fn
from finloom.operators import bitmaps, checks, conformance, estimates
from finloom.plans import specs as s
from finloom.plans.tables import ROW_ID, TABLES
from finloom.sources.contract import Contract, ContractColumn
from finloom.sources.rows import bucket_count, hash_sample

ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations")
REFERENCES = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("labels", "doc_id", "documents", "doc_id"),
)
CORPUS_KEYS = {"documents": ("doc_id",), "embeddings": ("vec_id",), "pages": ("page_id",), "benchmark": ("item_id",),
               "labels": ("doc_id",), "conversations": ("conv_id", "turn")}
TABLE_KEYS = {table: (key,) for table, key in KEYS.items()} | {"lineitem": ("l_orderkey", "l_linenumber")} | CORPUS_KEYS
REPORT_TAIL = """CASE WHEN row_count = 0 THEN 'empty' WHEN {ok} THEN 'ok' ELSE 'failed' END AS status, {ok} AS ok"""


# Keys ---------------------------------------------------------------------------------------------------------

def keyed(spark: SparkSession, sf: str) -> list[tuple[str, DataFrame, tuple[str, ...]]]:
    found = [(table, read(spark, sf, table), keys) for table, keys in TABLE_KEYS.items()]
    late = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("open_key")
    found.append(("orders_null_key", read(spark, sf, "orders").select(late), ("open_key",)))
    found.append(("events_refund", read(spark, sf, "events").where("event_type = 'refund'"), ("event_id",)))
    return found


def pk_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    return checks.run_checks(spark, [checks.KeyCheck(table, df, keys) for table, df, keys in keyed(spark, sf)])


def key_part(table: str, source: str, keys: tuple[str, ...]) -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (f"SELECT 'key' AS family, '{table}' AS table_name, '{','.join(keys)}' AS column_name, '' AS reference, "
            f"coalesce(sum(n), 0)::BIGINT AS row_count, count(*) FILTER ({present})::BIGINT AS distinct_keys "
            f"FROM (SELECT {', '.join(keys)}, count(*) AS n FROM ({source}) GROUP BY ALL)")


def pk_uniqueness_sql() -> str:
    parts = [key_part(table, f"SELECT {', '.join(keys)} FROM {table}", keys) for table, keys in TABLE_KEYS.items()]
    parts.append(key_part("orders_null_key", "SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS open_key FROM orders",
                          ("open_key",)))
    parts.append(key_part("events_refund", "SELECT event_id FROM events WHERE event_type = 'refund'", ("event_id",)))
    ok = "(row_count = distinct_keys AND row_count > 0)"
    return (f"WITH c AS ({' UNION ALL '.join(parts)}) SELECT *, row_count - distinct_keys AS failures, "
            f"{REPORT_TAIL.format(ok=ok)} FROM c")


def pk_uniqueness_composite(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that hold a timestamp, a fraction and a text: compared as they are, never as text."""
    events, lines = read(spark, sf, "events"), read(spark, sf, "lineitem")
    return checks.run_checks(spark, [
        checks.KeyCheck("events", events, ("user_id", "ts")), checks.KeyCheck("events", events, ("ts",)),
        checks.KeyCheck("lineitem", lines, ("l_orderkey", "l_extendedprice", "l_returnflag")),
        checks.KeyCheck("lineitem", lines, ("l_extendedprice",))])


PK_UNIQUENESS_COMPOSITE = (("events", ("user_id", "ts")), ("events", ("ts",)),
                           ("lineitem", ("l_orderkey", "l_extendedprice", "l_returnflag")),
                           ("lineitem", ("l_extendedprice",)))


def pk_uniqueness_composite_sql() -> str:
    parts = [key_part(table, f"SELECT {', '.join(keys)} FROM {table}", keys) for table, keys in PK_UNIQUENESS_COMPOSITE]
    ok = "(row_count = distinct_keys AND row_count > 0)"
    return (f"WITH c AS ({' UNION ALL '.join(parts)}) SELECT *, row_count - distinct_keys AS failures, "
            f"{REPORT_TAIL.format(ok=ok)} FROM c")


def pk_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return checks.duplicate_keys(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


PK_DUPLICATES_SQL = """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""


# References ---------------------------------------------------------------------------------------------------

def solvent(spark: SparkSession, sf: str) -> DataFrame:
    """A parent table with gaps: customers who owe nothing."""
    return read(spark, sf, "customer").where("c_acctbal >= 0")


def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [checks.ReferenceCheck(child, read(spark, sf, child), column, parent, read(spark, sf, parent), key)
              for child, column, parent, key in REFERENCES]
    orders, nation, customer = (read(spark, sf, table) for table in ("orders", "nation", "customer"))
    open_orders = orders.withColumn("open_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    wanted += [
        checks.ReferenceCheck("orders", orders, "o_custkey", "solvent", solvent(spark, sf), "c_custkey"),
        checks.ReferenceCheck("orders", open_orders, "open_custkey", "customer", customer, "c_custkey"),
        checks.ReferenceCheck("customer", customer, "c_nationkey", "nation_twice", nation.unionByName(nation),
                              "n_nationkey")]
    return checks.run_checks(spark, wanted)


def fk_orphans_by_join(spark: SparkSession, sf: str) -> DataFrame:
    """The same kind of check one relation at a time, as a join."""
    return checks.union_reports([
        checks.reference_check(read(spark, sf, child), child, column, read(spark, sf, parent), parent, key)
        for child, column, parent, key in REFERENCES])


def reference_part(family: str, child: str, column: str, parent: str, key: str, child_sql: str | None = None,
                   parent_sql: str | None = None) -> str:
    gate = "" if family == "foreign_key" else f" AND f.{column} IS NOT NULL"
    return f"""SELECT '{family}' AS family, '{child}' AS table_name, '{column}' AS column_name,
  '{parent}.{key}' AS reference, count(*)::BIGINT AS row_count, count(DISTINCT f.{column})::BIGINT AS distinct_keys,
  count(*) FILTER (p.k IS NULL{gate})::BIGINT AS failures
FROM ({child_sql or f'SELECT * FROM {child}'}) f
LEFT JOIN (SELECT DISTINCT {key} AS k FROM ({parent_sql or f'SELECT * FROM {parent}'})) p ON f.{column} = p.k"""


def report_sql(parts: list[str]) -> str:
    return (f"WITH c AS ({' UNION ALL '.join(parts)}) SELECT *, {REPORT_TAIL.format(ok='(failures = 0)')} FROM c")


SOLVENT_SQL = "SELECT * FROM customer WHERE c_acctbal >= 0"
OPEN_ORDERS_SQL = "SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS open_custkey FROM orders"


def fk_orphans_by_join_sql() -> str:
    return report_sql([reference_part("foreign_key", *relation) for relation in REFERENCES])


def fk_orphans_sql() -> str:
    parts = [reference_part("foreign_key", *relation) for relation in REFERENCES]
    parts.append(reference_part("foreign_key", "orders", "o_custkey", "solvent", "c_custkey", None, SOLVENT_SQL))
    parts.append(reference_part("foreign_key", "orders", "open_custkey", "customer", "c_custkey", OPEN_ORDERS_SQL))
    parts.append(reference_part("foreign_key", "customer", "c_nationkey", "nation_twice", "n_nationkey", None,
                                "SELECT * FROM nation UNION ALL SELECT * FROM nation"))
    return report_sql(parts)


def natural_key_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Text keys on both sides; a NULL child key is no orphan here."""
    width = fn.pad_width(6, size(spark, sf, "customer"))
    orders = read(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", fn.text_key(F.col("o_custkey") + 1, "CU", width)).alias("customer_nbr"))
    events = read(spark, sf, "events").select(fn.text_key(F.col("user_id") + 1, "CU", width).alias("customer_nbr"))

    def parents(df: DataFrame) -> DataFrame:
        return df.select(fn.text_key(F.col("c_custkey") + 1, "CU", width).alias("customer_nbr"))

    everyone, gaps = parents(read(spark, sf, "customer")), parents(solvent(spark, sf))
    return checks.union_reports([
        checks.reference_check(child, name, "customer_nbr", parent, parent_name, "customer_nbr", False)
        for name, child in (("orders", orders), ("events", events))
        for parent_name, parent in (("customer", everyone), ("solvent", gaps))])


def natural_key_orphans_sql() -> str:
    width = "greatest(6, length((SELECT count(*) FROM customer)::VARCHAR))::INT"

    def key(column: str) -> str:
        return f"'CU_' || lpad(({column} + 1)::VARCHAR, {width}, '0')"

    children = {"orders": f"SELECT CASE WHEN o_orderstatus <> 'P' THEN {key('o_custkey')} END AS customer_nbr FROM orders",
                "events": f"SELECT {key('user_id')} AS customer_nbr FROM events"}
    parents = {"customer": f"SELECT {key('c_custkey')} AS customer_nbr FROM customer",
               "solvent": f"SELECT {key('c_custkey')} AS customer_nbr FROM ({SOLVENT_SQL})"}
    return report_sql([reference_part("natural_key", name, "customer_nbr", parent, "customer_nbr", child, parent_sql)
                       for name, child in children.items() for parent, parent_sql in parents.items()])


def fk_orphan_rows(spark: SparkSession, sf: str) -> DataFrame:
    return checks.orphan_rows(read(spark, sf, "orders"), "o_custkey", solvent(spark, sf), "c_custkey")


FK_ORPHAN_ROWS_SQL = f"SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM ({SOLVENT_SQL}))"


def fk_orphan_keys(spark: SparkSession, sf: str) -> DataFrame:
    return checks.orphan_keys(read(spark, sf, "orders"), "o_custkey", solvent(spark, sf), "c_custkey")


FK_ORPHAN_KEYS_SQL = f"""SELECT o_custkey AS child_key, count(*) AS row_count FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM ({SOLVENT_SQL})) GROUP BY 1"""


# Whole reports ------------------------------------------------------------------------------------------------

def table_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.row_counts(spark, lambda table: read(spark, sf, table), [*ALL_TABLES, "no_such_table"])


TABLE_ROW_COUNTS_SQL = " UNION ALL ".join(
    [f"SELECT '{table}' AS table_name, count(*)::BIGINT AS row_count, 'ok' AS status FROM {table}"
     for table in ALL_TABLES] + ["SELECT 'no_such_table', NULL::BIGINT, 'PATH_NOT_FOUND'"])


def integrity_report(spark: SparkSession, sf: str) -> DataFrame:
    tables = {table: read(spark, sf, table) for table in ALL_TABLES}
    keys = TABLE_KEYS | {"absent": ("id",)}
    foreign = [*REFERENCES, ("lineitem", "l_suppkey", "absent", "id")]
    return checks.integrity_report(spark, tables, keys, foreign, [("events", "user_id", "customer", "c_custkey")])


def integrity_report_sql() -> str:
    keys = [key_part(table, f"SELECT {', '.join(key)} FROM {table}", key) for table, key in TABLE_KEYS.items()]
    ok = "(row_count = distinct_keys AND row_count > 0)"
    references = [reference_part("foreign_key", *relation) for relation in REFERENCES]
    references.append(reference_part("natural_key", "events", "user_id", "customer", "c_custkey"))
    return f"""SELECT *, row_count - distinct_keys AS failures, {REPORT_TAIL.format(ok=ok)}
FROM ({' UNION ALL '.join(keys)}) UNION ALL ({report_sql(references)})
UNION ALL SELECT 'key', 'absent', 'id', '', NULL, NULL, NULL, 'skipped', NULL
UNION ALL SELECT 'foreign_key', 'lineitem', 'l_suppkey', 'absent.id', NULL, NULL, NULL, 'skipped', NULL"""


SAMPLE_ROWS = 1000


def fact_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The sampling operator: about a thousand orders, the same ones on every scan."""
    orders = read(spark, sf, "orders")
    return hash_sample(orders, ["o_orderkey"], bucket_count(size(spark, sf, "orders"), SAMPLE_ROWS))


FACT_SAMPLE_SQL = f"""WITH {{ctes}}
SELECT orders.* FROM orders JOIN drawn ON drawn.id = o_orderkey
WHERE v[1] % greatest(1, (SELECT count(*) FROM orders) // {SAMPLE_ROWS}) = 0"""


# Conformance --------------------------------------------------------------------------------------------------

ORDERS_CONTRACT = Contract("orders", (
    ContractColumn("o_orderkey", "bigint", ("primary_key", "not_null")),
    ContractColumn("o_custkey", "bigint", ("not_null",)),
    ContractColumn("o_orderstatus", "varchar(50)", ("not_null",)),
    ContractColumn("o_totalprice", "decimal(18,2)"),
    ContractColumn("o_orderdate", "date"),
    ContractColumn("o_priority", "string"),
))


def contract_check(spark: SparkSession, sf: str) -> DataFrame:
    """A drifted contract: one renamed column, two other types, and NULLs in a required column."""
    orders = read(spark, sf, "orders").withColumn("o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    return conformance.contract_check(spark, orders, ORDERS_CONTRACT)


CONTRACT_CHECK_SQL = """WITH shape(column_name, rule, expected, actual, failures) AS (VALUES
 ('o_orderkey', 'type', 'bigint', 'bigint', 0), ('o_custkey', 'type', 'bigint', 'bigint', 0),
 ('o_orderstatus', 'type', 'string', 'string', 0), ('o_totalprice', 'type', 'decimal(18,2)', 'double', 1),
 ('o_orderdate', 'type', 'date', 'timestamp_ntz', 1), ('o_priority', 'missing', 'string', '', 1),
 ('o_orderpriority', 'extra', '', 'string', 1)),
found AS (SELECT column_name, rule, expected, actual, failures::BIGINT AS failures FROM shape
 UNION ALL SELECT 'o_orderkey', 'required', 'not null', '', count(*) FILTER (o_orderkey IS NULL) FROM orders
 UNION ALL SELECT 'o_custkey', 'required', 'not null', '', count(*) FILTER (o_orderstatus = 'P') FROM orders
 UNION ALL SELECT 'o_orderstatus', 'required', 'not null', '', count(*) FILTER (o_orderstatus IS NULL) FROM orders)
SELECT 'orders' AS table_name, *, failures = 0 AS ok FROM found"""

ORDER_DOMAINS = {"o_orderstatus": ("O", "F"),
                 "o_orderpriority": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")}


def domain_check(spark: SparkSession, sf: str) -> DataFrame:
    return conformance.domain_check(read(spark, sf, "orders"), "orders", ORDER_DOMAINS)


def tally_part(table: str, column: str, rule: str, failing: str, applies: str, source: str | None = None) -> str:
    rule = rule.replace("'", "''")
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
            f"count(*) FILTER ({applies})::BIGINT AS row_count, count(*) FILTER ({failing})::BIGINT AS failures "
            f"FROM {source or table}")


def tally_sql(parts: list[str]) -> str:
    return f"SELECT *, failures = 0 AS ok FROM ({' UNION ALL '.join(parts)})"


def in_list(values) -> str:
    return ", ".join(f"'{x}'" for x in values)


DOMAIN_CHECK_SQL = tally_sql([
    tally_part("orders", column, "in_domain", f"{column} NOT IN ({in_list(values)})", f"{column} IS NOT NULL")
    for column, values in ORDER_DOMAINS.items()])


def domain_offenders(spark: SparkSession, sf: str) -> DataFrame:
    """Brands sold that no standard part carries: the domain is itself a table."""
    brand_types = read(spark, sf, "part").select(F.concat_ws("/", "p_brand", "p_type").alias("brand_type"), "p_size")
    small = brand_types.where("p_size <= 10").select(F.col("brand_type").alias("allowed_type")).distinct()
    return conformance.domain_offenders(brand_types, "brand_type", small, "allowed_type")


DOMAIN_OFFENDERS_SQL = """SELECT concat_ws('/', p_brand, p_type) AS value, count(*) AS row_count FROM part
WHERE concat_ws('/', p_brand, p_type) NOT IN (SELECT concat_ws('/', p_brand, p_type) FROM part WHERE p_size <= 10)
GROUP BY 1"""

EVENT_WEIGHTS = {"click": 1, "view": 1, "purchase": 1, "signup": 1, "error": 1}
STATUS_WEIGHTS = {"O": 40, "F": 40, "P": 19, "X": 1}


def weight_check(spark: SparkSession, sf: str) -> DataFrame:
    events = conformance.weight_check(read(spark, sf, "events"), "events", "event_type",
                                      tuple(EVENT_WEIGHTS), tuple(EVENT_WEIGHTS.values()), 0.02)
    orders = conformance.weight_check(read(spark, sf, "orders"), "orders", "o_orderstatus",
                                      tuple(STATUS_WEIGHTS), tuple(STATUS_WEIGHTS.values()), 0.02)
    return events.unionByName(orders)


def weight_part(table: str, column: str, weights: dict[str, int]) -> str:
    total = sum(weights.values())
    expected = ", ".join(f"('{value}', {weight}::DOUBLE / {total}::DOUBLE)" for value, weight in weights.items())
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, w.value, count(t.{column})::BIGINT AS row_count,
  any_value(w.share) AS expected_share,
  count(t.{column})::DOUBLE / (SELECT count({column}) FROM {table})::DOUBLE AS observed_share
FROM (VALUES {expected}) w(value, share) LEFT JOIN {table} t ON t.{column} = w.value GROUP BY w.value"""


WEIGHT_CHECK_SQL = (f"SELECT *, abs(observed_share - expected_share) <= 0.02::DOUBLE AS ok FROM ("
                    f"{weight_part('events', 'event_type', EVENT_WEIGHTS)} UNION ALL "
                    f"{weight_part('orders', 'o_orderstatus', STATUS_WEIGHTS)})")

NULL_TABLE = s.TableSpec("gen_nulls", (), SHOWCASE["gen_nulls"][1])
NULL_RATES = {column.name: column.null_rate for column in NULL_TABLE.columns} | {"rate_030": 0.5}
NULL_TOLERANCE = 0.02


def null_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Observed against declared NULL rates of a generated table; one declaration is wrong on purpose."""
    built = project(spark, sf, "orders", NULL_TABLE, s.Options())
    return conformance.null_rate_check(built, "gen_nulls", NULL_RATES, NULL_TOLERANCE)


def null_rates_sql() -> str:
    rendering = Rendering(NULL_TABLE, "(SELECT count(*) FROM orders)", domain_sql())
    parts = " UNION ALL ".join(
        f"SELECT '{column}' AS column_name, count(*)::BIGINT AS row_count, "
        f"count(*) FILTER (\"{column}\" IS NULL)::BIGINT AS null_count, "
        f"{min(1.0, max(0.0, rate))}::DOUBLE AS declared_rate FROM built" for column, rate in NULL_RATES.items())
    return f"""WITH {table_ctes(ids_sql('orders'), rendering)}, c AS ({parts}),
d AS (SELECT *, null_count::DOUBLE / row_count::DOUBLE AS observed_rate FROM c)
SELECT 'gen_nulls' AS table_name, *, abs(observed_rate - declared_rate) <= {NULL_TOLERANCE}::DOUBLE AS ok FROM d"""


TEMPLATES = {"customer": {"c_name": "Custome\\r#ddddddddd", "c_mktsegment": "rrrrrrrrr"},
             "supplier": {"s_name": "Supplie\\r#ddddddddd"},
             "part": {"p_brand": "B\\r\\an\\d#dd"},
             "orders": {"o_orderpriority": "d-rrrrrr"}}
TEMPLATE_PATTERNS = {"c_name": "Customer#[0-9]{9}", "c_mktsegment": "[A-Z]{9}", "s_name": "Supplier#[0-9]{9}",
                     "p_brand": "Brand#[0-9]{2}", "o_orderpriority": "[0-9]-[A-Z]{6}"}


def template_check(spark: SparkSession, sf: str) -> DataFrame:
    return checks.union_reports([conformance.template_check(read(spark, sf, table), table, templates)
                                 for table, templates in TEMPLATES.items()])


TEMPLATE_CHECK_SQL = tally_sql([
    tally_part(table, column, template, f"NOT regexp_full_match({column}, '{TEMPLATE_PATTERNS[column]}')",
               f"{column} IS NOT NULL")
    for table, templates in TEMPLATES.items() for column, template in templates.items()])


def range_check(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = (read(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_shipdate")
             .join(orders, F.col("l_orderkey") == F.col("o_orderkey")))
    return conformance.range_check(lines, "lineitem", {"l_quantity": (1, 50), "l_discount": (0.0, 0.055)},
                                   [("o_orderdate", "l_shipdate")])


RANGE_SOURCE = "lineitem JOIN orders ON l_orderkey = o_orderkey"
RANGE_CHECK_SQL = tally_sql([
    tally_part("lineitem", "l_quantity", "range", "NOT l_quantity BETWEEN 1 AND 50", "true", RANGE_SOURCE),
    tally_part("lineitem", "l_discount", "range", "NOT l_discount BETWEEN 0.0 AND 0.055::DOUBLE", "true", RANGE_SOURCE),
    tally_part("lineitem", "o_orderdate<l_shipdate", "order", "NOT o_orderdate < l_shipdate", "true", RANGE_SOURCE)])


def key_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Keys wide enough for their domain, and keys cut short by a two-digit pad."""
    rows = size(spark, sf, "customer")
    ids = row_ids_of(spark, sf, "customer").withColumnRenamed(ROW_ID, "id")
    wide = ids.select("id", fn.text_key(F.col("id"), "CU", fn.pad_width(6, rows)).alias("customer_nbr"))
    narrow = ids.select("id", fn.text_key(F.col("id"), "CU", 2).alias("customer_nbr"))
    return checks.union_reports([
        conformance.key_round_trip(wide, "wide", "customer_nbr", "id", "CU"),
        conformance.key_round_trip(narrow, "narrow", "customer_nbr", "id", "CU")])


def round_trip_part(name: str, width: str) -> str:
    return f"""SELECT '{name}' AS table_name, 'customer_nbr' AS column_name, sum(n)::BIGINT AS row_count,
  count(*)::BIGINT AS distinct_keys, sum(wrong)::BIGINT AS mismatches, count(*) FILTER (lo <> hi)::BIGINT AS collisions
FROM (SELECT k, count(*) AS n, min(id) AS lo, max(id) AS hi,
  count(*) FILTER (regexp_extract(k, '^CU_([0-9]+)$', 1)::BIGINT <> id) AS wrong
  FROM (SELECT c_custkey + 1 AS id, 'CU_' || lpad((c_custkey + 1)::VARCHAR, {width}, '0') AS k FROM customer) GROUP BY k)"""


KEY_ROUND_TRIP_SQL = f"""SELECT *, mismatches = 0 AND collisions = 0 AS ok FROM (
{round_trip_part('wide', "greatest(6, length((SELECT count(*) FROM customer)::VARCHAR))::INT")}
UNION ALL {round_trip_part('narrow', '2')})"""


def generated_conformance(spark: SparkSession, sf: str) -> DataFrame:
    """Templates, ranges and date order of a generated cost centre dimension, in one report."""
    spec = TABLES["cost_center_dim_v"]
    built = project(spark, sf, "customer", spec, s.Options())
    templates = {c.name: c.template for c in spec.columns if isinstance(c, s.Template)}
    shapes = conformance.template_check(built, spec.name, templates)
    order = conformance.range_check(built, spec.name, {"cost_center_id": (1, size(spark, sf, "customer"))},
                                    [("valid_from_dt", "valid_to_dt"), ("begin_effective_dt", "end_effective_dt")])
    return shapes.unionByName(order)


def generated_conformance_sql() -> str:
    spec = TABLES["cost_center_dim_v"]
    rendering = Rendering(spec, "(SELECT count(*) FROM customer)", domain_sql())
    parts = [tally_part(spec.name, c.name, c.template, "false", f'"{c.name}" IS NOT NULL', "built")
             for c in spec.columns if isinstance(c, s.Template)]
    parts += [tally_part(spec.name, "cost_center_id", "range", "false", "true", "built"),
              tally_part(spec.name, "valid_from_dt<valid_to_dt", "order", "NOT valid_from_dt < valid_to_dt", "true", "built"),
              tally_part(spec.name, "begin_effective_dt<end_effective_dt", "order",
                         "NOT begin_effective_dt < end_effective_dt", "true", "built")]
    return f"WITH {table_ctes(ids_sql('customer'), rendering)} {tally_sql(parts)}"


# Bitmaps and estimates ------------------------------------------------------------------------------------------

WHOLE_KEYS = {table: keys[0] for table, keys in TABLE_KEYS.items() if len(keys) == 1}


def pk_uniqueness_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of one whole number on bitmaps, a foreign key and one with NULLs among them."""
    late = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("open_key")
    return checks.union_reports([
        *(bitmaps.bitmap_key_check(read(spark, sf, table), table, key) for table, key in WHOLE_KEYS.items()),
        bitmaps.bitmap_key_check(read(spark, sf, "lineitem"), "lineitem", "l_orderkey"),
        bitmaps.bitmap_key_check(read(spark, sf, "orders").select(late), "orders_null_key", "open_key"),
        bitmaps.bitmap_key_check(read(spark, sf, "events").where("event_type = 'refund'"), "events_refund", "event_id")])


def pk_uniqueness_bitmap_sql() -> str:
    parts = [key_part(table, f"SELECT {key} FROM {table}", (key,)) for table, key in WHOLE_KEYS.items()]
    parts.append(key_part("lineitem", "SELECT l_orderkey FROM lineitem", ("l_orderkey",)))
    parts.append(key_part("orders_null_key", "SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS open_key FROM orders",
                          ("open_key",)))
    parts.append(key_part("events_refund", "SELECT event_id FROM events WHERE event_type = 'refund'", ("event_id",)))
    ok = "(row_count = distinct_keys AND row_count > 0)"
    return (f"WITH c AS ({' UNION ALL '.join(parts)}) SELECT *, row_count - distinct_keys AS failures, "
            f"{REPORT_TAIL.format(ok=ok)} FROM c")


def fk_orphans_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = (read(spark, sf, table) for table in ("orders", "customer"))
    open_orders = orders.withColumn("open_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    wanted = [(read(spark, sf, child), child, column, read(spark, sf, parent), parent, key)
              for child, column, parent, key in REFERENCES]
    wanted += [(orders, "orders", "o_custkey", solvent(spark, sf), "solvent", "c_custkey"),
               (open_orders, "orders", "open_custkey", customer, "customer", "c_custkey")]
    return checks.union_reports([bitmaps.bitmap_reference_check(*check) for check in wanted])


def fk_orphans_bitmap_sql() -> str:
    parts = [reference_part("foreign_key", *relation) for relation in REFERENCES]
    parts.append(reference_part("foreign_key", "orders", "o_custkey", "solvent", "c_custkey", None, SOLVENT_SQL))
    parts.append(reference_part("foreign_key", "orders", "open_custkey", "customer", "c_custkey", OPEN_ORDERS_SQL))
    return report_sql(parts)


ESTIMATED = (("orders", "o_orderkey", "o_orderstatus"), ("lineitem", "l_orderkey", "l_returnflag"),
             ("events", "event_id", "event_type"), ("customer", "c_custkey", "c_mktsegment"))


def pk_estimate(spark: SparkSession, sf: str) -> DataFrame:
    """Keys by sketches of slices that are merged; the exact counts beside them show the bound kept."""
    parts = []
    for table, key, slice_ in ESTIMATED:
        df = read(spark, sf, table)
        report = estimates.key_estimate(estimates.key_sketches(df, key, [slice_]), table, key)
        exact = checks.key_check(df, table, [key]).select("distinct_keys")
        within = F.abs(F.col("distinct_estimate") - F.col("distinct_keys")) <= F.col("error_bound") * F.col("distinct_keys")
        parts.append(report.crossJoin(exact).withColumn("within", within).drop("distinct_estimate"))  # one row each
    return checks.union_reports(parts)


def pk_estimate_sql() -> str:
    parts = [f"""SELECT '{table}' AS table_name, '{key}' AS column_name, count(*) AS row_count,
  count(*) FILTER ({key} IS NULL) AS null_count, {estimates.sketch_error()!r}::DOUBLE AS error_bound,
  CASE WHEN count(*) > count(DISTINCT {key}) * 1.2 THEN 'failed' ELSE 'estimated' END AS status,
  count(DISTINCT {key}) AS distinct_keys, true AS within FROM {table}""" for table, key, _ in ESTIMATED]
    return " UNION ALL ".join(parts)


FITS = (("events", "event_type", EVENT_WEIGHTS), ("orders", "o_orderstatus", STATUS_WEIGHTS),
        ("customer", "c_mktsegment", dict.fromkeys(("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"), 1)),
        ("customer", "c_mktsegment", {"AUTOMOBILE": 2, "BUILDING": 1, "FURNITURE": 1, "HOUSEHOLD": 1, "MACHINERY": 1}),
        ("lineitem", "l_linestatus", {"O": 1, "F": 0}))


def weight_fit(spark: SparkSession, sf: str) -> DataFrame:
    return checks.union_reports([
        estimates.weight_fit(read(spark, sf, table), table, column, tuple(weights), tuple(weights.values()))
        for table, column, weights in FITS])


def weight_fit_sql() -> str:
    parts = []
    for table, column, weights in FITS:
        listed = {value: weight / sum(weights.values()) for value, weight in weights.items() if weight}
        seen = ", ".join(f"count(*) FILTER ({column} = '{value}') AS n{i}" for i, value in enumerate(listed))
        terms = " + ".join(f"(n{i} - row_count * {share!r}::DOUBLE) * (n{i} - row_count * {share!r}::DOUBLE) / "
                           f"(row_count * {share!r}::DOUBLE)" for i, share in enumerate(listed.values()))
        freedom = len(listed) - 1
        critical = estimates.chi_square_critical(freedom, 0.001) if freedom else 0.0
        parts.append(f"""SELECT '{table}' AS table_name, '{column}' AS column_name, row_count,
  row_count - ({" + ".join(f"n{i}" for i in range(len(listed)))}) AS unlisted, {terms} AS statistic,
  {freedom} AS freedom, {critical!r}::DOUBLE AS critical FROM (SELECT count({column}) AS row_count, {seen} FROM {table})""")
    return f"SELECT *, unlisted = 0 AND statistic <= critical AS ok FROM ({' UNION ALL '.join(parts)})"


def null_rate_fit(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the orders lose their customer by a hash of their key; half and none are declared as well."""
    third = F.when(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) != 0, F.col("o_custkey"))
    orders = read(spark, sf, "orders").select("o_orderdate", third.alias("some_custkey"), third.alias("half_custkey"))
    report = estimates.null_rate_fit(orders, "orders", {"some_custkey": 1 / 3, "half_custkey": 0.5, "o_orderdate": 0.0})
    return report.drop("null_count")


NULL_RATE_FIT_SQL = """SELECT 'orders' AS table_name, column_name, row_count, declared_rate,
  CASE WHEN declared_rate > 0 THEN 4.0 * sqrt(row_count * declared_rate * (1 - declared_rate)) + 0.5 ELSE 0.0 END AS allowed, ok
FROM (SELECT count(*) AS row_count FROM orders),
     (VALUES ('some_custkey', (1.0::DOUBLE / 3), true), ('half_custkey', 0.5::DOUBLE, false),
             ('o_orderdate', 0.0::DOUBLE, true)) AS v(column_name, declared_rate, ok)"""


def check_queries() -> dict[str, tuple[Callable, str]]:
    return {
        "pk_uniqueness": (pk_uniqueness, pk_uniqueness_sql),
        "pk_uniqueness_composite": (pk_uniqueness_composite, pk_uniqueness_composite_sql),
        "pk_duplicates": (pk_duplicates, PK_DUPLICATES_SQL),
        "fk_orphans": (fk_orphans, fk_orphans_sql),
        "fk_orphans_by_join": (fk_orphans_by_join, fk_orphans_by_join_sql),
        "fk_orphan_rows": (fk_orphan_rows, FK_ORPHAN_ROWS_SQL),
        "fk_orphan_keys": (fk_orphan_keys, FK_ORPHAN_KEYS_SQL),
        "natural_key_orphans": (natural_key_orphans, natural_key_orphans_sql),
        "table_row_counts": (table_row_counts, TABLE_ROW_COUNTS_SQL),
        "integrity_report": (integrity_report, integrity_report_sql),
        "fact_sample": (fact_sample, lambda: FACT_SAMPLE_SQL.format(
            ctes=stream_ctes("SELECT o_orderkey::BIGINT AS id FROM orders", [42]))),
        "contract_check": (contract_check, CONTRACT_CHECK_SQL),
        "domain_check": (domain_check, DOMAIN_CHECK_SQL),
        "domain_offenders": (domain_offenders, DOMAIN_OFFENDERS_SQL),
        "weight_check": (weight_check, WEIGHT_CHECK_SQL),
        "null_rates": (null_rates, null_rates_sql),
        "pk_uniqueness_bitmap": (pk_uniqueness_bitmap, pk_uniqueness_bitmap_sql),
        "fk_orphans_bitmap": (fk_orphans_bitmap, fk_orphans_bitmap_sql),
        "pk_estimate": (pk_estimate, pk_estimate_sql),
        "weight_fit": (weight_fit, weight_fit_sql),
        "null_rate_fit": (null_rate_fit, NULL_RATE_FIT_SQL),
        "template_check": (template_check, TEMPLATE_CHECK_SQL),
        "range_check": (range_check, RANGE_CHECK_SQL),
        "key_round_trip": (key_round_trip, KEY_ROUND_TRIP_SQL),
        "generated_conformance": (generated_conformance, generated_conformance_sql),
    }
