"""Star joins, join survival and roll-ups over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driver.generated import project
from driver.oracle import Rendering, table_sql
from driver.tables import domain_sizes, domain_sql, ids_sql, read, size
from finloom import functions as fn
from finloom.functions.keys import pad_width
from finloom.operators.star import (
    Branch, fiscal_roll_up, level_totals, roll_up, star_aggregate, star_join, survival_estimate,
)
from finloom.plans.calendar import calendar, calendar_columns
from finloom.plans.ledger import (
    FACT_GROUPS, HIERARCHY_KEYS, SUMS, SURVIVAL_FILTERS, ledger_aggregate, ledger_survivors,
)
from finloom.plans.specs import Options
from finloom.plans.tables import TABLES, build_table

# Share of each dimension that its hierarchies cover, in percent.
PROFIT_CENTER_COVERAGE = 40
COST_CENTER_COVERAGE = 50

MONEY = "decimal(18,2)"


def money(column: str) -> Column:
    return F.col(column).cast(MONEY)


def hierarchy_rows(spark: SparkSession, sf: str) -> tuple[int, int]:
    return (size(spark, sf, "part") * PROFIT_CENTER_COVERAGE // 100,
            size(spark, sf, "customer") * COST_CENTER_COVERAGE // 100)


def hierarchy(spark: SparkSession, sf: str, name: str, columns: list[str], options: Options = Options()) -> DataFrame:
    """One partial hierarchy, sized from the driver tables."""
    sizes = domain_sizes(spark, sf, {"profit_center", "cost_center_dim_v"})
    pc_rows, cc_rows = hierarchy_rows(spark, sf)
    rows = pc_rows if "profit_center" in name else cc_rows
    return build_table(spark, name, rows, None, sizes, columns=columns, options=options)


def pc_key(column: str, rows: int) -> Column:
    return fn.text_key(F.col(column) + 1, "PC", pad_width(6, rows))


def cc_key(column: str, rows: int) -> Column:
    return fn.text_key(F.col(column) + 1, "CC", pad_width(6, rows))


def lines_with_key(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").withColumn("profit_center_nbr", pc_key("l_partkey", size(spark, sf, "part")))


def orders_with_key(spark: SparkSession, sf: str) -> DataFrame:
    return (read(spark, sf, "orders")
            .withColumn("cost_center_nbr", cc_key("o_custkey", size(spark, sf, "customer")))
            .withColumn("fiscal_year_period_nbr", fn.period_of_date(F.col("o_orderdate"))))


def star_survivor_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    """Sums per fiscal period, flags and dimension attributes for the rows every hierarchy covers.

    Each side of the order join is filtered by its own hierarchies first, so
    only survivors are shuffled by order key.
    """
    segment_pc = hierarchy(spark, sf, "segment_profit_center_hierarchy",
                           ["profit_center_nbr", "profit_center_hierarchy_nm"]).toDF("seg_pc", "segment_nm")
    dischannel_pc = hierarchy(spark, sf, "dischannel_profit_center_hierarchy",
                              ["distrchnl_profit_center_nbr", "profit_center_hierarchy_nm"]
                              ).toDF("dis_pc", "dischannel_nm")
    segment_cc = hierarchy(spark, sf, "segment_cost_center_hierarchy_dim_v",
                           ["cost_center_nbr", "cost_center_hierarchy_nm"]).toDF("seg_cc", "cost_center_group_nm")
    dischannel_cc = hierarchy(spark, sf, "dischannel_cost_center_hierarchy_dim_v", ["cost_center_nbr"]).toDF("dis_cc")
    pc_rows, cc_rows = hierarchy_rows(spark, sf)
    part = read(spark, sf, "part").select("p_partkey", "p_brand")
    customer = read(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    region = read(spark, sf, "region").select("r_regionkey", "r_name")

    lines = star_join(lines_with_key(spark, sf), [
        Branch(segment_pc, "profit_center_nbr", "seg_pc", pc_rows),
        Branch(dischannel_pc, "profit_center_nbr", "dis_pc", pc_rows),
        Branch(part, "l_partkey", "p_partkey", size(spark, sf, "part"))])
    heads = star_join(orders_with_key(spark, sf), [
        Branch(segment_cc, "cost_center_nbr", "seg_cc", cc_rows),
        Branch(dischannel_cc, "cost_center_nbr", "dis_cc", cc_rows),
        Branch(customer, "o_custkey", "c_custkey", size(spark, sf, "customer")),
        Branch(nation, "c_nationkey", "n_nationkey"), Branch(region, "n_regionkey", "r_regionkey")])
    return star_aggregate(
        lines, [Branch(heads, "l_orderkey", "o_orderkey")],
        ["fiscal_year_period_nbr", "l_returnflag", "l_linestatus", "segment_nm", "dischannel_nm",
         "cost_center_group_nm", "r_name", "p_brand", "c_mktsegment"],
        {"row_count": F.count(F.lit(1)),
         "company_currency_amt": F.sum(money("l_extendedprice")).cast("decimal(38,2)"),
         "sales_qty": F.sum(money("l_quantity")).cast("decimal(38,2)")})


def hierarchy_sql(name: str, columns: list[str], options: Options = Options()) -> str:
    sizes = domain_sql()
    source, percent = (("part", PROFIT_CENTER_COVERAGE) if "profit_center" in name
                       else ("customer", COST_CENTER_COVERAGE))
    rows = f"(SELECT count(*) * {percent} // 100 FROM {source})"
    ids = f"SELECT unnest(generate_series(1, {rows}))::BIGINT AS id"
    return f"({table_sql(ids, Rendering(TABLES[name], rows, sizes, options=options, columns=columns))})"


def key_width(table: str) -> str:
    return f"greatest(6, length((SELECT count(*) FROM {table})::VARCHAR))::INT"


PERIOD_SQL = "(year(o_orderdate) * 100 + month(o_orderdate))::INTEGER"


LINES_SQL = f"""w_pc AS (SELECT {key_width('part')} AS pc_width),
lines AS MATERIALIZED (SELECT lineitem.*, 'PC_' || lpad((l_partkey + 1)::VARCHAR, pc_width, '0') AS pc FROM lineitem, w_pc)"""
HEADS_SQL = f"""w_cc AS (SELECT {key_width('customer')} AS cc_width),
heads AS MATERIALIZED (SELECT orders.*, 'CC_' || lpad((o_custkey + 1)::VARCHAR, cc_width, '0') AS cc,
  {PERIOD_SQL} AS fiscal_year_period_nbr FROM orders, w_cc)"""


def star_survivor_sql() -> str:
    names = ["profit_center_nbr", "profit_center_hierarchy_nm"]
    distributed = ["distrchnl_profit_center_nbr", "profit_center_hierarchy_nm"]
    cost = ["cost_center_nbr", "cost_center_hierarchy_nm"]
    return f"""WITH {LINES_SQL}, {HEADS_SQL},
sp AS MATERIALIZED {hierarchy_sql('segment_profit_center_hierarchy', names)},
dp AS MATERIALIZED {hierarchy_sql('dischannel_profit_center_hierarchy', distributed)},
sc AS MATERIALIZED {hierarchy_sql('segment_cost_center_hierarchy_dim_v', cost)},
dc AS MATERIALIZED {hierarchy_sql('dischannel_cost_center_hierarchy_dim_v', ['cost_center_nbr'])}
SELECT fiscal_year_period_nbr, l_returnflag, l_linestatus,
  sp.profit_center_hierarchy_nm AS segment_nm, dp.profit_center_hierarchy_nm AS dischannel_nm,
  sc.cost_center_hierarchy_nm AS cost_center_group_nm, r_name, p_brand, c_mktsegment, count(*) AS row_count,
  sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(38,2) AS company_currency_amt,
  sum(l_quantity::DECIMAL(18,2))::DECIMAL(38,2) AS sales_qty
FROM lines
JOIN sp ON sp.profit_center_nbr = pc
JOIN dp ON dp.distrchnl_profit_center_nbr = pc
JOIN heads ON l_orderkey = o_orderkey
JOIN sc ON sc.cost_center_nbr = cc
JOIN dc ON dc.cost_center_nbr = cc
JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL"""


def survival(spark: SparkSession, sf: str) -> DataFrame:
    """Measured against estimated join survival: per hierarchy and for both together.

    Lines are read once and folded per order before the one join with the orders; all three answers come from that.
    """
    pc_rows, cc_rows = hierarchy_rows(spark, sf)
    sizes = {"pc": pc_rows, "cc": cc_rows, "part": size(spark, sf, "part"), "customer": size(spark, sf, "customer")}

    def flagged(rows: DataFrame, name: str, column: str, covered: int) -> DataFrame:
        keys = hierarchy(spark, sf, name, [column]).select(F.col(column).alias("covered")).distinct()
        return rows.join(Branch(keys, column, "covered", covered).side(), F.col(column) == F.col("covered"), "left")

    lines = lines_with_key(spark, sf).select("l_orderkey", "profit_center_nbr")
    folded = (flagged(lines, "segment_profit_center_hierarchy", "profit_center_nbr", pc_rows)
              .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count("covered").alias("n_pc")))
    heads = orders_with_key(spark, sf).select("o_orderkey", "cost_center_nbr")
    heads = (flagged(heads, "segment_cost_center_hierarchy_dim_v", "cost_center_nbr", cc_rows)
             .select("o_orderkey", F.col("covered").isNotNull().alias("in_cc")))
    totals = folded.join(heads, F.col("l_orderkey") == F.col("o_orderkey"), "left").agg(*[
        F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0)).cast("bigint").alias(name)
        for name, column, condition in (
            ("lines", "n", F.lit(True)), ("ordered", "n", F.col("o_orderkey").isNotNull()), ("pc", "n_pc", F.lit(True)),
            ("cc", "n", F.col("in_cc")), ("both", "n_pc", F.col("in_cc")))])
    answers = [("profit_center", "lines", "pc", [("pc", "part")]), ("cost_center", "ordered", "cc", [("cc", "customer")]),
               ("both", "lines", "both", [("pc", "part"), ("cc", "customer")])]
    rows = F.inline(F.array(*[
        F.struct(F.lit(name).alias("filter_nm"), F.col(base).alias("row_count"), F.col(kept).alias("surviving"),
                 F.lit(survival_estimate(sizes, filters)).alias("estimated_share"))
        for name, base, kept, filters in answers]))
    return totals.select(rows).withColumn("measured_share", F.try_divide(F.col("surviving"), F.col("row_count")))


SURVIVAL_SQL = f"""WITH n AS (SELECT (SELECT count(*) FROM part) AS parts, (SELECT count(*) FROM customer) AS customers),
c AS (SELECT parts, customers, parts * {PROFIT_CENTER_COVERAGE} // 100 AS pc,
  customers * {COST_CENTER_COVERAGE} // 100 AS cc FROM n),
f AS (SELECT l_partkey + 1 <= pc AS in_pc, o_custkey + 1 <= cc AS in_cc
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey, c),
r AS (SELECT 'profit_center' AS filter_nm, count(*) AS row_count, count(*) FILTER (in_pc) AS surviving FROM f
 UNION ALL SELECT 'cost_center', count(*), count(*) FILTER (in_cc) FROM f
 UNION ALL SELECT 'both', count(*), count(*) FILTER (in_pc AND in_cc) FROM f)
SELECT filter_nm, row_count, surviving, surviving::DOUBLE / row_count::DOUBLE AS measured_share,
  CASE filter_nm WHEN 'profit_center' THEN pc::DOUBLE / parts::DOUBLE
    WHEN 'cost_center' THEN cc::DOUBLE / customers::DOUBLE
    ELSE (pc::DOUBLE / parts::DOUBLE) * (cc::DOUBLE / customers::DOUBLE) END AS estimated_share
FROM r, c"""


def order_years(spark: SparkSession, sf: str) -> tuple[int, int]:
    """First year of the orders and how many years they span."""
    first, last = read(spark, sf, "orders").agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
    return (first, last - first + 1) if first is not None else (2000, 1)


def fiscal_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """All calendar columns for every period, with the orders booked in it."""
    booked = (read(spark, sf, "orders")
              .groupBy(fn.period_of_date(F.col("o_orderdate")).alias("period"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("amt")))
    periods = calendar(spark, None, *order_years(spark, sf))
    return (periods.join(booked, F.col("fiscal_year_period_nbr") == F.col("period"), "left")
            .select(*periods.columns, F.coalesce("n", F.lit(0)).alias("order_count"),
                    F.col("amt").cast("decimal(38,2)").alias("order_amt")))


def fiscal_calendar_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar columns derived on the order rows' own periods, without a join."""
    periods = (read(spark, sf, "orders").select(fn.period_of_date(F.col("o_orderdate")).alias("period"))
               .groupBy("period").agg(F.count(F.lit(1)).alias("order_count")))
    return periods.select(*calendar_columns(F.col("period"), order_years(spark, sf)[0]), "order_count")


CALENDAR_COLUMNS_SQL = """p AS fiscal_year_period_nbr, strftime(s, '%B') AS month_long_nm, strftime(s, '%b') AS month_short_nm,
  m AS month_nbr, (y * 100 + m)::INTEGER AS year_mth, s AS month_relevance_dt, s AS month_start_dt, e AS month_end_dt,
  n AS month_sort_sequence_nbr, m AS fiscal_period_nbr, 'P' || mm AS fiscal_period_cd,
  n AS fiscal_period_sort_sequence_nbr, 'FY' || y || 'P' || mm AS fiscal_year_period_cd,
  'FY' || y || ' Period ' || mm AS fiscal_year_period_nm, 'S' || h AS season_period_cd,
  'S' || h || 'A' AS season_alternate_period_cd,
  CASE WHEN m >= 7 THEN 'Fall/Winter' ELSE 'Spring/Summer' END AS season_nm,
  s AS season_relevance_dt, s AS season_start_dt, e AS season_end_dt, n AS season_sort_sequence_nbr,
  q AS quarter_calendar_nbr, q AS quarter_calendar_sequence_nbr, q AS quarter_business_nbr, q AS fiscal_quarter_nbr,
  'Q' || q AS fiscal_quarter_cd, q AS fiscal_quarter_sort_sequence_nbr,
  (y * 10 + q)::INTEGER AS fiscal_year_quarter_nbr, 'FY' || y || 'Q' || q AS fiscal_year_quarter_cd,
  'FY' || y || '-Q' || q AS fiscal_year_quarter_alternate_cd, y::VARCHAR AS year_cd, 'FY' || y AS year_nm,
  y::VARCHAR AS year_nbr, make_date(y, 1, 1) AS year_start_dt, make_date(y, 12, 31) AS year_end_dt,
  y AS business_year_nbr, y AS fiscal_year_nbr, 'FY' || y AS fiscal_year_cd, n AS fiscal_period_sort"""


def calendar_ctes(periods_sql: str) -> str:
    return f"""periods AS ({periods_sql}),
split AS (SELECT p, (p // 100)::INTEGER AS y, (p % 100)::INTEGER AS m FROM periods),
parts AS (SELECT *, make_date(y, m, 1) AS s, last_day(make_date(y, m, 1)) AS e, lpad(m::VARCHAR, 2, '0') AS mm,
  ((m - 1) // 3 + 1)::INTEGER AS q, ((m - 1) // 6 + 1)::INTEGER AS h,
  ((y - (SELECT year(min(o_orderdate)) FROM orders)) * 12 + m)::INTEGER AS n FROM split),
cal AS (SELECT {CALENDAR_COLUMNS_SQL} FROM parts)"""


ALL_PERIODS_SQL = ("SELECT (y * 100 + m)::INTEGER AS p FROM (SELECT unnest(generate_series(year(min(o_orderdate)), "
                   "year(max(o_orderdate)))) AS y FROM orders), (SELECT unnest(generate_series(1, 12)) AS m)")

FISCAL_CALENDAR_SQL = f"""WITH {calendar_ctes(ALL_PERIODS_SQL)},
booked AS (SELECT {PERIOD_SQL} AS period, count(*) AS n, sum(o_totalprice::DECIMAL(18,2)) AS amt FROM orders GROUP BY 1)
SELECT cal.*, coalesce(booked.n, 0) AS order_count, booked.amt::DECIMAL(38,2) AS order_amt
FROM cal LEFT JOIN booked ON period = fiscal_year_period_nbr"""

FISCAL_CALENDAR_OF_ORDERS_SQL = f"""WITH {calendar_ctes(f'SELECT DISTINCT {PERIOD_SQL} AS p FROM orders')},
booked AS (SELECT {PERIOD_SQL} AS period, count(*) AS order_count FROM orders GROUP BY 1)
SELECT cal.*, order_count FROM cal JOIN booked ON period = fiscal_year_period_nbr"""


def fiscal_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Order totals by year, season and quarter, with the totals of every prefix."""
    orders = (read(spark, sf, "orders")
              .select(fn.period_of_date(F.col("o_orderdate")).alias("period"), money("o_totalprice").alias("price")))
    return fiscal_roll_up(orders, "period", calendar(spark, None, *order_years(spark, sf)),
                          ["fiscal_year_nbr", "season_nm", "fiscal_year_quarter_cd"], {"order_amt": "price"}
                          ).withColumn("order_amt", F.col("order_amt").cast("decimal(38,2)"))


FISCAL_ROLLUP_SQL = """WITH o AS (SELECT year(o_orderdate)::INTEGER AS fiscal_year_nbr,
  CASE WHEN month(o_orderdate) >= 7 THEN 'Fall/Winter' ELSE 'Spring/Summer' END AS season_nm,
  'FY' || year(o_orderdate) || 'Q' || quarter(o_orderdate) AS fiscal_year_quarter_cd,
  o_totalprice::DECIMAL(18,2) AS price FROM orders)
SELECT fiscal_year_nbr, season_nm, fiscal_year_quarter_cd,
  (3 - grouping(fiscal_year_nbr) - grouping(season_nm) - grouping(fiscal_year_quarter_cd))::INTEGER AS level,
  count(*)::BIGINT AS row_count, sum(price)::DECIMAL(38,2) AS order_amt
FROM o GROUP BY ROLLUP (fiscal_year_nbr, season_nm, fiscal_year_quarter_cd)"""


def hierarchy_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Line totals rolled up region > nation > brand."""
    supplier = read(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nation = read(spark, sf, "nation")
    region = read(spark, sf, "region")
    part = read(spark, sf, "part").select("p_partkey", "p_brand")
    lines = read(spark, sf, "lineitem").select("l_suppkey", "l_partkey", money("l_extendedprice").alias("price"),
                                               money("l_quantity").alias("qty"))
    joined = star_join(lines, [Branch(supplier, "l_suppkey", "s_suppkey"), Branch(nation, "s_nationkey", "n_nationkey"),
                               Branch(region, "n_regionkey", "r_regionkey"), Branch(part, "l_partkey", "p_partkey")])
    rolled = roll_up(joined, ["r_name", "n_name", "p_brand"], {"sum_price": "price", "sum_qty": "qty"})
    return rolled.withColumns({name: F.col(name).cast("decimal(38,2)") for name in ("sum_price", "sum_qty")})


HIERARCHY_ROLLUP_SQL = """SELECT r_name, n_name, p_brand,
  (3 - grouping(r_name) - grouping(n_name) - grouping(p_brand))::INTEGER AS level, count(*)::BIGINT AS row_count,
  sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(38,2) AS sum_price, sum(l_quantity::DECIMAL(18,2))::DECIMAL(38,2) AS sum_qty
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
GROUP BY ROLLUP (r_name, n_name, p_brand)"""

LEVELS = [f"profit_center_level_{n}_cd" for n in range(1, 10)]


def hierarchy_level_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Line totals for every member of every level of a ragged profit centre hierarchy."""
    ragged = hierarchy(spark, sf, "segment_profit_center_hierarchy", ["profit_center_nbr", *LEVELS],
                       Options(ragged=True)).withColumnRenamed("profit_center_nbr", "seg_pc")
    lines = lines_with_key(spark, sf).select("profit_center_nbr", money("l_extendedprice").alias("price"))
    # One row per key meets the hierarchy, so one key is shuffled in place of nine level texts.
    folded = lines.groupBy("profit_center_nbr").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))
    joined = star_join(folded, [Branch(ragged, "profit_center_nbr", "seg_pc", hierarchy_rows(spark, sf)[0])])
    totals = level_totals(joined, LEVELS, {"sum_price": "price", "n": "n"}).drop("row_count").withColumnRenamed(
        "n", "row_count")
    return totals.withColumn("sum_price", F.col("sum_price").cast("decimal(38,2)"))


def hierarchy_level_totals_sql() -> str:
    members = "\nUNION ALL\n".join(
        f"SELECT '{level}' AS level_nm, {level} AS member, price FROM j WHERE {level} IS NOT NULL" for level in LEVELS)
    wanted = hierarchy_sql("segment_profit_center_hierarchy", ["profit_center_nbr", *LEVELS], Options(ragged=True))
    return f"""WITH {LINES_SQL},
h AS MATERIALIZED {wanted},
j AS MATERIALIZED (SELECT h.*, l_extendedprice::DECIMAL(18,2) AS price FROM lines JOIN h ON h.profit_center_nbr = pc),
m AS ({members})
SELECT level_nm, member, count(*)::BIGINT AS row_count, sum(price)::DECIMAL(38,2) AS sum_price FROM m GROUP BY ALL"""


# The ledger star itself, generated at the driver tables' sizes ------------------------------------------------

LEDGER_COLUMNS = {
    "general_ledger_fact": ["profit_center_nbr", "cost_center_nbr", "product_id", *FACT_GROUPS, *SUMS],
    "finance_product_dim_v": ["product_id", "global_sport_focus_desc"],
    "segment_profit_center_hierarchy": ["profit_center_nbr", "profit_center_hierarchy_nm"],
    "dischannel_profit_center_hierarchy": ["distrchnl_profit_center_nbr", "profit_center_hierarchy_nm"],
    "segment_cost_center_hierarchy_dim_v": ["cost_center_nbr", "cost_center_hierarchy_nm"],
    "dischannel_cost_center_hierarchy_dim_v": ["cost_center_nbr", "cost_center_hierarchy_nm"],
}


def ledger_tables(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The fact over the orders' ids, its product dimension and calendar, and the partial hierarchies."""
    pc_rows, cc_rows = hierarchy_rows(spark, sf)
    sizes = domain_sizes(spark, sf) | {"general_ledger_fact": size(spark, sf, "orders")}
    sizes |= {name: pc_rows if "profit_center" in name else cc_rows for name, _, _ in HIERARCHY_KEYS}
    tables = {name: build_table(spark, name, sizes[name], None, sizes, columns=columns)
              for name, columns in LEDGER_COLUMNS.items() if name != "general_ledger_fact"}
    tables["calendar_fiscal_period_v"] = calendar(spark)
    tables["general_ledger_fact"] = project(spark, sf, "orders", TABLES["general_ledger_fact"], Options(),
                                            LEDGER_COLUMNS["general_ledger_fact"])
    return tables, sizes


def ledger_star_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_aggregate(*ledger_tables(spark, sf))


def ledger_star_reduced(spark: SparkSession, sf: str) -> DataFrame:
    """The same with no hierarchy broadcast: filters over their keys thin the fact ahead of its first shuffle."""
    return ledger_aggregate(*ledger_tables(spark, sf), broadcast_limit=0)


def ledger_ctes() -> str:
    sizes = domain_sql()

    def whole(name: str, source: str) -> str:
        rendering = Rendering(TABLES[name], f"(SELECT count(*) FROM {source})", sizes, columns=LEDGER_COLUMNS[name])
        return f"{name} AS MATERIALIZED ({table_sql(ids_sql(source), rendering)})"

    parts = [whole("general_ledger_fact", "orders"), whole("finance_product_dim_v", "part")]
    parts += [f"{name} AS MATERIALIZED {hierarchy_sql(name, LEDGER_COLUMNS[name])}" for name, _, _ in HIERARCHY_KEYS]
    return ",\n".join(parts)


LEDGER_JOINS = """FROM general_ledger_fact f
JOIN segment_profit_center_hierarchy a ON a.profit_center_nbr = f.profit_center_nbr
JOIN dischannel_profit_center_hierarchy b ON b.distrchnl_profit_center_nbr = f.profit_center_nbr
JOIN segment_cost_center_hierarchy_dim_v c ON c.cost_center_nbr = f.cost_center_nbr
JOIN dischannel_cost_center_hierarchy_dim_v d ON d.cost_center_nbr = f.cost_center_nbr"""


def ledger_star_aggregate_sql() -> str:
    groups = ", ".join(f"f.{name}" for name in FACT_GROUPS)
    sums = ", ".join(f"sum(f.{name})::DECIMAL(38,5) AS {name}" for name in SUMS)
    return f"""WITH {ledger_ctes()}
SELECT {groups},
  'FY' || (f.fiscal_year_period_nbr // 100) || 'Q' || ((f.fiscal_year_period_nbr % 100 - 1) // 3 + 1) AS fiscal_year_quarter_cd, p.global_sport_focus_desc, a.profit_center_hierarchy_nm AS segment_hierarchy_nm,
  b.profit_center_hierarchy_nm AS dischannel_hierarchy_nm, c.cost_center_hierarchy_nm AS segment_cost_hierarchy_nm,
  d.cost_center_hierarchy_nm AS dischannel_cost_hierarchy_nm, count(*) AS row_count, {sums}
{LEDGER_JOINS}
JOIN finance_product_dim_v p ON p.product_id = f.product_id
GROUP BY ALL"""


def ledger_survival(spark: SparkSession, sf: str) -> DataFrame:
    """Ledger rows that survive all four hierarchies, per fiscal period, beside the share that was expected."""
    tables, sizes = ledger_tables(spark, sf)
    booked = tables["general_ledger_fact"].groupBy("fiscal_year_period_nbr").agg(F.count(F.lit(1)).alias("row_count"))
    kept = (ledger_survivors(tables, sizes).groupBy(F.col("fiscal_year_period_nbr").alias("kept_period"))
            .agg(F.count(F.lit(1)).alias("kept")))
    return (booked.join(kept, F.col("fiscal_year_period_nbr") == F.col("kept_period"), "left")
            .select("fiscal_year_period_nbr", "row_count", F.coalesce("kept", F.lit(0)).alias("surviving"),
                    F.lit(survival_estimate(sizes, SURVIVAL_FILTERS)).alias("estimated_share")))


def ledger_survival_sql() -> str:
    return f"""WITH {ledger_ctes()},
kept AS (SELECT f.fiscal_year_period_nbr AS p, count(*) AS n {LEDGER_JOINS} GROUP BY 1),
sizes AS (SELECT (SELECT count(*) FROM part) AS parts, (SELECT count(*) FROM customer) AS customers)
SELECT fiscal_year_period_nbr, count(*) AS row_count, coalesce(any_value(kept.n), 0) AS surviving,
  any_value(((parts * {PROFIT_CENTER_COVERAGE} // 100)::DOUBLE / parts::DOUBLE)
    * ((customers * {COST_CENTER_COVERAGE} // 100)::DOUBLE / customers::DOUBLE)) AS estimated_share
FROM general_ledger_fact LEFT JOIN kept ON p = fiscal_year_period_nbr, sizes GROUP BY 1"""


def star_queries() -> dict[str, tuple[Callable, str]]:
    return {
        "star_survivor_aggregate": (star_survivor_aggregate, star_survivor_sql),
        "survival_estimate_vs_measured": (survival, SURVIVAL_SQL),
        "ledger_star_aggregate": (ledger_star_aggregate, ledger_star_aggregate_sql),
        "ledger_star_reduced": (ledger_star_reduced, ledger_star_aggregate_sql),
        "ledger_survival": (ledger_survival, ledger_survival_sql),
        "fiscal_calendar": (fiscal_calendar, FISCAL_CALENDAR_SQL),
        "fiscal_calendar_of_orders": (fiscal_calendar_of_orders, FISCAL_CALENDAR_OF_ORDERS_SQL),
        "fiscal_rollup": (fiscal_rollup, FISCAL_ROLLUP_SQL),
        "hierarchy_rollup": (hierarchy_rollup, HIERARCHY_ROLLUP_SQL),
        "hierarchy_level_totals": (hierarchy_level_totals, hierarchy_level_totals_sql),
    }
