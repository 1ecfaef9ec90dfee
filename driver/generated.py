"""Queries that run the column generators and table builders over the driver tables' ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver.oracle import Rendering, table_ctes, table_sql
from driver.tables import DOMAIN_SOURCES, KEYS, domain_sizes, domain_sql, ids_sql, read, row_ids_of, size
from finloom.operators.checks import integrity_report, union_reports
from finloom.operators.writer import tune_session
from finloom.plans import specs as s
from finloom.plans.dataset import PlanChanged, build_dataset, contract_of, dependencies
from finloom.plans.hierarchies import profit_center_hierarchy
from finloom.plans.tables import ROW_ID, TABLES, build_table, project_table
from finloom.sources import values as v
from finloom.sources.location import passing_folder
from finloom.sources.rows import dealt
from finloom.sources.volumes import Volumes

# One small declared table per group of column generators.
SHOWCASE = {
    "gen_keys": ("customer", (s.DenseKey("id"), s.DenseKey("id_int", type="int"))),
    "gen_string_keys": ("part", (
        s.TextKey("profit_center_nbr", "PC", 6), s.TextKey("functional_area_cd", "FA", 4),
        s.TextKey("cost_center_nbr", "CC", 6, counter="__cost_center_nbr_id"),
        s.TextKey("narrow_cd", "N", 2))),
    "gen_foreign_keys": ("orders", (
        s.DenseKey("id"), s.Ref("customer_id", "finance_customer_dim_v"),
        s.Ref("company_id", "company_code", null_rate=0.02),
        s.Ref("version_forecast_mapping_id", "version_forecast_mapping", type="int"),
        s.TextRef("gl_account_nbr", "gl_account_dim", "GL", 6),
        s.TextRef("cost_center_nbr", "cost_center_dim_v", "CC", 6, counter="__cost_center_nbr_fk_id"))),
    "gen_enums": ("customer", (
        s.DenseKey("id"), s.Pick("territory", v.TERRITORIES), s.Pick("channel", v.CUSTOMER_CHANNELS, (30, 25, 20, 10, 10, 5)),
        s.Pick("country_cd", v.COUNTRIES[:9], (30, 10, 8, 8, 10, 5, 3, 3, 5)),
        s.Pick("country_nm", tuple(v.COUNTRY_NAMES.values())[:9], (30, 10, 8, 8, 10, 5, 3, 3, 5),
               draws_as="country_cd"),
        s.Pick("fine_weights", ("a", "b", "c"), (1_000_003, 2_000_005, 3)),
        s.Pick("nullable", v.COMPASS, null_rate=0.25), s.Pick("etm_ind", (0, 1), (85, 15), type="int"),
        s.Pick("segment_nbr", v.SEGMENT_NUMBERS, type="int", null_rate=0.3),
        s.Cycle("in_order", v.REGIONS), s.Cycle("in_blocks", v.ROLES, every=10),
        s.flag(), s.flag("posting_allowed_ind", 80),
        s.Pick("physical_source_cd", v.SOURCE_SYSTEMS, v.SOURCE_SYSTEM_WEIGHTS))),
    "gen_templates": ("customer", (
        s.DenseKey("id"), s.Template("code", "rrd"), s.Template("style", "rr-dddddd-ddd"),
        s.words("name", 10, 8), s.Template("phone", "+d (ddd) ddd-dddd"), s.Template("lower", "aaa.aaaaa"),
        s.Template("long_run", "r" * 30 + "d" * 20), s.Template("escaped", "\\r\\a\\d rad"),
        s.Template("uuid", "-".join("d" * n for n in (8, 4, 4, 4, 12))), s.user_id("created_by_user_id"),
        s.Template("rare", "ddddd", null_rate=0.9))),
    "gen_amounts": ("orders", (
        s.DenseKey("id"), s.Amount("ledger_amt", -2_000_000, 5_000_000), s.Amount("statement_amt", precision=18),
        s.Amount("exchange_rate", "0.0001", "200", 38, 18), s.Amount("nullable_amt", null_rate=0.5),
        s.Whole("small", 1, 6), s.Whole("negative", -9, -1), s.Whole("big", 100_000, 999_999, null_rate=0.2),
        s.Whole("reference", 1, 10**12, type="bigint"), s.Real("space", 500.0, 50_000.0))),
    "gen_dates": ("customer", (
        s.DenseKey("id"), s.Day("any_day"), s.Day("valid_from", "2000-01-01", "2020-12-31"),
        s.Day("valid_to", "2025-01-01", "2035-12-31"), s.Day("closed", "2020-01-01", "2025-12-31", null_rate=0.8))),
    "gen_nulls": ("orders", (
        s.DenseKey("id"), *(s.Pick(f"rate_{pct:03d}", ("x",), null_rate=pct / 100) for pct in (0, 1, 5, 30, 90, 100)),
        s.Pick("above_one", ("x",), null_rate=1.7), s.Pick("below_zero", ("x",), null_rate=-0.3))),
    "gen_levels": ("customer", (
        s.DenseKey("id"), *s.level_family("cost_center_level", 12, 5, 0.08, cd="rrddd", nm="rrrrrrr rrrrrr"),
        *s.level_family("segment", 10, 4, 0.15, cd="rrddd", cd_nm="rrddd rrrrrrr"))),
    "gen_fiscal": ("orders", (
        s.DenseKey("id"), s.Period("fiscal_year_period_nbr"), s.YearOf("fiscal_yr", "fiscal_year_period_nbr"),
        s.Period("from_1995", start_year=1995), s.NumberOf("division_nbr", "division_text"))),
    "gen_derived": ("part", (
        s.TextKey("profit_center_nbr", "PC", 6), s.Label("profit_center_nm", "Profit Center {profit_center_nbr}"),
        s.Label("profit_center_desc", "Description for {profit_center_nm}"),
        s.CodeOf("document_cd", tuple(v.DOCUMENT_TYPES), "id"),
        s.CodeOf("document_nm", tuple(v.DOCUMENT_TYPES.values()), "id"),
        s.Label("document_cd_nm", "{document_cd} - {document_nm}"), s.DenseKey("profit_center_id"),
        s.Pick("maybe", ("x",), null_rate=0.5), s.Label("maybe_nm", "maybe {maybe}"),
        s.PaddedId("company_cd", "company_code", 4, key="profit_center_id"),
        s.Constant("language_cd", "EN"))),
}
OPTION_SHOWCASE = {
    "gen_levels_ragged": ("gen_levels", s.Options(ragged=True)),
    "gen_enums_independent": ("gen_enums", s.Options(independent_codes=True)),
}

# A declared table every kind of whose columns gets other values than it declares.
REPLACED = (
    s.DenseKey("id"), s.Pick("territory", v.TERRITORIES), s.Pick("country_cd", v.COUNTRIES[:9]),
    s.Pick("country_nm", tuple(v.COUNTRY_NAMES.values())[:9]), s.Pick("etm_ind", (0, 1), (85, 15), type="int"),
    s.Whole("small", 1, 6), s.Amount("ledger_amt", -2_000_000, 5_000_000), s.Real("space", 500.0, 50_000.0),
    s.Day("valid_from", null_rate=0.1), s.Period("fiscal_year_period_nbr"), s.YearOf("fiscal_yr", "fiscal_year_period_nbr"),
    s.Cycle("in_blocks", v.ROLES, every=10), s.CodeOf("document_cd", tuple(v.DOCUMENT_TYPES), "id"),
    s.CodeOf("document_nm", tuple(v.DOCUMENT_TYPES.values()), "id"), s.Constant("language_cd", "EN"))
REPLACEMENTS = {
    "territory": {"values": ["north", "it's south"], "weights": [2, 5]},
    "country_cd+country_nm": {"pairs": [["XA", "Xandria"], ["XB", "Xebec"], ["XC", "Xcel"]], "weights": [6, 3, 1]},
    "etm_ind": {"values": [7, 8, 9]}, "small": {"min": -3, "max": 3}, "ledger_amt": {"min": "0.5", "max": "1.25"},
    "space": {"min": -1.5, "max": 2.5}, "valid_from": {"min": "2024-02-28", "max": "2024-03-01"},
    "fiscal_year_period_nbr": {"min": 201911, "max": 202102}, "in_blocks": {"values": ["a", "b", "c"]},
    "document_cd+document_nm": {"pairs": [["D1", "First"], ["D2", "Second"]]}, "language_cd": {"constant": "FR"},
}

# Driver table whose ids each catalogue table is generated over.
BUILD_OVER = {
    "general_ledger_fact": "orders", "cis_fact": "events", "consolidated_balance_sheet_fact": "events",
    "accounting_document_type": "nation", "version_forecast_mapping": "nation",
    "geo_marketplace_channel_dim": "nation",
    "functional_area": "supplier", "company_code": "supplier", "gl_account_dim": "supplier",
    "geo_wholesale_value_business_dim": "supplier", "gl_account_zfsm_measures_hierarchy_dim": "supplier",
    "gl_account_hierarchy": "supplier", "management_gl_account_hierarchy": "supplier",
    "consolidation_functional_area_hierarchy": "supplier",
    "cost_center_dim_v": "customer", "finance_customer_dim_v": "customer",
    "finance_foreign_currency_exchange_rate": "customer", "segment_cost_center_hierarchy_dim_v": "customer",
    "dischannel_cost_center_hierarchy_dim_v": "customer", "retail_global_store_profile_v": "customer",
    "consolidation_segment_hierarchy_dim": "customer",
    "profit_center": "part", "finance_product_dim_v": "part", "copa_attribution_dim": "part",
    "segment_profit_center_hierarchy": "part", "dischannel_profit_center_hierarchy": "part",
    "partdischannel_profit_center_hierarchy": "part",
}
# Tables with a fixed number of members: their rows repeat over a driver table's ids.
SEEDED = {"division_text": "nation", "division_text_dim_v": "nation", "atscale_geo_security": "customer"}


def project(spark: SparkSession, sf: str, source: str, spec: s.TableSpec, options: s.Options,
            columns: list[str] | None = None, domains=None) -> DataFrame:
    needed = {getattr(c, "table", None) for c in spec.columns} | {getattr(c, "domain", None) for c in spec.columns}
    rows = spec.max_rows or size(spark, sf, source)
    ids = row_ids_of(spark, sf, source)
    if spec.max_rows:
        ids = ids.selectExpr(f"({ROW_ID} - 1) % {spec.max_rows} + 1 AS {ROW_ID}").distinct()
        rows = min(rows, spec.max_rows)
    tune_session(spark)
    ids = dealt(ids, rows, len(columns or spec.fields()), ROW_ID)
    return project_table(ids, spec, rows, domain_sizes(spark, sf, needed), options=options, columns=columns,
                         domains=domains)


def generator(source: str, spec: s.TableSpec, options: s.Options = s.Options(), domains=None) -> tuple[Callable, str]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return project(spark, sf, source, spec, options, domains=domains)

    if spec.max_rows:
        ids = f"SELECT DISTINCT id FROM (SELECT (id - 1) % {spec.max_rows} + 1 AS id FROM ({ids_sql(source)}))"
        rows = str(spec.max_rows)
    else:
        ids, rows = ids_sql(source), f"(SELECT count(*) FROM {source})"
    return run, lambda: table_sql(ids, Rendering(spec, rows, domain_sql(), options=options, domains=domains))


def renamed(source: str, spec: s.TableSpec, names: dict[str, str]) -> tuple[Callable, Callable]:
    """A table under other column names, with one column of the caller's own."""
    kept = {old: new for old, new in names.items() if old in [name for name, _ in spec.fields()]}

    def run(spark: SparkSession, sf: str) -> DataFrame:
        sizes = domain_sizes(spark, sf)
        rows = size(spark, sf, source)
        ids = dealt(row_ids_of(spark, sf, source), rows, len(spec.fields()), ROW_ID)
        return project_table(ids, spec, rows, sizes, rename=kept,
                             extra=[("parity", F.expr(f"{ROW_ID} % 2"))])

    def sql() -> str:
        rendering = Rendering(spec, f"(SELECT count(*) FROM {source})", domain_sql())
        pairs = ", ".join(f'"{old}" AS "{new}"' for old, new in kept.items())
        key = spec.key[0]
        return f"SELECT * RENAME ({pairs}), \"{key}\" % 2 AS parity FROM ({table_sql(ids_sql(source), rendering)})"

    return run, sql


def generated_queries() -> dict[str, tuple[Callable, str]]:
    found = {}
    for name, (source, columns) in SHOWCASE.items():
        found[name] = generator(source, s.TableSpec(name, (), columns))
    for name, (shown, options) in OPTION_SHOWCASE.items():
        source, columns = SHOWCASE[shown]
        found[name] = generator(source, s.TableSpec(shown, (), columns), options)
    found["gen_domains_replaced"] = generator("orders", s.TableSpec("gen_domains_replaced", (), REPLACED),
                                              domains=REPLACEMENTS)
    for table, source in (BUILD_OVER | SEEDED).items():
        found[f"build_{table}"] = generator(source, TABLES[table])
    found["build_cost_center_dim_v_linked"] = generator(
        "customer", TABLES["cost_center_dim_v"], s.Options(link_codes=True))
    found["build_general_ledger_fact_independent"] = generator(
        "orders", TABLES["general_ledger_fact"], s.Options(independent_codes=True))
    shared = profit_center_hierarchy("profit_center_hierarchy", extra=(s.Pick("extra_cd", ("A", "B"), (3, 1)),))
    found["build_profit_center_hierarchy"] = generator("part", shared)
    found["build_company_code_renamed"] = renamed("supplier", TABLES["company_code"],
                                                  {"company_cd": "firm_code", "company_nm": "firm_name"})
    found["dataset_build_integrity"] = (dataset_build_integrity, dataset_build_integrity_sql)
    found["dataset_job_report"] = (dataset_job_report, dataset_job_report_sql)
    found["generated_star_integrity"] = (generated_star_integrity, generated_star_integrity_sql)
    return found


def generated_star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The ledger fact over the orders' ids and the keys of its dimensions, at the driver tables' sizes."""
    sizes = domain_sizes(spark, sf)
    fact = TABLES["general_ledger_fact"]
    references = sorted({column for _, column, _, _ in ledger_relations() + natural_relations()})
    tables = {"general_ledger_fact": project(spark, sf, "orders", fact, s.Options(), [*fact.key, *references])}
    for parent in dependencies("general_ledger_fact"):
        checked = sorted({column for _, _, table, column in ledger_relations() + natural_relations()
                          if table == parent})
        if checked:
            tables[parent] = (project_table(member_ids(spark, sf, parent), parent, sizes[parent], sizes, columns=checked)
                              if parent in DOMAIN_SOURCES
                              else build_table(spark, parent, sizes[parent], None, sizes, columns=checked))
    return tables


def ledger_relations() -> list[tuple[str, str, str, str]]:
    contract = contract_of("general_ledger_fact")
    return [("general_ledger_fact", r.column, r.ref_table, r.ref_column) for r in contract.relations]


def natural_relations() -> list[tuple[str, str, str, str]]:
    return [("general_ledger_fact", "profit_center_nbr", "profit_center", "profit_center_nbr"),
            ("general_ledger_fact", "functional_area_cd", "functional_area", "functional_area_cd"),
            ("general_ledger_fact", "company_cd", "company_code", "company_cd"),
            ("general_ledger_fact", "accounting_document_type_cd", "accounting_document_type",
             "accounting_document_type_cd")]


def generated_star_integrity(spark: SparkSession, sf: str) -> DataFrame:
    return integrity_report(spark, generated_star(spark, sf), {"general_ledger_fact": ("general_ledger_fact_id",)},
                            ledger_relations(), natural_relations())


# Rows that a parent lacks: suppliers in debt are no companies.
THINNED = {"company_code": "s_acctbal >= 0"}

# What the dataset job writes in its registered query: the fact and some of its dimensions.
DATASET_TABLES = ("general_ledger_fact", "calendar_fiscal_period_v", "profit_center", "company_code",
                  "gl_account_dim", "version_forecast_mapping")


def member_ids(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """The rows of a dimension: those of its driver table, of which a thinned one lost some."""
    source = DOMAIN_SOURCES[table]
    ids = read(spark, sf, source).where(THINNED.get(table, "true"))
    return ids.select((F.col(KEYS[source]).cast("bigint") + 1).alias(ROW_ID))


def job_sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    dimensions = [table for table in DATASET_TABLES if table in DOMAIN_SOURCES]
    return {"general_ledger_fact": row_ids_of(spark, sf, "orders")} | {
        table: member_ids(spark, sf, table) for table in dimensions}


def dataset_build_integrity(spark: SparkSession, sf: str) -> DataFrame:
    """Run the dataset job over the driver tables' rows, then check what was written.

    The suppliers in debt are no companies, so the ledger has orphans. Relations to tables that were not written are left
    out of the report.
    """
    volumes = Volumes({**domain_sizes(spark, sf), "general_ledger_fact": size(spark, sf, "orders")})
    place = passing_folder(spark, "dataset")
    written = build_dataset(spark, place, volumes, DATASET_TABLES, sources=job_sources(spark, sf))
    tables = {table: place.read(spark, table) for table in written}
    keys = {table: contract_of(table, spark).key for table in written}
    foreign, natural = ([r for r in relations if r[2] in tables]
                        for relations in (ledger_relations(), natural_relations()))
    return integrity_report(spark, tables, keys, foreign, natural)


def members_sql(table: str) -> str:
    """The numbers of a dimension's rows."""
    if table not in DOMAIN_SOURCES:
        return f"SELECT unnest(generate_series(1, {domain_sql()[table]})) AS n"
    source = DOMAIN_SOURCES[table]
    return f"SELECT {KEYS[source]}::BIGINT + 1 AS n FROM {source} WHERE {THINNED.get(table, 'true')}"


def dataset_build_integrity_sql() -> str:
    keys = [f"""SELECT 'key', '{table}', '{",".join(contract_key(table))}', '', count(*)::BIGINT,
  count(DISTINCT n)::BIGINT, (count(*) - count(DISTINCT n))::BIGINT FROM ({members_sql(table)})"""
            for table in DATASET_TABLES if table != "general_ledger_fact"]
    return star_report_sql([r for r in ledger_relations() if r[2] in DATASET_TABLES],
                           [r for r in natural_relations() if r[2] in DATASET_TABLES], keys)


def dataset_job_report(spark: SparkSession, sf: str) -> DataFrame:
    """A job in four runs: stopped after two tables, gone on with, run again, and refused with another plan.

    Per table the run that wrote it, its rows, and how many of the last run's plans were refused before a write.
    """
    volumes = Volumes({**domain_sizes(spark, sf), "general_ledger_fact": size(spark, sf, "orders")})
    place, sources = passing_folder(spark, "job"), job_sources(spark, sf)
    runs = [build_dataset(spark, place, volumes, DATASET_TABLES[2:4], sources=sources),
            build_dataset(spark, place, volumes, DATASET_TABLES, sources=sources, resume=True),
            build_dataset(spark, place, volumes, DATASET_TABLES, sources=sources, resume=True)]
    refused = 0
    fewer = sources | {"profit_center": sources["profit_center"].where(f"{ROW_ID} > 1")}
    for changes in ({"seed": 43, "sources": sources}, {"options": s.Options(independent_codes=True), "sources": sources},
                    {"sources": fewer}, {"sources": sources, "overrides": {"company_code": {"rows": 7}}}):
        try:
            runs.append(build_dataset(spark, place, volumes, DATASET_TABLES, resume=True, **changes))
        except PlanChanged:
            refused += 1
    wrote = {table: n for n, run in enumerate(runs, 1) for table in run}
    counts = [place.read(spark, table).select(F.lit(table).alias("table_name"), F.lit(wrote[table]).alias("written_in_run"))
              .groupBy("table_name", "written_in_run").agg(F.count(F.lit(1)).alias("row_count"))
              for table in DATASET_TABLES]
    return union_reports(counts).withColumn("runs", F.lit(len(runs))).withColumn("refused", F.lit(refused))


def dataset_job_report_sql() -> str:
    parts = []
    for table in DATASET_TABLES:
        rows = "SELECT 1 FROM orders" if table == "general_ledger_fact" else members_sql(table)
        run = 1 if table in DATASET_TABLES[2:4] else 2
        parts.append(f"SELECT '{table}' AS table_name, {run} AS written_in_run, count(*) AS row_count, 3 AS runs, 4 AS refused "
                     f"FROM ({rows})")
    return " UNION ALL ".join(parts)


def contract_key(table: str) -> tuple[str, ...]:
    return ("fiscal_year_period_nbr",) if table == "calendar_fiscal_period_v" else TABLES[table].key


def generated_star_integrity_sql() -> str:
    return star_report_sql(ledger_relations(), natural_relations(), [])


def star_report_sql(foreign: list[tuple], natural: list[tuple], more: list[str]) -> str:
    """Parents are the numbers of their driver tables' rows, less those that a thinned one lost."""
    rendering = Rendering(TABLES["general_ledger_fact"], "(SELECT count(*) FROM orders)", domain_sql())
    ctes = table_ctes(ids_sql("orders"), rendering, "fact")
    sizes = domain_sql()

    def parent_sql(table: str, column: str) -> str:
        numbers = members_sql(table)
        if table == "calendar_fiscal_period_v":
            return f"SELECT (2018 + (n - 1) // 12) * 100 + (n - 1) % 12 + 1 AS k FROM ({numbers})"
        prefix, pad = {"cost_center_nbr": ("CC_", 6), "gl_account_nbr": ("GL_", 6), "profit_center_nbr": ("PC_", 6),
                       "functional_area_cd": ("FA_", 4), "company_cd": ("", 4)}.get(column, (None, 0))
        if column == "accounting_document_type_cd":
            codes = ", ".join(f"'{c}'" for c in v.DOCUMENT_TYPES)
            return f"SELECT DISTINCT ([{codes}])[(n - 1) % 20 + 1] AS k FROM ({numbers})"
        if prefix is None:
            return f"SELECT n AS k FROM ({numbers})"
        width = f"greatest({pad}, length({sizes[table]}::VARCHAR))::INT"
        return f"SELECT '{prefix}' || lpad(n::VARCHAR, {width}, '0') AS k FROM ({numbers})"

    parts = ["""SELECT 'key' AS family, 'general_ledger_fact' AS table_name, 'general_ledger_fact_id' AS column_name,
  '' AS reference, count(*)::BIGINT AS row_count, count(DISTINCT general_ledger_fact_id)::BIGINT AS distinct_keys,
  (count(*) - count(DISTINCT general_ledger_fact_id))::BIGINT AS failures FROM fact"""]
    for family, relations in (("foreign_key", foreign), ("natural_key", natural)):
        for child, column, parent, parent_column in relations:
            parts.append(f"""SELECT '{family}', '{child}', '{column}', '{parent}.{parent_column}', count(*)::BIGINT,
  count(DISTINCT f."{column}")::BIGINT, count(*) FILTER (p.k IS NULL)::BIGINT
  FROM fact f LEFT JOIN ({parent_sql(parent, column)}) p ON f."{column}" = p.k""")
    union = "\nUNION ALL\n".join(parts + more)
    return f"""WITH {ctes},
checks AS ({union})
SELECT family, table_name, column_name, reference, row_count, distinct_keys, failures,
  CASE WHEN row_count = 0 THEN 'empty' WHEN failures = 0 THEN 'ok' ELSE 'failed' END AS status,
  failures = 0 AS ok FROM checks"""
