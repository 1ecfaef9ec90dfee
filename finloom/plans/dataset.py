"""The dataset job: which tables, how large, in which order, and the checks that belong to them."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.operators.checks import integrity_report
from finloom.operators.writer import BUILD_TUNING, TUNING, session_settings, write_table
from finloom.plans import calendar
from finloom.plans.specs import DEFAULT_SEED, Options, TextKey
from finloom.plans.tables import FACT_NAMES, ROW_ID, TABLES, build_table, find, project_table, table_names
from finloom.sources.contract import Contract, ContractColumn, ContractRelation
from finloom.sources.domains import read_domains
from finloom.sources.location import Location
from finloom.sources.rows import bucket_count, hash_sample, row_ids
from finloom.sources.volumes import Volumes

DIMENSION_ORDER = (
    "calendar_fiscal_period_v", "profit_center", "version_forecast_mapping", "functional_area",
    "finance_product_dim_v", "finance_customer_dim_v", "company_code", "copa_attribution_dim",
    "cost_center_dim_v", "geo_wholesale_value_business_dim", "geo_marketplace_channel_dim", "gl_account_dim",
    "gl_account_zfsm_measures_hierarchy_dim", "finance_foreign_currency_exchange_rate",
)
HIERARCHY_ORDER = (
    "segment_cost_center_hierarchy_dim_v", "segment_profit_center_hierarchy",
    "dischannel_cost_center_hierarchy_dim_v", "dischannel_profit_center_hierarchy", "division_text_dim_v",
)
CURRENT_TABLES = DIMENSION_ORDER + ("general_ledger_fact",) + HIERARCHY_ORDER
RETIRED_TABLES = tuple(name for name in table_names() if name not in CURRENT_TABLES)

# Columns that carry a parent's natural key without being declared relations.
NATURAL_KEYS = {
    "profit_center_nbr": ("profit_center", "profit_center_nbr"),
    "functional_area_cd": ("functional_area", "functional_area_cd"),
    "division_nbr": ("division_text", "division_nbr"),
    "fiscal_year_period_nbr": ("calendar_fiscal_period_v", "fiscal_year_period_nbr"),
}
# Ids are narrow, the rows made of them are not: about a million ids a task.
PLACED_TUNING = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"}
SECONDARY_FACTS = ("cis_fact", "consolidated_balance_sheet_fact")


@dataclass(frozen=True)
class Step:
    table: str
    rows: int
    partitions: int | None
    build: Callable[..., DataFrame]
    manifest: dict


class PlanChanged(RuntimeError):
    """A table was built to another plan than the one that is to go on."""


def referenced_column(column: str, ref_table: str) -> str:
    """The parent column a reference points at: its text key when the child holds text, else its key."""
    if ref_table == calendar.TABLE:
        return calendar.KEY
    spec = find(ref_table)
    text_keys = [c.name for c in spec.columns if isinstance(c, TextKey)]
    if column.endswith(("_nbr", "_cd")) and text_keys:
        return text_keys[0]
    return spec.key[0]


def contract_of(table: str, spark: SparkSession | None = None) -> Contract:
    """The contract a catalogue table is built to."""
    if table == calendar.TABLE:
        if spark is None:
            raise ValueError("the calendar's contract is read from its plan: pass a session")
        fields, key, relations = calendar.calendar_fields(spark), (calendar.KEY,), ()
    else:
        spec = find(table)
        fields, key = spec.fields(), spec.key
        relations = tuple(ContractRelation(r.column, r.ref_table, referenced_column(r.column, r.ref_table))
                          for r in spec.relations())
    columns = tuple(ContractColumn(name, kind, ("primary_key", "not_null") if name in key else ())
                    for name, kind in fields)
    return Contract(table, columns, relations)


def dependencies(table: str) -> list[str]:
    """Tables whose keys this one draws from."""
    if table == calendar.TABLE:
        return []
    found = []
    for column in find(table).columns:
        parent = getattr(column, "table", None) or getattr(column, "domain", None)
        if parent and parent != table and parent not in found:
            found.append(parent)
    return found


def plan(spark: SparkSession, volumes: Volumes, tables: Iterable[str] | None = None,
         with_dependencies: bool = False, seed: int = DEFAULT_SEED, domains=None,
         options: Options = Options(), sources: Mapping[str, DataFrame] | None = None) -> list[Step]:
    """Lazy builders in reading order: dimensions, facts, hierarchies.

    ``sources`` gives a table's row ids (column ``__row_id``) where they are not simply ``1..rows``.
    """
    sources = {name.lower(): ids for name, ids in (sources or {}).items()}
    wanted = [t.lower() for t in tables] if tables is not None else list(CURRENT_TABLES)
    unknown = [t for t in wanted if t not in table_names()]
    if unknown:
        raise KeyError(f"unknown tables {unknown}")
    if with_dependencies:
        for table in list(wanted):
            wanted += [parent for parent in dependencies(table) if parent not in wanted]
    order = list(CURRENT_TABLES) + list(RETIRED_TABLES)
    sizes = volumes.domain_sizes()

    def step(table: str) -> Step:
        rows, partitions = sizes.get(table, volumes.rows(table)), volumes.partitions(table)
        choices = {"seed": seed, "domains": domains, "options": options}
        manifest = {"rows": rows, "seed": seed, "options": asdict(options),
                    "domains": digest(read_domains(domains)),
                    "parents": {parent: sizes.get(parent) for parent in dependencies(table)}}
        if table in sources:
            ids = sources[table]
            manifest["source"] = ids_digest(ids)
        elif table not in TABLES:
            return Step(table, rows, partitions, lambda by=(): build_table(spark, table, rows, partitions, sizes, **choices),
                        manifest)
        else:
            ids = row_ids(spark, rows, partitions, ROW_ID, len(find(table).fields()))
        return Step(table, rows, partitions, lambda by=(): placed(ids, table, rows, sizes, by, choices), manifest)

    foreign = [name for name in sources if name not in TABLES]
    if foreign:
        raise KeyError(f"no row ids can be given for {foreign}")
    return [step(table) for table in sorted(set(wanted), key=lambda t: (_phase(t), order.index(t)))]


def placed(ids: DataFrame, table: str, rows: int, sizes: Mapping[str, int], by: Sequence[str], choices: Mapping
           ) -> DataFrame:
    """The table over its row ids; where it is to be partitioned, the ids are dealt first.

    A row follows from its id, so no more than the id and the partition columns crosses the network. All columns are made
    where the id arrives.
    """
    if by:
        keyed = project_table(ids, table, rows, sizes, columns=by, extra=[(ROW_ID, F.col(ROW_ID))], **choices)
        ids = keyed.hint("rebalance", *by).select(ROW_ID)
    return project_table(ids, table, rows, sizes, **choices)


def digest(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()[:16]


def ids_digest(ids: DataFrame) -> str:
    """The set of row ids, told by its size and the sum of its hashes: one scan, whatever the partitions."""
    size, total = ids.agg(F.count(ROW_ID), F.sum(F.xxhash64(ROW_ID).cast("decimal(38,0)"))).first()
    return f"{size}:{total}"


def _phase(table: str) -> int:
    if table in FACT_NAMES:
        return 1
    return 2 if table in HIERARCHY_ORDER else 0


def build_dataset(
    spark: SparkSession,
    location: Location | None,
    volumes: Volumes | Mapping | str | None = None,
    tables: Iterable[str] | None = None,
    overrides: Mapping[str, Mapping] | None = None,
    mode: str | None = None,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    with_dependencies: bool = False,
    skip_existing: bool = False,
    resume: bool = False,
    **choices,
) -> list[str]:
    """Write the chosen tables and return their names in order.

    A location or mode of None is what the volumes' ``environment`` says. ``overrides`` hold for this run only. Each finished table keeps a manifest of what it was built to. ``resume`` lets a
    job that was stopped go on: tables that are finished to this plan stay, those that were begun are built again, and
    where one was finished to another plan ``PlanChanged`` is raised before anything is written. ``skip_existing`` leaves
    out every table that is there, however it came about.
    """
    volumes = volumes if isinstance(volumes, Volumes) else Volumes(volumes)
    location, mode = location or volumes.place(), mode or volumes.write_mode()
    if location is None:
        raise ValueError("give a location, or name one in the environment of the volumes")
    if resume and mode != "overwrite":
        raise ValueError("a job that appends can't be resumed: what it has appended would come twice")
    volumes = volumes.with_overrides(overrides, table_names())
    location.ensure(spark)
    settings = TUNING | BUILD_TUNING | PLACED_TUNING
    settings["spark.sql.shuffle.partitions"] = str(volumes.shuffle_partitions())
    written = []
    with session_settings(spark, settings):
        steps = plan(spark, volumes, tables, with_dependencies, **choices)
        manifests = {}
        for step in steps:
            keys = list((partition_by or {}).get(step.table, ()))
            manifests[step.table] = step.manifest | {"partition_by": keys, "columns": digest(
                [contract.type for contract in contract_of(step.table, spark).columns])}
        finished = unchanged(spark, location, manifests) if resume else set()
        for step in steps:
            if step.table in finished or skip_existing and location.exists(spark, step.table):
                continue
            manifest = manifests[step.table]
            by = manifest["partition_by"]
            write_table(step.build(by), location, step.table, mode, by, rebalanced=step.table in TABLES)
            if mode == "overwrite":
                location.note(spark, step.table, MANIFEST, json.dumps(manifest, sort_keys=True, default=str))
            written.append(step.table)
    return written


MANIFEST = "built"


def unchanged(spark: SparkSession, location: Location, manifests: Mapping[str, dict]) -> set[str]:
    """The tables that are finished to their manifest; raises where one was finished to another."""
    finished, changed = set(), []
    for table, manifest in manifests.items():
        noted = location.noted(spark, table, MANIFEST)
        if noted is None:
            continue
        now, then = json.loads(json.dumps(manifest, default=str)), json.loads(noted)
        apart = sorted(name for name in now.keys() | then.keys() if now.get(name) != then.get(name))
        if apart:
            changed.append(f"{table}: " + ", ".join(f"{n} was {then.get(n)}, is {now.get(n)}" for n in apart))
        finished.add(table)
    if changed:
        raise PlanChanged("; ".join(changed))
    return finished


CENTRAL_FACT = "general_ledger_fact"


def verify_dataset(spark: SparkSession, location: Location, tables: Iterable[str] | None = None,
                   sample_rows: int | None = None) -> DataFrame:
    """One report on a written dataset: keys, the central fact's references, the secondary facts' natural keys.

    Checks of absent tables are rows with status ``skipped``. ``sample_rows`` checks references on about so many
    rows per fact, always the same ones; their passing rows then say ``sampled 1/n`` in place of ``ok``.
    """
    found = {name: location.find(spark, name) for name in (tables or table_names())}
    present = {name: df for name, df in found.items() if df is not None}
    keys = {name: contract_of(name, spark).key for name in present}

    def sample(name: str, df: DataFrame) -> DataFrame:
        if sample_rows is None:
            return df
        return hash_sample(df, list(keys[name]), buckets[name])

    facts = [name for name in (CENTRAL_FACT, *SECONDARY_FACTS) if name in present]
    buckets = {name: bucket_count(present[name].count(), sample_rows) for name in facts} if sample_rows else {}
    foreign = [(CENTRAL_FACT, r.column, r.ref_table, r.ref_column) for r in contract_of(CENTRAL_FACT).relations]
    natural = [(fact, column, *parent) for fact in SECONDARY_FACTS for column, parent in NATURAL_KEYS.items()]
    keys |= {name: contract_of(name, spark).key for name in found if name not in present}
    report = integrity_report(spark, present, keys, foreign, natural, sample)
    for name, n in buckets.items():
        if n > 1:
            thinned = (F.col("table_name") == name) & F.col("family").isin("foreign_key", "natural_key")
            report = report.withColumn("status", F.when(thinned & (F.col("status") == "ok"), f"sampled 1/{n}")
                                       .otherwise(F.col("status")))
    return report
