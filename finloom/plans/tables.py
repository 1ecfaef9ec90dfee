"""The table catalogue and the builder that turns one declaration into a DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from finloom.plans import calendar
from finloom.plans.dimensions import DIMENSIONS
from finloom.plans.facts import FACTS
from finloom.plans.hierarchies import HIERARCHIES
from finloom.plans.specs import DEFAULT_SEED, Build, Options, TableSpec
from finloom.sources.domains import read_domains
from finloom.sources.rows import row_ids

ROW_ID = "__row_id"
TABLES: dict[str, TableSpec] = {spec.name: spec for spec in DIMENSIONS + FACTS + HIERARCHIES}
FACT_NAMES = tuple(spec.name for spec in FACTS)


def table_names() -> list[str]:
    return [calendar.TABLE, *TABLES]


def find(name: str) -> TableSpec:
    spec = TABLES.get(name.lower())
    if spec is None:
        raise KeyError(f"unknown table {name}")
    return spec


def check_domain_names(domains: Iterable[str], spec: TableSpec) -> None:
    """Raise for names that are no column of any table, so that a misspelt one is not passed over.

    One set of domains may serve several tables: a name need not be a column of the table at hand.
    """
    columns = {one.name: {name for name, _ in one.fields()} for one in (*TABLES.values(), spec)}
    known = set().union(*columns.values())
    strange = [name for name in domains if (name not in known if "." not in name
                                            else name.split(".", 1)[1] not in columns.get(name.split(".", 1)[0], ()))]
    if strange:
        raise KeyError(f"domains for columns that no table has: {strange}")


def project_table(
    source: DataFrame,
    spec: TableSpec | str,
    rows: int,
    sizes: Mapping[str, int] | None = None,
    *,
    row_id: str = ROW_ID,
    seed: int = DEFAULT_SEED,
    domains=None,
    options: Options = Options(),
    extra: Sequence[tuple[str, Column]] = (),
    columns: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Generate a table over any DataFrame holding the ids ``1..rows``, once each.

    ``extra`` adds (name, Column over the row id) pairs, ``columns`` keeps a
    subset and ``rename`` changes names; all in the same select.
    """
    spec = find(spec) if isinstance(spec, str) else spec
    chosen = read_domains(domains)
    check_domain_names(chosen, spec)
    build = Build(spec.name, rows, row_id, sizes or {}, seed, chosen, options)
    made = spec.project(source, build, columns, extra)
    return made.withColumnsRenamed(dict(rename)) if rename else made


def build_table(spark: SparkSession, name: str, rows: int, partitions: int | None = None,
                sizes: Mapping[str, int] | None = None, **choices) -> DataFrame:
    """Generate ``rows`` rows of a catalogue table; the values do not depend on ``partitions``."""
    if name.lower() == calendar.TABLE:
        options = choices.get("options") or Options()
        periods = calendar.calendar(spark, rows, options.start_year, options.years)
        return periods.select(*choices["columns"]) if choices.get("columns") else periods
    width = len(choices.get("columns") or find(name).fields())
    return project_table(row_ids(spark, rows, partitions, ROW_ID, width), name, rows, sizes, **choices)
