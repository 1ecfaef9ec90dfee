"""Integrity checks. Each returns a lazy report DataFrame with one row per check."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.functions.values import sql_literal

REPORT_COLUMNS = ("family", "table_name", "column_name", "reference", "row_count", "distinct_keys",
                  "failures", "status", "ok")


def _report(counts: DataFrame, family: str, table: str, column: str, reference: str, ok: str) -> DataFrame:
    """One report row from a one-row frame of (row_count, distinct_keys, failures); ``ok`` is SQL over those."""
    labels = [f"{sql_literal(text)} AS {name}" for name, text in
              zip(REPORT_COLUMNS, (family, table, column, reference))]
    return counts.selectExpr(
        *labels, "row_count", "distinct_keys", "failures",
        f"CASE WHEN row_count = 0 THEN 'empty' WHEN {ok} THEN 'ok' ELSE 'failed' END AS status",
        f"coalesce({ok}, false) AS ok")


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{name}`" for name in names]


UNIQUE = "failures = 0 AND row_count > 0"


def key_check(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Is the key unique and never NULL, and is there any row?

    Rows are counted per key before anything is compared, so a key that fills a
    third of the table is folded map-side.
    """
    label = ",".join(keys)
    named = [f"key_{i}" for i in range(len(keys))]  # the key's own names may be anything
    present = " AND ".join(f"{name} IS NOT NULL" for name in named)
    counts = (df.selectExpr(*[f"{key} AS {name}" for key, name in zip(_quoted(keys), named, strict=True)])
              .groupBy(*named).agg(F.expr("count(1) AS n"))
              .agg(F.expr("coalesce(sum(n), 0L) AS row_count"),
                   F.expr(f"count_if({present}) AS distinct_keys"))
              .selectExpr("row_count", "distinct_keys", "row_count - distinct_keys AS failures"))
    return _report(counts, "key", table, label, "", UNIQUE)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def reference_check(fact: DataFrame, table: str, column: str, ref: DataFrame, ref_table: str, ref_column: str,
                    nulls_are_orphans: bool = True) -> DataFrame:
    """How many rows point at no parent?

    The fact is folded to one row per key value before the join: only one
    column is read, a hot key costs no more than a rare one, the join reuses
    the grouping's partitioning, and duplicated parents cannot inflate counts.
    """
    grouped = fact.groupBy(F.col(column).alias("child_key")).agg(F.expr("count(1) AS n"))
    parents = ref.select(F.col(ref_column).alias("parent_key")).where("parent_key IS NOT NULL").distinct()
    orphan = "parent_key IS NULL" + ("" if nulls_are_orphans else " AND child_key IS NOT NULL")
    counts = (grouped.join(parents, F.expr("child_key = parent_key"), "left")
              .agg(F.expr("coalesce(sum(n), 0L) AS row_count"),
                   F.expr("count(child_key) AS distinct_keys"),
                   F.expr(f"coalesce(sum(n) FILTER (WHERE {orphan}), 0L) AS failures")))
    family = "foreign_key" if nulls_are_orphans else "natural_key"
    return _report(counts, family, table, column, f"{ref_table}.{ref_column}", "failures = 0")


def orphan_rows(fact: DataFrame, column: str, ref: DataFrame, ref_column: str,
                nulls_are_orphans: bool = True) -> DataFrame:
    """The rows that point at no parent. The parent side is left as stored, so adaptive skew splitting applies."""
    parents = ref.select(F.col(ref_column).alias("parent_key"))
    present = fact.where(F.col(column).isNotNull())
    orphans = present.join(parents, F.col(column) == F.col("parent_key"), "left_anti")
    # NULL keys match nothing: they are not shuffled to find that out.
    return orphans.unionByName(fact.where(F.col(column).isNull())) if nulls_are_orphans else orphans


def orphan_keys(fact: DataFrame, column: str, ref: DataFrame, ref_column: str) -> DataFrame:
    """The key values without a parent and how many rows carry each."""
    grouped = fact.groupBy(F.col(column).alias("child_key")).agg(F.count(F.lit(1)).alias("row_count"))
    return orphan_rows(grouped, "child_key", ref, ref_column)


def row_counts(spark: SparkSession, load: Callable[[str], DataFrame], tables: Iterable[str]) -> DataFrame:
    """Rows per table, counted now; a table that cannot be found, read or counted becomes a row with its reason."""
    rows = []
    for table in tables:
        try:
            rows.append((table, load(table).count(), "ok"))
        except PySparkException as error:
            rows.append((table, None, error.getCondition() or "unreadable"))
        except Py4JJavaError as error:  # what a task met, passed on without a condition
            rows.append((table, None, error.java_exception.getClass().getSimpleName()))
    return spark.createDataFrame(rows, "table_name string, row_count bigint, status string")


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    if not reports:
        raise ValueError("no checks to report")
    return reduce(DataFrame.unionByName, reports)


class IntegrityError(AssertionError):
    """A report holds failed checks."""


def require_ok(report: DataFrame, shown: int = 50, skipped_ok: bool = False) -> None:
    """Raise unless every check of the report passed. Empty fact samples count as passed, empty keys do not.

    A skipped check has no verdict; it raises too unless ``skipped_ok``.
    """
    bad = ~F.coalesce("ok", F.lit(skipped_ok))
    failed = report.where(bad).limit(shown + 1).collect()
    if failed:
        lines = [", ".join(f"{k}={v}" for k, v in row.asDict().items() if v not in ("", None))
                 for row in failed[:shown]]
        if len(failed) > shown:
            lines.append(f"and more: {report.where(bad).count()} in all, {shown} shown")
        raise IntegrityError("failed checks:\n" + "\n".join(lines))


@dataclass(frozen=True)
class KeyCheck:
    table: str
    df: DataFrame
    keys: tuple[str, ...]


@dataclass(frozen=True)
class ReferenceCheck:
    table: str
    df: DataFrame
    column: str
    ref_table: str
    ref: DataFrame
    ref_column: str
    nulls_are_orphans: bool = True


INTEGRAL = ("tinyint", "smallint", "int", "bigint")
FOLDED = (*INTEGRAL, "string")


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


@dataclass(frozen=True)
class _Side:
    """One side of a check: a column of a table, counted for a child and flagged for a parent."""

    df: DataFrame
    check: int
    column: str
    integral: bool
    child: bool

    def entry(self) -> str:
        number = f"cast(`{self.column}` AS bigint)" if self.integral else "cast(NULL AS bigint)"
        text = "cast(NULL AS string)" if self.integral else f"`{self.column}`"
        return (f"named_struct('check', {self.check}, 'number', {number}, 'text', {text}, 'n', {int(self.child)}L, "
                f"'parent', {str(not self.child).lower()})")


def _key_rows(sides: Sequence[_Side], one_scan: bool) -> list[DataFrame]:
    """(check, number, text, n, parent) of all sides; with ``one_scan`` a table is scanned once, whatever hangs on it.

    Each row is then unfolded into one entry a check, which the grouping folds again before anything is shuffled.
    """
    shared: list[list[_Side]] = []
    by_hash: dict[int, list[list[_Side]]] = {}
    for side in sides:
        alike = by_hash.setdefault(side.df.semanticHash(), [])
        # Plans are the same under any names, so names are compared as well.
        same = next((group for group in alike
                     if one_scan and group[0].df.columns == side.df.columns and group[0].df.sameSemantics(side.df)), None)
        if same is None:
            same = []
            alike.append(same)
            shared.append(same)
        same.append(side)
    parts = []
    for group in shared:
        entries = f"array({', '.join(side.entry() for side in group)})"
        if not all(side.child for side in group):  # a parent's NULL is no key
            entries = f"filter({entries}, x -> NOT x.parent OR x.number IS NOT NULL OR x.text IS NOT NULL)"
        parts.append(group[0].df.selectExpr(f"inline({entries})"))
    return parts


def run_checks(spark: SparkSession, wanted: Sequence[KeyCheck | ReferenceCheck], one_scan: bool = False) -> DataFrame:
    """All checks in one report; single whole-number and text keys in one pass, every other key natively on its own.

    In the shared pass the keys of every table meet in a single grouping. A scan reads the column of one check alone, or
    with ``one_scan`` those of all checks of its table: the same bytes, but what a table is computed from (a sample, a
    join) is then computed once. Children bring a count per key value and
    parents a flag, so an orphan is a group without a flag and no join is needed. However many checks there are, it
    takes one shuffle of map-side folded keys and a tiny second one, and no key value, however frequent, lands on
    one task as rows. Composite keys and other types are grouped by their own columns: a value is never turned into
    text, so what counts as equal is what a grouping or a join calls equal.
    """
    sides, labels, apart = [], [], []
    for item in wanted:
        check = len(labels)
        if isinstance(item, KeyCheck):
            kind = _type(item.df, item.keys[0])
            if len(item.keys) > 1 or kind not in FOLDED:
                apart.append(key_check(item.df, item.table, item.keys))
                continue
            sides.append(_Side(item.df, check, item.keys[0], kind in INTEGRAL, True))
            labels.append(("key", item.table, item.keys[0], ""))
            continue
        kinds = {_type(item.df, item.column), _type(item.ref, item.ref_column)}
        integral = kinds <= set(INTEGRAL)
        if not integral and kinds != {"string"}:
            apart.append(reference_check(item.df, item.table, item.column, item.ref, item.ref_table, item.ref_column,
                                         item.nulls_are_orphans))
            continue
        sides.append(_Side(item.df, check, item.column, integral, True))
        sides.append(_Side(item.ref, check, item.ref_column, integral, False))
        labels.append(("foreign_key" if item.nulls_are_orphans else "natural_key", item.table, item.column,
                       f"{item.ref_table}.{item.ref_column}"))
    if not labels:
        return union_reports(apart)
    parts = _key_rows(sides, one_scan)
    # One empty row per check keeps the checks of empty tables in the report.
    parts.append(spark.range(0, len(labels), 1, 1).selectExpr(
        "cast(id AS int) AS check", "cast(NULL AS bigint) AS number", "cast(NULL AS string) AS text",
        "0L AS n", "false AS parent"))
    named = ", ".join(f"struct({', '.join(sql_literal(text) for text in label)})" for label in labels)
    counted = (union_reports(parts)
               .groupBy("check", "number", "text")
               .agg(F.expr("sum(n) AS n"), F.expr("bool_or(parent) AS parent"))
               .selectExpr("check", "n", "parent", "number IS NOT NULL OR text IS NOT NULL AS present")
               .groupBy("check")
               .agg(F.expr("sum(n) AS row_count"),
                    F.expr("count_if(present AND n > 0) AS distinct_keys"),
                    F.expr("coalesce(sum(n) FILTER (WHERE NOT parent), 0L) AS unmatched"),
                    F.expr("coalesce(sum(n) FILTER (WHERE NOT parent AND present), 0L) AS unmatched_present"))
               .selectExpr(f"get(array({named}), check) AS label", "row_count", "distinct_keys", "unmatched",
                           "unmatched_present"))
    report = (counted
              .selectExpr("label.col1 AS family", "label.col2 AS table_name", "label.col3 AS column_name",
                          "label.col4 AS reference", "row_count", "distinct_keys",
                          """CASE label.col1 WHEN 'key' THEN row_count - distinct_keys
                             WHEN 'foreign_key' THEN unmatched ELSE unmatched_present END AS failures""")
              .withColumn("ok", F.expr("failures = 0 AND (row_count > 0 OR family <> 'key')"))
              .withColumn("status", F.expr("CASE WHEN row_count = 0 THEN 'empty' WHEN ok THEN 'ok' ELSE 'failed' END"))
              .select(*REPORT_COLUMNS))
    return union_reports([report, *apart])


def integrity_report(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    foreign_keys: Iterable[tuple[str, str, str, str]],
    natural_keys: Iterable[tuple[str, str, str, str]] = (),
    sample: Callable[[str, DataFrame], DataFrame] = lambda table, df: df,
) -> DataFrame:
    """All checks in one report; a check whose table is absent is a row with status ``skipped`` and no verdict.

    Foreign and natural keys are (table, column, parent table, parent column).
    ``sample`` may thin a fact before its references are checked.
    """
    wanted, skipped, thinned = [], [], {}
    for name, key in keys.items():
        if name in tables and key:
            wanted.append(KeyCheck(name, tables[name], tuple(key)))
        elif key:
            skipped.append(("key", name, ",".join(key), ""))
    for relations, nulls in ((foreign_keys, True), (natural_keys, False)):
        for child, column, parent, parent_column in relations:
            if child in tables and parent in tables:
                if child not in thinned:
                    thinned[child] = sample(child, tables[child])
                wanted.append(ReferenceCheck(child, thinned[child], column, parent, tables[parent],
                                             parent_column, nulls))
            else:
                skipped.append(("foreign_key" if nulls else "natural_key", child, column, f"{parent}.{parent_column}"))
    reports = [run_checks(spark, wanted, one_scan=True)] if wanted else []
    if skipped:
        names = ", ".join(f"struct({', '.join(sql_literal(text) for text in label)})" for label in skipped)
        counts = [f"cast(NULL AS bigint) AS {name}" for name in ("row_count", "distinct_keys", "failures")]
        reports.append(spark.range(1).selectExpr(f"inline(array({names})) AS (family, table_name, column_name, reference)")
                       .selectExpr("*", *counts, "'skipped' AS status", "cast(NULL AS boolean) AS ok"))
    return union_reports(reports)
