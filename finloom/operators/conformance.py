"""Conformance checks: does the data look the way its declaration says?

Each check over a table is one scan with one partial aggregate per rule; the
single wide row is then turned into one report row per rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.functions import parse_text_key, template_regex
from finloom.functions.values import clamp_rate, sql_literal
from finloom.operators.checks import union_reports
from finloom.sources.contract import Contract, spark_type


def tally(df: DataFrame, table: str, rules: Mapping[tuple[str, str], Column],
          applies: Mapping[tuple[str, str], Column] | None = None) -> DataFrame:
    """Rows per rule: (table_name, column_name, rule, row_count, failures).

    A rule is the condition of a failing row; ``applies`` narrows the rows counted.
    """
    names = list(rules)
    applies = applies or {}
    counted = [F.count_if(rules[name]).alias(f"f{i}") for i, name in enumerate(names)]
    seen = [(F.count_if(applies[name]) if name in applies else F.count(F.lit(1))).alias(f"r{i}")
            for i, name in enumerate(names)]
    entries = [F.struct(F.lit(column).alias("column_name"), F.lit(rule).alias("rule"),
                        F.col(f"r{i}").alias("row_count"), F.col(f"f{i}").alias("failures"))
               for i, (column, rule) in enumerate(names)]
    return (df.agg(*counted, *seen)
            .select(F.inline(F.array(*entries)))
            .select(F.lit(table).alias("table_name"), "column_name", "rule", "row_count", "failures"))


def _with_ok(report: DataFrame) -> DataFrame:
    return report.withColumn("ok", F.col("failures") == 0)


def domain_check(df: DataFrame, table: str, domains: Mapping[str, Sequence]) -> DataFrame:
    """Every non-NULL value is in its list."""
    rules = {(column, "in_domain"): F.coalesce(~F.col(column).isin(*values), F.lit(False))
             for column, values in domains.items()}
    present = {(column, "in_domain"): F.col(column).isNotNull() for column in domains}
    return _with_ok(tally(df, table, rules, present))


def domain_offenders(df: DataFrame, column: str, domain: DataFrame, domain_column: str) -> DataFrame:
    """Values outside a domain table, with their row counts; folded per value before the join."""
    seen = (df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count")))
    allowed = domain.select(F.col(domain_column).alias("allowed"))
    return seen.join(allowed, F.col("value") == F.col("allowed"), "left_anti")


def weight_check(df: DataFrame, table: str, column: str, values: Sequence, weights: Sequence[int],
                 tolerance: float) -> DataFrame:
    """Observed share of every listed value against weight / sum of weights; NULLs do not count."""
    total = sum(weights)
    counted = [F.count_if(F.col(column) == value).alias(f"n{i}") for i, value in enumerate(values)]
    entries = [F.struct(F.lit(str(value)).alias("value"), F.col(f"n{i}").alias("row_count"),
                        F.lit(weight / total).alias("expected_share"))
               for i, (value, weight) in enumerate(zip(values, weights))]
    share = F.when(F.col("rows_present") > 0, F.col("row_count") / F.col("rows_present"))
    return (df.agg(*counted, F.count(column).alias("rows_present"))
            .select("rows_present", F.inline(F.array(*entries)))
            .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "value", "row_count",
                    "expected_share", share.alias("observed_share"))
            .withColumn("ok", F.coalesce(F.abs(F.col("observed_share") - F.col("expected_share")) <= tolerance,
                                         F.lit(False))))


def null_rate_check(df: DataFrame, table: str, declared: Mapping[str, float], tolerance: float = 0.0) -> DataFrame:
    """Observed against declared NULL fraction."""
    rates = {column: clamp_rate(rate) for column, rate in declared.items()}
    report = tally(df, table, {(column, "null_rate"): F.col(column).isNull() for column in rates})
    expected = F.element_at(F.create_map(*[x for c, r in rates.items() for x in (F.lit(c), F.lit(r))]),
                            F.col("column_name"))
    return (report
            .withColumn("declared_rate", expected)
            .withColumn("observed_rate", F.when(F.col("row_count") > 0, F.col("failures") / F.col("row_count")))
            .withColumn("ok", F.coalesce(F.abs(F.col("observed_rate") - F.col("declared_rate")) <= tolerance,
                                         F.lit(True)))
            .select("table_name", "column_name", "row_count", F.col("failures").alias("null_count"),
                    "declared_rate", "observed_rate", "ok"))


def template_check(df: DataFrame, table: str, templates: Mapping[str, str]) -> DataFrame:
    """Every non-NULL value has the shape of its template."""
    rules = {(column, template): F.coalesce(~F.col(column).rlike(template_regex(template)), F.lit(False))
             for column, template in templates.items()}
    present = {(column, template): F.col(column).isNotNull() for column, template in templates.items()}
    return _with_ok(tally(df, table, rules, present))


def range_check(df: DataFrame, table: str, ranges: Mapping[str, tuple], ordered: Sequence[tuple[str, str]] = ()
                ) -> DataFrame:
    """Values stay inside [low, high], and each (earlier, later) pair is in strict order; NULLs pass."""
    rules = {(column, "range"): F.coalesce(~F.col(column).between(low, high), F.lit(False))
             for column, (low, high) in ranges.items()}
    rules |= {(f"{first}<{second}", "order"): F.coalesce(~(F.col(first) < F.col(second)), F.lit(False))
              for first, second in ordered}
    return _with_ok(tally(df, table, rules))


def key_round_trip(df: DataFrame, table: str, key: str, number: str, prefix: str) -> DataFrame:
    """The text key parses back to its id, and no two ids share a key.

    Counted per key first, so a key cut short by its pad shows as a collision.
    """
    parsed = parse_text_key(F.col(key), prefix)
    folded = df.groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~parsed.eqNullSafe(F.col(number).cast("bigint"))).alias("wrong"),
        F.min(number).alias("low"), F.max(number).alias("high"))
    return (folded.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
                       F.count("key").alias("distinct_keys"),
                       F.coalesce(F.sum("wrong"), F.lit(0)).cast("bigint").alias("mismatches"),
                       F.count_if(F.col("low") != F.col("high")).alias("collisions"))
            .select(F.lit(table).alias("table_name"), F.lit(key).alias("column_name"), "row_count",
                    "distinct_keys", "mismatches", "collisions",
                    ((F.col("mismatches") == 0) & (F.col("collisions") == 0)).alias("ok")))


def contract_check(spark: SparkSession, df: DataFrame, contract: Contract) -> DataFrame:
    """Columns present, absent, extra or of another type, and NULLs in required columns."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    findings = []
    for column in contract.columns:
        wanted = spark_type(column.type).simpleString()
        found = actual.get(column.name)
        rule = "missing" if found is None else "type"
        findings.append((contract.name, column.name, rule, wanted, found or "", 0 if found == wanted else 1))
    declared = {c.name for c in contract.columns}
    findings += [(contract.name, name, "extra", "", kind, 1) for name, kind in actual.items()
                 if name not in declared]
    fields = ("table_name", "column_name", "rule", "expected", "actual")
    entries = [", ".join(f"'{name}', {sql_literal(text)}" for name, text in zip(fields, finding))
               + f", 'failures', {finding[-1]}L" for finding in findings]
    literal = ", ".join(f"named_struct({entry})" for entry in entries)
    shape = spark.range(1).selectExpr(f"inline(array({literal}))")
    required = [c.name for c in contract.columns if c.is_required and c.name in actual]
    parts = [shape]
    if required:
        nulls = tally(df, contract.name, {(c, "required"): F.col(c).isNull() for c in required})
        parts.append(nulls.select("table_name", "column_name", "rule", F.lit("not null").alias("expected"),
                                  F.lit("").alias("actual"), "failures"))
    return _with_ok(union_reports(parts))
