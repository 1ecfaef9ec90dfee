"""Data against declared contracts: tables, columns, types, NULLs, keys and references, in one report.

Contracts are compiled into checks first (``compile_checks``): what the schemas alone decide is decided there, without
reading a row. What is left is read with as few passes as it takes: one scan of a table for all its required columns,
and one shared grouping for all keys and references of all tables.

One row per check: ``table_name, column_name, rule, expected, actual, row_count, failures, status, ok``.

==============  ==================================================================================================
``table``       the table is there
``column``      a declared column is absent
``type``        a declared column has the declared type
``extra``       a column is not declared
``not_null``    a required column (keys are) holds no NULL
``key``         the key is unique and never NULL
``reference``   every value that is not NULL has a parent
``parent_key``  a reference points at something else than the whole key of its parent
``cycle``       tables refer to each other in a circle, so no order loads parents first
==============  ==================================================================================================

A check that needs an absent table or column is ``skipped``, with the reason in ``actual``, and has no verdict.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.functions.values import sql_literal
from finloom.operators.checks import INTEGRAL, KeyCheck, ReferenceCheck, run_checks, union_reports
from finloom.operators.conformance import tally
from finloom.sources.contract import Contract, base_type, spark_type

COLUMNS = ("table_name", "column_name", "rule", "expected", "actual", "row_count", "failures", "status", "ok")
PLAIN = {kind().simpleString() for kind in (T.ByteType, T.ShortType, T.BinaryType, T.TimestampType, T.TimestampNTZType)}
KNOWN = {"bigint", "long", "int", "integer", "float", "double", "date", "boolean", "decimal", "string"}


def declared_type(declared: str) -> str:
    """The Spark type a contract asks for. Beyond the contract's own names, Spark's plain types and arrays may be declared.

    Needs no session.
    """
    text = declared.lower().strip()
    if text.startswith("array<") and text.endswith(">"):
        return f"array<{declared_type(text.removeprefix('array<').removesuffix('>'))}>"
    if base_type(text) not in KNOWN and text in PLAIN:
        return text
    return spark_type(text).simpleString()


def cycles(contracts: Mapping[str, Contract]) -> list[tuple[str, ...]]:
    """Groups of tables that refer to each other in a circle, sorted; a table that refers to itself is one."""
    parents = {name: {r.ref_table for r in contract.relations} & set(contracts) for name, contract in contracts.items()}

    def above(start: str) -> set[str]:
        found, waiting = set(), [start]
        while waiting:
            for parent in parents[waiting.pop()] - found:
                found.add(parent)
                waiting.append(parent)
        return found

    reached = {name: above(name) for name in contracts}
    return sorted({tuple(sorted(other for other in reached[name] if name in reached[other]))
                   for name in contracts if name in reached[name]})


def load_order(contracts: Mapping[str, Contract]) -> list[str]:
    """The tables, parents first; raises where they refer to each other in a circle."""
    circles = [group for group in cycles(contracts) if len(group) > 1]
    if circles:
        raise ValueError(f"no order loads parents first: {circles}")
    order: list[str] = []

    def place(name: str) -> None:
        if name not in order:
            for relation in contracts[name].relations:
                if relation.ref_table in contracts and relation.ref_table != name:
                    place(relation.ref_table)
            order.append(name)

    for name in contracts:
        place(name)
    return order


@dataclass
class Checks:
    """Compiled contracts: verdicts that need no rows, and the checks that do."""

    decided: list[tuple] = field(default_factory=list)
    required: dict[str, list[str]] = field(default_factory=dict)
    keys: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    references: list[tuple[str, str, str, str]] = field(default_factory=list)

    def decide(self, table: str, column: str, rule: str, expected: str, actual: str, failures: int | None,
               status: str | None = None) -> None:
        status = status or ("failed" if failures else "ok")
        self.decided.append((table, column, rule, expected, actual, None, failures, status,
                             None if status == "skipped" else status == "ok"))


def compile_checks(contracts: Mapping[str, Contract], schemas: Mapping[str, T.StructType | None]) -> Checks:
    """The checks of some contracts over tables with these schemas (None: no such table)."""
    checks = Checks()
    kinds = {name: {f.name: f.dataType.simpleString() for f in schema.fields} if schema is not None else None
             for name, schema in schemas.items()}
    for name, contract in contracts.items():
        actual = kinds.get(name)
        checks.decide(name, "", "table", "", "" if actual is not None else "absent", int(actual is None))
        if actual is not None:
            columns_of(checks, contract, actual)
        key = contract.key
        if key:
            lost = [column for column in key if column not in (actual or {})]
            if lost:
                checks.decide(name, ",".join(key), "key", "", "absent: " + ",".join(lost) if actual else "absent", None,
                              "skipped")
            else:
                checks.keys.append((name, key))
        for relation in contract.relations:
            reference_of(checks, contract, relation, actual, kinds.get(relation.ref_table),
                         contracts.get(relation.ref_table))
    for group in cycles(contracts):
        checks.decide(group[0], "", "cycle", "", " > ".join((*group, group[0])), 1)
    return checks


def columns_of(checks: Checks, contract: Contract, actual: Mapping[str, str]) -> None:
    for column in contract.columns:
        wanted, found = declared_type(column.type), actual.get(column.name)
        if found is None:
            checks.decide(contract.name, column.name, "column", wanted, "", 1)
            continue
        checks.decide(contract.name, column.name, "type", wanted, found, int(found != wanted))
        if column.is_required:
            checks.required.setdefault(contract.name, []).append(column.name)
    declared = {column.name for column in contract.columns}
    for name, kind in actual.items():
        if name not in declared:
            checks.decide(contract.name, name, "extra", "", kind, 1)


def reference_of(checks: Checks, contract: Contract, relation, child: Mapping[str, str] | None,
                 parent: Mapping[str, str] | None, parent_contract: Contract | None) -> None:
    target = f"{relation.ref_table}.{relation.ref_column}"
    own, other = (child or {}).get(relation.column), (parent or {}).get(relation.ref_column)
    where = [f"{name} is absent" for name, there in ((contract.name, child), (relation.ref_table, parent)) if there is None]
    where += [f"{name} is absent" for name, there, kind in
              ((f"{contract.name}.{relation.column}", child, own), (target, parent, other))
              if there is not None and kind is None]
    if where:
        checks.decide(contract.name, relation.column, "reference", target, ", ".join(where), None, "skipped")
    elif own != other and not {own, other} <= set(INTEGRAL):
        checks.decide(contract.name, relation.column, "reference", target, f"{own} against {other}", None, "failed")
    else:
        checks.references.append((contract.name, relation.column, relation.ref_table, relation.ref_column))
    if parent_contract is not None and parent_contract.key != (relation.ref_column,):
        checks.decide(contract.name, relation.column, "parent_key", target, ",".join(parent_contract.key), 1)


def verify_contracts(spark: SparkSession, contracts: Mapping[str, Contract],
                     load: Callable[[str], DataFrame | None]) -> DataFrame:
    """The report on all contracts; ``load`` gives a table or None where there is none."""
    names = dict.fromkeys([*contracts, *(r.ref_table for c in contracts.values() for r in c.relations)])
    tables = {name: load(name) for name in names}
    checks = compile_checks(contracts, {name: df.schema if df is not None else None for name, df in tables.items()})
    parts = [decided_rows(spark, checks.decided)]
    for name, columns in checks.required.items():
        nulls = tally(tables[name], name, {(column, "not_null"): F.col(f"`{column}`").isNull() for column in columns})
        parts.append(nulls.select("table_name", "column_name", "rule", F.lit("").alias("expected"),
                                  F.lit("").alias("actual"), "row_count", "failures",
                                  F.when(F.col("failures") > 0, "failed").when(F.col("row_count") == 0, "empty")
                                  .otherwise("ok").alias("status"), (F.col("failures") == 0).alias("ok")))
    wanted: list[KeyCheck | ReferenceCheck] = [KeyCheck(name, tables[name], key) for name, key in checks.keys]
    wanted += [ReferenceCheck(name, tables[name], column, parent, tables[parent], parent_column, nulls_are_orphans=False)
               for name, column, parent, parent_column in checks.references]
    if wanted:
        rule = F.when(F.col("family") == "key", "key").otherwise("reference")
        parts.append(run_checks(spark, wanted, one_scan=True).select(
            "table_name", "column_name", rule.alias("rule"), F.col("reference").alias("expected"),
            F.lit("").alias("actual"), "row_count", "failures", "status", "ok"))
    return union_reports(parts)


def decided_rows(spark: SparkSession, rows: Iterable[Sequence]) -> DataFrame:
    def cell(value) -> str:
        return sql_literal(value) if isinstance(value, str) else "NULL" if value is None else str(value).lower()

    literals = ", ".join(f"struct({', '.join(map(cell, row))})" for row in rows)
    return (spark.range(1).selectExpr(f"inline(array({literals})) AS ({', '.join(COLUMNS)})")
            .selectExpr(*COLUMNS[:5], "cast(row_count AS bigint) AS row_count", "cast(failures AS bigint) AS failures",
                        "status", "cast(ok AS boolean) AS ok"))
