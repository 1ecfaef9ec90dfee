"""Contracts compiled into checks: every rule passing and failing, cycles, absent parents, empty tables."""

import json

import pytest

from finloom.operators import checks
from finloom.operators.contracts import compile_checks, cycles, declared_type, load_order, verify_contracts
from finloom.sources.contract import read_contracts


def declared(**tables):
    """name=(columns, references) as ``{"id": ("int", "primary_key")}`` and ``{"a": "parent.id"}``."""
    return read_contracts({"tables": [
        {"name": name, "columns": [{"name": c, "data_type": kind, "constraints": list(marks)}
                                   for c, (kind, *marks) in columns.items()],
         "relationships": [{"column": c, "references": dict(zip(("table", "column"), t.split("."), strict=True))}
                           for c, t in references.items()]} for name, (columns, references) in tables.items()]})


ID = {"id": ("int", "primary_key")}


def report(spark, contracts, tables):
    found = verify_contracts(spark, contracts, tables.get)
    return {(r.table_name, r.column_name, r.rule): r for r in found.collect()}


def test_every_rule(spark):
    contracts = declared(
        parent=(ID | {"name": ("varchar(9)", "not_null"), "gone": ("date",)}, {}),
        child=({"a": ("bigint", "primary_key"), "b": ("int", "primary_key"), "p": ("bigint",), "t": ("string",)},
               {"p": "parent.id", "t": "parent.id", "b": "parent.name", "q": "parent.id"}))
    tables = {"parent": spark.createDataFrame([(1, None, 2.0), (2, "x", 3.0)], "id int, name string, more double"),
              "child": spark.createDataFrame([(1, 1, 1, "1"), (1, 1, 9, "1"), (1, 2, None, None)],
                                             "a bigint, b int, p bigint, t string")}
    found = report(spark, contracts, tables)
    verdicts = {key: (r.failures, r.status, r.ok, r.actual) for key, r in found.items()
                if r.status != "ok" or r.rule in ("key", "not_null")}
    assert verdicts == {
        ("parent", "gone", "column"): (1, "failed", False, ""),
        ("parent", "more", "extra"): (1, "failed", False, "double"),
        ("parent", "name", "not_null"): (1, "failed", False, ""),
        ("parent", "id", "not_null"): (0, "ok", True, ""),
        ("parent", "id", "key"): (0, "ok", True, ""),
        ("child", "a", "not_null"): (0, "ok", True, ""),
        ("child", "b", "not_null"): (0, "ok", True, ""),
        ("child", "a,b", "key"): (1, "failed", False, ""),
        ("child", "p", "reference"): (1, "failed", False, ""),
        ("child", "t", "reference"): (None, "failed", False, "string against int"),
        ("child", "b", "reference"): (None, "failed", False, "int against string"),
        ("child", "b", "parent_key"): (1, "failed", False, "id"),
        ("child", "q", "reference"): (None, "skipped", None, "child.q is absent"),
    }
    with pytest.raises(checks.IntegrityError):
        checks.require_ok(verify_contracts(spark, contracts, tables.get))


def test_absent_tables_skip_what_needs_them(spark):
    contracts = declared(child=(ID | {"p": ("int",)}, {"p": "parent.id"}), parent=(ID, {}),
                         stray=(ID | {"p": ("int",)}, {"p": "nowhere.id"}))
    tables = {"child": spark.createDataFrame([(1, 1)], "id int, p int"), "stray": spark.createDataFrame([], "id int, p int")}
    found = report(spark, contracts, tables)
    assert found["parent", "", "table"].status == "failed" and found["parent", "id", "key"].status == "skipped"
    assert (found["child", "p", "reference"].status, found["child", "p", "reference"].actual) == ("skipped", "parent is absent")
    assert found["stray", "p", "reference"].actual == "nowhere is absent"
    assert (found["stray", "id", "key"].status, found["stray", "id", "not_null"].status) == ("empty", "empty")
    assert ("parent", "id", "type") not in found


def test_cycles_and_order():
    contracts = declared(a=(ID, {"id": "b.id"}), b=(ID, {"id": "c.id"}), c=(ID, {"id": "a.id"}), d=(ID, {"id": "d.id"}),
                         e=(ID, {"id": "a.id"}))
    assert cycles(contracts) == [("a", "b", "c"), ("d",)]
    rows = compile_checks(contracts, {name: None for name in contracts}).decided
    assert [row[4] for row in rows if row[2] == "cycle"] == ["a > b > c > a", "d > d"]
    with pytest.raises(ValueError, match="parents first"):
        load_order(contracts)
    plain = declared(fact=(ID, {"id": "dim.id", "x": "self.id"}), dim=(ID, {"id": "top.id"}), top=(ID, {"id": "top.id"}))
    assert load_order(plain) == ["top", "dim", "fact"]


def test_types_of_contracts_and_of_spark():
    assert [declared_type(kind) for kind in ("varchar(5)", "DECIMAL", "long", "timestamp", "array<float>", "no such")] == [
        "string", "decimal(18,5)", "bigint", "timestamp", "array<float>", "string"]


def test_a_contract_file_and_odd_names(spark, tmp_path):
    file = tmp_path / "contract.json"
    file.write_text(json.dumps({"tables": [{"name": "it's", "columns": [
        {"name": "a b", "data_type": "int", "constraints": ["primary_key"]}]}]}))
    found = report(spark, read_contracts(str(file)), {"it's": spark.createDataFrame([(1,), (1,)], "`a b` int")})
    assert found["it's", "a b", "key"].failures == 1
