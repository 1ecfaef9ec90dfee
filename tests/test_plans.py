"""The physical plans the operators are meant to have."""

import re

import pytest

import __spark_entry__ as contract
from finloom.operators import checks
from finloom.operators.star import Branch, star_join, surviving_rows
from finloom.operators.writer import session_settings

SF = "/root/testdata/sf0.001"
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reference_check_moves_each_side_once(spark):
    with session_settings(spark, NO_BROADCAST):
        fact = spark.range(1000).selectExpr("id % 10 AS k", "id AS other")
        plan = physical(checks.reference_check(fact, "f", "k", spark.range(20), "p", "id"))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert len(re.findall(r"Exchange SinglePartition", plan)) == 1
    assert "other" not in plan


def test_a_whole_report_takes_one_shuffle_of_keys(spark):
    with session_settings(spark, NO_BROADCAST):
        fact = spark.range(1000).selectExpr("id", "id % 10 AS k")
        dims = [spark.range(20).toDF("d") for _ in range(5)]
        wanted = [checks.KeyCheck("fact", fact, ("id",))]
        wanted += [checks.ReferenceCheck("fact", fact, "k", f"d{n}", dim, "d") for n, dim in enumerate(dims)]
        plan = physical(checks.run_checks(spark, wanted))
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_star_join_broadcasts_only_within_the_bound(spark):
    fact = spark.range(1000).selectExpr("id", "id % 10 AS k")
    dim = spark.range(10).selectExpr("id AS d")
    with session_settings(spark, NO_BROADCAST):
        small = physical(star_join(fact, [Branch(dim, "k", "d", 10)]))
        large = physical(star_join(fact, [Branch(dim, "k", "d", 10**9)]))
        unknown = physical(star_join(fact, [Branch(dim, "k", "d")]))
        semi = physical(surviving_rows(fact, [Branch(dim, "k", "d", 10)]))
    assert "BroadcastHashJoin" in small and "BroadcastHashJoin" in semi
    assert "SortMergeJoin" in large and "SortMergeJoin" in unknown


@pytest.mark.parametrize("name", ["star_survivor_aggregate", "survival_estimate_vs_measured", "hierarchy_rollup",
                                  "fk_orphans", "generated_star_integrity"])
def test_no_cartesian_products(spark, name):
    plan = physical(contract.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_the_columns_they_need(spark):
    plan = physical(contract.queries()["fk_orphans"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(columns.count(":") <= 2 for columns in schemas)


def test_flagship_gives_the_same_rows_without_broadcasts(spark):
    normal = contract.queries()["star_survivor_aggregate"](spark, SF).collect()
    with session_settings(spark, NO_BROADCAST | {"spark.sql.adaptive.enabled": "true"}):
        merged = contract.queries()["star_survivor_aggregate"](spark, SF).collect()
    assert sorted(map(str, normal)) == sorted(map(str, merged)) and normal


def test_no_python_in_any_plan(spark):
    for name in ("build_cost_center_dim_v", "gen_templates", "integrity_report", "key_round_trip"):
        assert "Python" not in physical(contract.queries()[name](spark, SF))
