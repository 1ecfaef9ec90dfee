"""Checks against brute force on small and skewed fixtures."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from finloom.operators import checks, conformance
from finloom.sources.contract import Contract, ContractColumn
from finloom.sources.rows import bucket_count, hash_sample, partitions_for


def frame(spark, values, name="k"):
    return spark.createDataFrame([(v,) for v in values], f"{name} long")


def skewed(seed, size=900):
    """A third of the rows carry one key, some carry none."""
    rng = random.Random(seed)
    return [7 if rng.random() < 1 / 3 else None if rng.random() < 0.05 else rng.randrange(60) for _ in range(size)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("nulls", [True, False])
def test_reference_check_against_brute_force(spark, seed, nulls):
    child, parent = skewed(seed), [p for p in range(60) if p % 4] + [7, 7, None]
    row = checks.reference_check(frame(spark, child), "c", "k", frame(spark, parent, "p"), "p", "p", nulls).first()
    known = {p for p in parent if p is not None}
    wanted = sum(1 for k in child if (k is None and nulls) or (k is not None and k not in known))
    assert (row.row_count, row.distinct_keys, row.failures) == (
        len(child), len({k for k in child if k is not None}), wanted)
    assert row.ok == (wanted == 0) and row.status == ("ok" if wanted == 0 else "failed")


@pytest.mark.parametrize("seed", range(3))
def test_all_checks_in_one_pass_equal_the_single_checks(spark, seed):
    child, parent = frame(spark, skewed(seed)), frame(spark, [p for p in range(60) if p % 4] + [7, 7, None], "p")
    texts = child.selectExpr("k", "concat('K_', k) AS t")
    text_parent = parent.selectExpr("concat('K_', p) AS p")
    ints = child.selectExpr("cast(k AS int) AS k")
    decimals = child.selectExpr("cast(k AS decimal(10,2)) AS k")
    pairs = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (None, "a")], "x int, y string")
    empty = frame(spark, [])
    wanted, single = [], []
    for name, df, column, ref in (("longs", child, "k", parent), ("ints", ints, "k", parent),
                                  ("texts", texts, "t", text_parent), ("decimals", decimals, "k", parent),
                                  ("empty", empty, "k", parent), ("orphaned", child, "k", empty.toDF("p"))):
        for nulls in (True, False):
            wanted.append(checks.ReferenceCheck(name, df, column, "p", ref, "p", nulls))
            single.append(checks.reference_check(df, name, column, ref, "p", "p", nulls))
    for name, df, keys in (("longs", child, ["k"]), ("texts", texts, ["t"]), ("pairs", pairs, ["x", "y"]),
                           ("empty", empty, ["k"]), ("good", spark.range(5), ["id"])):
        wanted.append(checks.KeyCheck(name, df, tuple(keys)))
        single.append(checks.key_check(df, name, keys))
    together, apart = checks.run_checks(spark, wanted), checks.union_reports(single)
    assert sorted(map(tuple, together.collect()), key=str) == sorted(map(tuple, apart.collect()), key=str)
    assert together.count() == len(wanted)


def test_duplicate_parents_do_not_inflate(spark):
    child = frame(spark, [1, 2, 2])
    row = checks.reference_check(child, "c", "k", frame(spark, [1, 1, 2, 2], "p"), "p", "p").first()
    assert (row.row_count, row.failures) == (3, 0)


@pytest.mark.parametrize("values,ok,status", [([1, 2, 3], True, "ok"), ([1, 1, 2], False, "failed"),
                                              ([1, None], False, "failed"), ([], False, "empty")])
def test_key_check(spark, values, ok, status):
    row = checks.key_check(frame(spark, values), "t", ["k"]).first()
    assert (row.ok, row.status, row.row_count) == (ok, status, len(values))
    assert row.distinct_keys == len({v for v in values if v is not None})


KEY_KINDS = {
    "timestamp": ["timestamp'2024-01-01 00:00:00.000001'", "timestamp'2024-01-01 00:00:00.000002'", "NULL"],
    "double": ["0.0D", "-0.0D", "double('NaN')", "double('NaN')", "1.5D"],
    "decimal": ["1.10BD", "1.1BD", "2.00BD"], "date": ["date'2024-01-01'", "date'2024-01-02'"],
    "binary": ["X'00FF'", "X'00'", "X'00FF'"], "boolean": ["true", "false", "true"], "text": ["'1'", "'01'", "'1'"],
}


@pytest.mark.parametrize("kind", sorted(KEY_KINDS))
def test_one_pass_agrees_with_single_checks_for_every_type(spark, kind):
    rows = ", ".join(f"({value}, {n % 2})" for n, value in enumerate(KEY_KINDS[kind]))
    df = spark.sql(f"SELECT * FROM VALUES {rows} AS t(k, n)")
    parents = df.limit(1).withColumnRenamed("k", "p")
    wanted = [checks.KeyCheck("one", df, ("k",)), checks.KeyCheck("two", df, ("k", "n")),
              checks.ReferenceCheck("ref", df, "k", "parents", parents, "p"),
              checks.ReferenceCheck("nat", df, "k", "parents", parents, "p", False)]
    single = [checks.key_check(df, "one", ["k"]), checks.key_check(df, "two", ["k", "n"]),
              checks.reference_check(df, "ref", "k", parents, "parents", "p"),
              checks.reference_check(df, "nat", "k", parents, "parents", "p", False)]
    found = {r.table_name: tuple(r) for r in checks.run_checks(spark, wanted).collect()}
    assert found == {r.table_name: tuple(r) for r in checks.union_reports(single).collect()}


def test_microseconds_tell_composite_keys_apart(spark):
    df = spark.sql("SELECT 1 AS a, k FROM VALUES (timestamp'2024-01-01 00:00:00.000001'), "
                   "(timestamp'2024-01-01 00:00:00.000002') AS t(k)")
    assert checks.run_checks(spark, [checks.KeyCheck("t", df, ("a", "k"))]).first().ok


def test_empty_fact_passes_but_is_marked(spark):
    row = checks.reference_check(frame(spark, []), "c", "k", frame(spark, [1], "p"), "p", "p").first()
    assert row.ok and row.status == "empty"


def test_offender_listings(spark):
    values = skewed(9)
    counted = Counter(values)
    found = {row.k: row.row_count for row in checks.duplicate_keys(frame(spark, values), ["k"]).collect()}
    assert found == {k: n for k, n in counted.items() if n > 1}
    parents = frame(spark, range(0, 60, 2), "p")
    orphans = checks.orphan_rows(frame(spark, values), "k", parents, "p", nulls_are_orphans=False)
    assert orphans.count() == sum(1 for v in values if v is not None and v % 2)
    assert checks.orphan_rows(frame(spark, values), "k", parents, "p").count() == orphans.count() + counted[None]
    keys = {row.child_key: row.row_count for row in checks.orphan_keys(frame(spark, values), "k", parents, "p").collect()}
    assert keys == {k: n for k, n in counted.items() if k is None or k % 2}


def test_reference_check_folds_before_the_join(spark):
    plan = checks.reference_check(frame(spark, [1]), "c", "k", frame(spark, [1], "p"), "p", "p")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join LeftOuter") < text.index("Aggregate [child_key" if "Aggregate [child_key" in text else "count(1)")


def test_gate(spark):
    good = checks.key_check(frame(spark, [1, 2]), "good", ["k"])
    bad = checks.key_check(frame(spark, [1, 1]), "bad", ["k"])
    checks.require_ok(good)
    with pytest.raises(checks.IntegrityError, match="table_name=bad"):
        checks.require_ok(checks.union_reports([good, bad]))
    many = checks.union_reports([bad] * 4)
    with pytest.raises(checks.IntegrityError, match="4 in all, 2 shown"):
        checks.require_ok(many, shown=2)
    with pytest.raises(ValueError):
        checks.union_reports([])


def test_checks_of_absent_tables_are_skipped_rows(spark):
    tables = {"a": frame(spark, [1, 2]), "b": frame(spark, [1, 3])}
    report = checks.integrity_report(spark, tables, {"a": ("k",), "gone": ("k",)},
                                     [("b", "k", "a", "k"), ("b", "k", "gone", "k")], [("b", "k", "a", "k")])
    assert sorted((r.family, r.failures) for r in report.where("status <> 'skipped'").collect()) == [
        ("foreign_key", 1), ("key", 0), ("natural_key", 1)]
    skipped = report.where("status = 'skipped'")
    assert sorted((r.family, r.table_name, r.reference, r.ok) for r in skipped.collect()) == [
        ("foreign_key", "b", "gone.k", None), ("key", "gone", "", None)]
    with pytest.raises(checks.IntegrityError, match="skipped"):
        checks.require_ok(skipped)
    checks.require_ok(skipped, skipped_ok=True)


def test_row_counts_capture_errors(spark, tmp_path):
    frame(spark, [1, 2]).write.parquet(str(tmp_path / "a"))
    frame(spark, [1, 2]).write.parquet(str(tmp_path / "c"))
    for part in (tmp_path / "c").glob("part-*"):
        part.write_bytes(b"PAR1 this is no longer a table PAR1")
    schema = "k bigint"
    report = checks.row_counts(spark, lambda t: spark.read.schema(schema).parquet(str(tmp_path / t)), ["a", "b", "c"])
    found = {r.table_name: (r.row_count, r.status) for r in report.collect()}
    assert found["a"] == (2, "ok") and found["b"] == (None, "PATH_NOT_FOUND")
    assert found["c"][0] is None and found["c"][1] != "ok"


def test_sample_repeats_and_ignores_partitioning(spark):
    ids = spark.range(50_000)
    buckets = bucket_count(50_000, 5_000)
    first = hash_sample(ids.repartition(3), ["id"], buckets)
    second = hash_sample(ids.repartition(11), ["id"], buckets)
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()
    assert 4_500 < first.count() < 5_500
    assert hash_sample(ids, ["id"], 1).count() == 50_000
    assert bucket_count(10, 1_000) == 1


def test_partitions_follow_rows_and_width():
    assert partitions_for(0) == 1 and partitions_for(2_000_001) == 3
    assert partitions_for(2_000_000_000, 36, 64) == 2000
    assert partitions_for(250_000, 64, 8) == 8 and partitions_for(250_000, 64, 64) == 16
    assert partitions_for(1000, 10, 64) == 1


def test_conformance_checks_ignore_nulls_where_they_should(spark):
    df = spark.createDataFrame([("a", 1, "AB1"), ("z", 9, "ab1"), (None, None, None)], "v string, n int, t string")
    domain = conformance.domain_check(df, "t", {"v": ("a", "b")}).first()
    assert (domain.row_count, domain.failures, domain.ok) == (2, 1, False)
    template = conformance.template_check(df, "t", {"t": "rrd"}).first()
    assert (template.row_count, template.failures) == (2, 1)
    ranged = conformance.range_check(df, "t", {"n": (1, 5)}).first()
    assert ranged.failures == 1
    rates = conformance.null_rate_check(df, "t", {"v": 1 / 3, "n": 0.0}, 0.01)
    assert {r.column_name: (r.null_count, r.ok) for r in rates.collect()} == {"v": (1, True), "n": (1, False)}


def test_weight_check_reports_values_never_seen(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] + [(None,)], "v string")
    rows = {r.value: (r.row_count, r.observed_share, r.ok)
            for r in conformance.weight_check(df, "t", "v", ("a", "b", "c"), (6, 2, 2), 0.1).collect()}
    assert rows == {"a": (3, 0.75, False), "b": (1, 0.25, True), "c": (0, 0.0, False)}


def test_round_trip_finds_collisions_and_wrong_ids(spark):
    df = spark.createDataFrame([("P_01", 1), ("P_02", 3), ("P_1", 1), ("P_1", 10), ("bad", 4)], "k string, id long")
    row = conformance.key_round_trip(df, "t", "k", "id", "P").first()
    assert (row.row_count, row.distinct_keys, row.mismatches, row.collisions, row.ok) == (5, 4, 3, 1, False)


def test_contract_check_reports_a_renamed_key(spark):
    contract = Contract("t", (ContractColumn("__segment_id", "bigint", ("primary_key", "not_null")),
                              ContractColumn("nm", "varchar(20)")))
    df = spark.createDataFrame([(1, "x")], "__id long, nm string")
    rules = {(r.column_name, r.rule): r.ok for r in conformance.contract_check(spark, df, contract).collect()}
    assert rules == {("__segment_id", "missing"): False, ("nm", "type"): True, ("__id", "extra"): False}


def test_contract_check_counts_nulls_in_required_columns(spark):
    contract = Contract("t", (ContractColumn("id", "bigint", ("not_null",)),))
    df = spark.createDataFrame([(1,), (None,)], "id long")
    required = conformance.contract_check(spark, df, contract).where(F.col("rule") == "required").first()
    assert (required.failures, required.ok) == (1, False)


def test_every_table_of_a_report_is_scanned_once(spark, tmp_path):
    for name, frame in (("fact", spark.range(50).selectExpr("id", "id % 7 AS a", "id % 5 AS b", "cast(id % 3 AS string) AS c")),
                        ("dim", spark.range(6).selectExpr("id", "cast(id AS string) AS code"))):
        frame.write.parquet(str(tmp_path / name))

    def load(name):
        return spark.read.parquet(str(tmp_path / name))

    relations = [("fact", "a", "dim", "id"), ("fact", "b", "dim", "id"), ("fact", "c", "dim", "code")]
    report = checks.run_checks(spark, [
        checks.KeyCheck("fact", load("fact"), ("id",)), checks.KeyCheck("dim", load("dim"), ("code",)),
        *(checks.ReferenceCheck(c, load(c), column, p, load(p), key) for c, column, p, key in relations)], one_scan=True)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert {(r.column_name, r.failures, r.distinct_keys) for r in report.collect()} == {
        ("id", 0, 50), ("code", 0, 6), ("a", 7, 7), ("b", 0, 5), ("c", 0, 3)}
