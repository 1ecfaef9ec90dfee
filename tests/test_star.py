import random

from pyspark.sql import functions as F

from finloom.operators.reduction import KEY_BITS, MAX_WORDS, filter_words, reduced
from finloom.operators.star import (
    Branch, fiscal_roll_up, level_totals, roll_up, star_aggregate, star_join, survival_by_key, survival_estimate,
    surviving_rows,
)
from finloom.plans.calendar import calendar
from finloom.plans.tables import build_table


def facts(spark, rows=600):
    rng = random.Random(1)
    data = [(5 if rng.random() < 1 / 3 else rng.randrange(40), rng.randrange(30), rng.randrange(100))
            for _ in range(rows)]
    return data, spark.createDataFrame(data, "pc long, cc long, amt long")


def test_survival_measured_equals_brute_force_and_is_near_the_estimate(spark):
    sizes = {"profit_center": 500, "cost_center_dim_v": 400, "division_text": 20}
    from finloom.plans.dataset import Volumes
    sizes = Volumes().domain_sizes() | sizes
    fact = build_table(spark, "general_ledger_fact", 20_000, 4, sizes)
    pc = build_table(spark, "segment_profit_center_hierarchy", 200, 1, sizes)
    cc = build_table(spark, "segment_cost_center_hierarchy_dim_v", 200, 1, sizes)
    branches = [Branch(pc, "profit_center_nbr", "profit_center_nbr"), Branch(cc, "cost_center_nbr", "cost_center_nbr")]
    estimate = survival_estimate({"pc": 200, "cc": 200, "p": 500, "c": 400}, [("pc", "p"), ("cc", "c")])
    assert estimate == 0.4 * 0.5
    measured = surviving_rows(fact, branches).count() / 20_000
    assert abs(measured - estimate) < 0.01
    one = survival_by_key(fact, branches[0]).first()
    assert one.surviving == fact.where("profit_center_id <= 200").count() and one.row_count == 20_000


def test_star_join_and_aggregate(spark):
    data, fact = facts(spark)
    pcs = spark.range(20).select(F.col("id").alias("pc_id"), (F.col("id") % 3).alias("grp"))
    ccs = spark.range(15).select(F.col("id").alias("cc_id"))
    branches = [Branch(pcs, "pc", "pc_id"), Branch(ccs, "cc", "cc_id")]
    kept = [(p % 3, a) for p, c, a in data if p < 20 and c < 15]
    assert star_join(fact, branches).count() == len(kept)
    rows = star_aggregate(fact, branches, ["grp"], {"n": F.count("*"), "s": F.sum("amt")}).collect()
    assert {r.grp: (r.n, r.s) for r in rows} == {
        g: (sum(1 for x, _ in kept if x == g), sum(a for x, a in kept if x == g)) for g in range(3)}


def unbroadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_large_partial_branches_thin_the_fact_before_its_first_shuffle(spark):
    data, fact = facts(spark)
    pcs = spark.range(20).select(F.col("id").alias("pc_id"), (F.col("id") % 3).alias("grp"))
    ccs = spark.range(15).select(F.col("id").cast("int").alias("cc_id"))
    branches = [Branch(pcs, "pc", "pc_id", 20, True), Branch(ccs, "cc", "cc_id", 15, True)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    unbroadcast(spark)
    try:
        joined = star_join(fact, branches, broadcast_limit=0)
        plan = joined._jdf.queryExecution().executedPlan().toString().splitlines()
        moved = next(n for n, line in enumerate(plan) if "Exchange hashpartitioning(pc#" in line)
        below = next(line for line in plan[moved + 1:] if "Join" in line or "Exchange" in line)
        assert "BroadcastHashJoin" in below and "LeftSemi" in below
        assert sum("LeftSemi" in line for line in plan) == 2
        kept = sorted((p, c, a) for p, c, a in data if p < 20 and c < 15)
        assert sorted((r.pc, r.cc, r.amt) for r in joined.collect()) == kept
        rows = surviving_rows(fact, branches, broadcast_limit=0).collect()
        assert sorted((r.pc, r.cc, r.amt) for r in rows) == kept
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_key_filters_lose_no_partner_and_most_of_the_rest(spark):
    fact = spark.range(20_000).select(F.expr("if(id % 100 = 0, null, id)").alias("k"), F.lit("x").alias("id"))
    table = spark.range(0, 20_000, 10).withColumnRenamed("id", "key").unionByName(
        spark.createDataFrame([(None,)], "key long"))
    thin = reduced(fact, "k", table, "key", 2_001)
    partners = fact.join(table, F.col("k") == F.col("key"), "left_semi")
    assert partners.count() == 1_800 and partners.join(thin, "k", "left_anti").isEmpty()
    assert thin.where("k is null").isEmpty() and thin.columns == fact.columns
    assert thin.count() - 1_800 < 20_000 * 2 / KEY_BITS
    named = fact.select(F.col("k").cast("string").alias("k"))
    texts = table.select(F.col("key").cast("string").alias("key"))
    assert partners.count() <= reduced(named, "k", texts, "key").count() < 4_000
    assert reduced(fact, "k", table.limit(0), "key", 0).isEmpty()


def test_key_filters_are_left_out_where_they_cannot_hold(spark):
    fact = spark.range(5).withColumnRenamed("id", "k")
    table = spark.range(3).withColumnRenamed("id", "key")
    assert reduced(fact, "other", table, "key") is fact
    assert reduced(fact, "k", table.selectExpr("cast(key as double) AS key"), "key") is fact
    assert reduced(fact, "k", table, "key", MAX_WORDS * 64 + 1) is fact
    assert filter_words(0) == 1 and filter_words(None) == filter_words(10**12) == MAX_WORDS and filter_words(100) == 32


def test_semi_join_survival_is_not_multiplied_by_duplicates(spark):
    data, fact = facts(spark)
    twice = spark.range(20).union(spark.range(20)).toDF("pc_id")
    assert surviving_rows(fact, [Branch(twice, "pc", "pc_id")]).count() == sum(1 for p, _, _ in data if p < 20)
    assert survival_by_key(fact, Branch(twice, "pc", "pc_id")).first().surviving == sum(1 for p, _, _ in data if p < 20)


def test_roll_up_equals_grouping_every_prefix(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "x", 4), (None, "y", 8)], "p string, q string, n int")
    rows = {(r.level, r.p, r.q): (r.row_count, r.total) for r in roll_up(df, ["p", "q"], {"total": "n"}).collect()}
    assert rows == {
        (2, "a", "x"): (1, 1), (2, "a", None): (1, 2), (2, "b", "x"): (1, 4), (2, None, "y"): (1, 8),
        (1, "a", None): (2, 3), (1, "b", None): (1, 4), (1, None, None): (1, 8), (0, None, None): (4, 15)}


def test_level_totals_drop_missing_members(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "x", 4)], "l1 string, l2 string, n int")
    rows = {(r.level_nm, r.member): (r.row_count, r.s) for r in level_totals(df, ["l1", "l2"], {"s": "n"}).collect()}
    assert rows == {("l1", "a"): (2, 3), ("l1", "b"): (1, 4), ("l2", "x"): (2, 5)}


def test_fiscal_roll_up_totals(spark):
    df = spark.createDataFrame([(201801, 1), (201807, 2), (201901, 4)], "p int, n int")
    rows = fiscal_roll_up(df, "p", calendar(spark, 24), ["fiscal_year_nbr", "season_period_cd"], {"s": "n"}).collect()
    assert {(r.level, r.fiscal_year_nbr, r.season_period_cd): r.s for r in rows} == {
        (2, 2018, "S1"): 1, (2, 2018, "S2"): 2, (2, 2019, "S1"): 4, (1, 2018, None): 3, (1, 2019, None): 4,
        (0, None, None): 7}


def test_facts_outside_the_calendar_stay_in_the_totals(spark):
    df = spark.createDataFrame([(201801, 1), (203501, 2), (None, 4)], "p int, n int")
    rows = fiscal_roll_up(df, "p", calendar(spark, 24), ["fiscal_year_nbr"], {"s": "n"}).collect()
    assert sorted((r.level, r.fiscal_year_nbr or 0, r.row_count, r.s) for r in rows) == [
        (0, 0, 3, 7), (1, 0, 2, 6), (1, 2018, 1, 1)]


def test_calendar_matches_the_standard_library(spark):
    import calendar as months
    import datetime
    rows = calendar(spark).collect()
    assert len(rows) == 192
    for n, row in enumerate(rows, start=1):
        year, month = divmod(row.fiscal_year_period_nbr, 100)
        first = datetime.date(year, month, 1)
        assert row.month_long_nm == first.strftime("%B") and row.month_start_dt == first
        assert row.month_end_dt.day == months.monthrange(year, month)[1]
        assert row.fiscal_period_sort == row.season_sort_sequence_nbr == n
        assert row.fiscal_year_quarter_cd == f"FY{year}Q{(month + 2) // 3}"
        assert row.season_nm == ("Fall/Winter" if month > 6 else "Spring/Summer")
