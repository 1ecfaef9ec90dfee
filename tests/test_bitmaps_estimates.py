"""Bitmap checks equal to grouping, their shuffle size, sketches, and goodness of fit."""

import math
import random

import pytest
from pyspark.sql import functions as F

from finloom.operators import bitmaps, checks, estimates


def one(report):
    (row,) = report.collect()
    return row


def shuffled(spark, frame) -> int:
    """Bytes that the stages of a frame's job write to the shuffle."""
    sc = spark.sparkContext
    store, gateway = sc._jsc.sc().statusStore(), sc._gateway

    def total():
        none = gateway.new_array(gateway.jvm.double, 0)
        stages = store.stageList(None, False, False, none, gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    sc._jsc.sc().listenerBus().waitUntilEmpty()
    before = total()
    frame.collect()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


def numbers(spark, values, kind="bigint"):
    return spark.createDataFrame([(v,) for v in values], f"k {kind}").repartition(3)


EDGES = [0, 1, -1, 32767, 32768, 32769, 65536, -32767, -32768, 2 ** 62, -(2 ** 62), 2 ** 63 - 1, 7, 7, None]


@pytest.mark.parametrize("values", [[], [None, None], EDGES, list(range(-40000, 40000, 7)), [5] * 1000 + [6]])
def test_keys_as_by_grouping(spark, values):
    df = numbers(spark, values)
    assert one(bitmaps.bitmap_key_check(df, "t", "k")) == one(checks.key_check(df, "t", ["k"]))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("nulls", [True, False])
def test_references_as_by_join(spark, seed, nulls):
    rng = random.Random(seed)
    parents = rng.sample(range(-70000, 140000), 500) + [None] + EDGES[:8]
    child = [rng.choice(parents) if rng.random() < 0.9 or seed == 0 else rng.randint(-70000, 140000) for _ in range(800)]
    fact, ref = numbers(spark, child, "int"), numbers(spark, parents * 2)
    args = (fact, "f", "k", ref, "p", "k", nulls)
    assert one(bitmaps.bitmap_reference_check(*args)) == one(checks.reference_check(*args))


def test_empty_sides(spark):
    some, none = numbers(spark, [1, 2, None]), numbers(spark, [])
    for fact, ref in ((some, none), (none, some), (none, none)):
        args = (fact, "f", "k", ref, "p", "k")
        assert one(bitmaps.bitmap_reference_check(*args)) == one(checks.reference_check(*args))


def test_dense_keys_travel_as_bits(spark, tmp_path):
    spark.range(0, 4_000_000, 1, 4).where("xxhash64(id) % 10 <> 0").withColumnRenamed("id", "k").write.parquet(str(tmp_path / "k"))
    dense = spark.read.parquet(str(tmp_path / "k"))
    as_bits = shuffled(spark, bitmaps.bitmap_key_check(dense, "t", "k"))
    as_keys = shuffled(spark, checks.key_check(dense, "t", ["k"]))
    assert 0 < as_bits < 4_000_000 / 8 * 1.3 + 10_000 and as_keys > 8 * as_bits
    assert bitmaps.bitmap_pays(dense, "k")


def test_scattered_keys_travel_as_keys(spark):
    far = spark.range(0, 20_000, 1, 4).select((F.col("id") * 1_000_003).alias("k"))
    assert not bitmaps.bitmap_pays(far, "k")
    assert one(bitmaps.checked_key(far, "t", "k")) == one(checks.key_check(far, "t", ["k"]))
    texts = far.select(F.col("k").cast("string").alias("k"))
    assert one(bitmaps.checked_key(texts, "t", "k")).ok
    assert one(bitmaps.checked_reference(texts, "t", "k", texts, "t", "k")).failures == 0
    with pytest.raises(TypeError, match="whole numbers"):
        bitmaps.bitmap_key_check(texts, "t", "k")


def test_sketches_of_slices_merge(spark):
    df = spark.range(0, 60_000, 1, 6).select("id", (F.col("id") % 7).alias("part"))
    sketches = estimates.key_sketches(df, "id", ["part"])
    again = sketches.unionByName(estimates.key_sketches(df.where("part < 2"), "id", ["part"]))  # a slice twice
    row, twice = one(estimates.key_estimate(sketches, "t", "id")), one(estimates.key_estimate(again, "t", "id"))
    assert sketches.count() == 7 and row.status == "estimated"
    assert abs(row.distinct_estimate - 60_000) <= row.error_bound * 60_000
    assert twice.distinct_estimate == row.distinct_estimate and twice.status == "failed"
    gaps = df.withColumn("id", F.when(F.col("part") > 0, F.col("id")))
    assert one(estimates.key_estimate(estimates.key_sketches(gaps, "id"), "t", "id")).status == "failed"
    assert one(estimates.key_estimate(estimates.key_sketches(df.limit(0), "id"), "t", "id")).status == "empty"


def test_critical_values():
    # Chi-square quantiles as in any table.
    for freedom, alpha, value in ((1, 0.05, 3.841459), (4, 0.05, 9.487729), (10, 0.001, 29.588298), (100, 0.01, 135.806723)):
        assert math.isclose(estimates.chi_square_critical(freedom, alpha), value, rel_tol=1e-6)


@pytest.mark.parametrize(("weights", "ok"), [((1, 1, 2), True), ((1, 1, 1), False), ((1, 1, 0), False)])
def test_weights_fit_at_their_size(spark, weights, ok):
    rng = random.Random(1)
    drawn = [(rng.choices("abc", (1, 1, 2))[0],) for _ in range(4000)] + [(None,)]
    row = one(estimates.weight_fit(spark.createDataFrame(drawn, "v string"), "t", "v", "abc", weights))
    assert (row.ok, row.row_count, row.freedom) == (ok, 4000, 1 if 0 in weights else 2)
    seen = [sum(v == x for v, in drawn) for x in "abc"]
    if ok:
        assert math.isclose(row.statistic, sum((n - 4000 * w / 4) ** 2 / (4000 * w / 4) for n, w in zip(seen, weights)))


def test_unlisted_values_and_empty_columns(spark):
    df = spark.createDataFrame([("a",), ("z",)], "v string")
    assert (lambda r: (r.unlisted, r.ok))(one(estimates.weight_fit(df, "t", "v", ("a", "b"), (1, 1)))) == (1, False)
    assert one(estimates.weight_fit(df.limit(0), "t", "v", ("a", "b"), (1, 1))).ok


def test_null_rates_within_their_sampling_error(spark):
    df = spark.range(10_000).select(F.when(F.pmod(F.xxhash64("id"), F.lit(4)) > 0, 1).alias("a"), F.lit(1).alias("b"))
    rows = estimates.null_rate_fit(df.withColumn("c", F.col("a")), "t", {"a": 0.25, "b": 0.0, "c": 0.3}).collect()
    assert [(r.column_name, r.ok) for r in rows] == [("a", True), ("b", True), ("c", False)]
    assert [r.ok for r in estimates.null_rate_fit(df.limit(0), "t", {"a": 0.25, "b": 0.0}).collect()] == [True, True]
