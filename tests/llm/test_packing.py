"""Length buckets against all choices of boundaries; batches within the budget; odd rows."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from finloom.llm import packing


def padding(histogram, uppers):
    return sum(n * (min(u for u in uppers if u >= length) - length) for length, n in histogram)


@pytest.mark.parametrize("seed", range(40))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(0, 60), rng.randint(1, 9)))
    histogram = [(length, rng.randint(1, 12)) for length in lengths]
    for buckets in (1, 2, 3, 5):
        found = packing.boundaries(histogram, buckets)
        used = min(buckets, len(lengths))
        choices = [(*c, lengths[-1]) for c in combinations(lengths[:-1], used - 1)]
        least = min(padding(histogram, c) for c in choices)
        assert len(found) == used and padding(histogram, found) == least


def test_batches(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL", 4)
    rng = random.Random(1)
    docs = [(i * 7 % 100, "w " * rng.choice([0, 1, 3, 3, 3, 8, 20, 45])) for i in range(100)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    rows = packing.pack(frame, buckets=3, budget=40).collect()
    assert {(r.doc_id, r.n_tokens) for r in rows} == {(d, len(t.split())) for d, t in docs}
    batches = {}
    for r in sorted(rows, key=lambda r: (r.bucket, r.n_tokens, r.doc_id)):
        assert r.n_tokens <= r.pad_to
        batches.setdefault((r.bucket, r.batch), []).append(r)
        assert r.slot == len(batches[r.bucket, r.batch]) - 1
    for (bucket, batch), members in batches.items():
        capacity = max(1, 40 // max(1, members[0].pad_to))
        full = (bucket, batch + 1) in batches
        assert len(members) <= capacity and (len(members) == capacity or not full)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b"), (4, "x " * 100000), (-5, "a\tb\nc")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_tokens", F.lit("x")).withColumn(
        "place", F.lit(None).cast("int"))
    rows = packing.pack(frame, buckets=2, budget=50).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(-5, 3), (0, 2), (1, 0), (2, 0), (3, 2), (3, 2),
                                                                 (4, 100000)]
    assert len({(r.bucket, r.batch, r.slot) for r in rows}) == len(rows)
    assert packing.pack(frame.limit(0)).count() == 0


def test_given_lengths(spark):
    frame = spark.range(10).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("size"))
    rows = packing.pack(frame, buckets=9, budget=4, length=F.col("size")).collect()
    assert {(r.n_tokens, r.pad_to) for r in rows} == {(0, 0), (1, 1), (2, 2)}
