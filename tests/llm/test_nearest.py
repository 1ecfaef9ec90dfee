"""Nearest neighbours against brute force, with tiny blocks, ties and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from finloom.llm import nearest


def plain(queries, vectors, k):
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        dot = sum(x * y for x, y in zip(a, b, strict=True))
        return dot / (math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b)))

    out = {}
    for q, v in queries:
        if good(v):
            scored = sorted({(-cosine(v, w), i) for i, w in vectors if i != q and good(w) and len(w) == len(v)})
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found_by(frame):
    rows = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        rows.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(rows[r.query_id])
    return rows


@pytest.mark.parametrize("size", [3, 16, 4096])
def test_equal_to_brute_force_in_blocks(spark, monkeypatch, size):
    monkeypatch.setattr(nearest, "BLOCK", size)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", size)
    rng = np.random.default_rng(size)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]  # one vector very often
    frame = spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(4)
    asked = frame.where("vec_id % 10 = 0")
    found = found_by(nearest.nearest(asked, frame, 5))
    wanted = plain([r for r in rows if r[0] % 10 == 0], rows, 5)
    assert found.keys() == wanted.keys()
    for q, best in wanted.items():
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in best], abs=1e-12)
        for (i, s), (j, t) in zip(found[q], best, strict=True):
            assert i == j or abs(s - t) < 1e-12


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]),
            (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]),
            (9, [1e300, 1e300]), (10, [1e-200, 0.0]), (50, [0.0, 3.0]), (1, [2.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, v array<double>").withColumn("part", F.lit("x"))
    found = found_by(nearest.nearest(frame.where("vec_id in (0, 4, 8, 50)"), frame, 5))
    assert [i for i, _ in found[0]] == [1, 10, 9, 50]
    assert [i for i, _ in found[50]] == [9, 0, 1, 10]
    assert found.keys() == {0, 50}
    assert found[0][0][1] == 1.0


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, v array<float>")
    assert nearest.nearest(frame, frame).count() == 0
