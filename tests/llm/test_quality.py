"""Quality classifier: held-out accuracy, the update rule and odd rows."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from finloom.llm import quality

SF = "/root/testdata/sf0.01"


def test_query_on_held_out_labels(spark):
    rows = quality.op5_quality(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) == docs and len({r.doc_id for r in rows}) == docs
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    tested = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in tested) / len(tested) > 0.95
    assert sum(p for p, t in tested if t == 0) / sum(t == 0 for _, t in tested) < 0.3


def test_updates_equal_the_published_rule():
    rng = np.random.default_rng(3)
    examples = [(np.array(sorted(rng.choice(20, 4, replace=False)), np.int32), rng.random(4), int(rng.integers(2)))
                for _ in range(50)]
    model = quality.Ftrl(alpha=0.5, beta=1.0, l1=0.05, l2=0.01)
    z, n = [0.0] * 20, [0.0] * 20

    def weight(i):
        if abs(z[i]) <= 0.05:
            return 0.0
        return -(z[i] - math.copysign(0.05, z[i])) / ((1.0 + math.sqrt(n[i])) / 0.5 + 0.01)

    for _ in range(2):
        for index, values, label in examples:
            w = {i: weight(i) for i in index}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(index, values, strict=True))))
            for i, v in zip(index, values, strict=True):
                g = (p - label) * v
                s = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.5
                z[i] += g - s * w[i]
                n[i] += g * g
    assert np.allclose(model.fit(examples, 2)[:20], [weight(i) for i in range(20)], atol=1e-12)


def test_score_is_the_sparse_dot_product(spark):
    weights = np.linspace(-1, 1, quality.BUCKETS)
    text = "Word word GOOD !! word"
    index, values = quality.features(text)
    row = quality.score(spark.createDataFrame([(text,)], "text string"), weights).first()
    assert math.isclose(row.score, 1 / (1 + math.exp(-float(weights[index] @ values))))
    assert len(set(index.tolist())) == len(index)
    assert math.isclose(float(values[1:] @ values[1:]), 1.0)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b"), (4, "x " * 200000)],
                                 "doc_id long, text string").withColumn("score_2", F.lit(1)).withColumn(
                                     "label", F.lit("x"))
    labels = spark.createDataFrame([(1, None), (3, 1), (3, 0), (None, 1), (9, 1), (4, 0)],
                                   "doc_id long, quality int").withColumn("text", F.lit("x"))
    scored = quality.score(docs, quality.train(docs, labels))
    assert scored.columns == [*docs.columns, "score"]
    assert all(0 <= r.score <= 1 for r in scored.collect())
    nothing = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.score(docs.limit(0), nothing).count() == 0


def test_sample_is_bounded_and_skips_held_out(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    ids = [r.doc_id for r in quality.sample(docs, labels, 100).collect()]
    assert len(ids) == 100 and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)
