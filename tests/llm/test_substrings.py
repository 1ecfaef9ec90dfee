"""Suffix arrays, and substring dedup against every string of the texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finloom.llm import substrings
from finloom.llm.suffixes import doubled, permuted_common_prefixes, suffix_array

SF = "/root/testdata/sf0.001"
LENGTH = substrings.LENGTH


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(min_size=1, max_size=60), st.lists(st.integers(0, 2), min_size=1, max_size=80).map(bytes),
                 st.binary(min_size=1, max_size=5).map(lambda b: b * 9)))
def test_suffix_array_and_prefixes(data):
    text = np.frombuffer(data, np.uint8).astype(np.int64)
    wanted = sorted(range(len(data)), key=lambda i: data[i:])
    assert suffix_array(text).tolist() == doubled(text).tolist() == wanted
    common = permuted_common_prefixes(text, np.array(wanted), 20)
    for i, j in zip(wanted[1:], wanted, strict=False):
        k = 0
        while k < 20 and max(i, j) + k < len(data) and data[i + k] == data[j + k]:
            k += 1
        assert common[i] == k


def plain(docs):
    texts = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(t[i:i + LENGTH] for _, t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i:i + LENGTH]] > 1:
                gone[i:i + LENGTH] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        spans = int(np.count_nonzero(np.diff(np.concatenate([[False], gone]).astype(int)) == 1))
        out.append((d, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digest(frame):
    kept = substrings.dedup_substrings(frame)
    rows = kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256")).collect()
    return sorted(map(tuple, rows), key=str)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, substrings.op8_suffix_array(spark, SF).collect()), key=str) == plain(docs)


@pytest.mark.parametrize("shard", [1, 1500, 1 << 21])
def test_repeats_of_all_kinds(spark, monkeypatch, shard):
    monkeypatch.setattr(substrings, "SHARD_BYTES", shard)
    rng = random.Random(shard)

    def noise(n):
        return "".join(rng.choice("abcdeé ") for _ in range(n))

    passages = [noise(n) for n in (170, 199, 200, 201, 400, 900)]
    docs = []
    for d in range(45):
        text = ""
        for _ in range(rng.randint(0, 4)):
            passage = rng.choice(passages)
            if rng.random() < 0.3:
                passage = passage[rng.randint(0, 30):len(passage) - rng.randint(0, 30)]
            text += noise(rng.randint(0, 120)) + passage
        docs.append((d, text + noise(rng.randint(0, 50))))
    docs += [(100, "ab" * 300), (101, "x" * 450), (102, docs[5][1]), (103, "é" * 100), (104, "é" * 101)]
    assert digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)) == plain(docs)


def test_odd_rows(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(700_000))
    docs = [(None, "q" * 250), (1, None), (2, ""), (3, long + long[:300]), (4, "short"), (5, "same" * 60), (5, "same" * 60),
            (5, "other" * 30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit("x")).withColumn(
        "first", F.lit("x"))
    assert digest(frame) == plain(docs)
    assert substrings.dedup_substrings(frame.limit(0)).count() == 0
