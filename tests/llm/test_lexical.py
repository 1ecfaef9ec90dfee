"""Reversed search against plain scoring of every pair; blocks of items; ties; odd rows."""

import math
import random
import re
from collections import Counter

import pytest

from finloom.llm import lexical

SPACE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k=10):
    words = [(d, re.findall(SPACE, (t or "").translate(LOWER))) for d, t in docs]
    words = [(d, w) for d, w in words if w]
    n_docs, n_terms = len(words), sum(len(w) for _, w in words)
    held = Counter(t for _, w in words for t in set(w))
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(re.findall(SPACE, (text or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for d, w in words:
            tf, m = Counter(w), 10 + (90 * len(w) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                        * ((10 ** 9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms if tf[t])
            if d is not None and score > 0:
                scored.append((-score, d))
        out += [(item, rank + 1, d, -s) for rank, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(spark, docs, items, **more):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    frame = lexical.search(docs, items, **more)
    assert frame.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted(tuple(r) for r in frame.collect())


def made(seed, docs, items):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "été", "ÉTÉ", "x1", "a_b", "don't", "中文", *(f"w{i}" for i in range(60))]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-", "\x7f"]) for _ in range(n))

    docs = [(d, text(rng.randint(0, 40))) for d in range(docs)]
    docs += [(1000 + d, t) for d, t in docs[:60]]  # equal scores
    return docs, [(i, text(rng.randint(0, 12))) for i in range(items)]


def test_equals_plain_scoring(spark):
    docs, items = made(1, 300, 25)
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, items, k=3) == plain(docs, items, 3)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = made(2, 80, 12)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 20)
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(lexical.blocks_of(frame))) > 2
    assert found(spark, docs, items) == plain(docs, items)


def test_ties_take_the_smallest_ids(spark):
    docs = [(d, "same words here") for d in range(40, 0, -1)] + [(99, "other")]
    assert [r[2] for r in found(spark, docs, [(7, "words")])] == list(range(1, 11))


@pytest.mark.parametrize("docs", [[], [(1, None), (2, ""), (3, " -- ")]])
def test_without_terms_nothing_is_found(spark, docs):
    assert found(spark, docs, [(1, "words")]) == []


def test_odd_rows(spark):
    docs = [(None, "a b c"), (1, "a"), (1, "a"), (2, None), (3, "b " * 60000), (-4, "c z")]
    items = [(1, "a"), (1, "b"), (None, "c"), (2, None), (3, ""), (4, "nowhere"), (5, "c C c")]
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, []) == []
    clash = spark.createDataFrame([(1, "a", 5, "x", 2)], "doc_id long, text string, score long, item_id string, n int")
    items = spark.createDataFrame([(1, "a", 3, "y")], "item_id long, text string, rank int, doc_id string")
    assert [tuple(r)[:3] for r in lexical.search(clash, items).collect()] == [(1, 1, 1)]
