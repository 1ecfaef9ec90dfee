"""Near copies against the Jaccard similarity of all pairs; large groups; odd rows."""

import random

import pytest
from test_simhash import plain_fingerprint

from finloom.llm import shingles
from finloom.llm.simhash import keep_first

SF = "/root/testdata/sf0.01"


def plain_sets(docs, size=5):
    out = {}
    for d, text in docs:
        words = (text or "").encode().lower().split()
        k = min(size, len(words))
        out[d] = frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else frozenset()
    return out


def plain_kept(docs):
    sets = plain_sets(docs)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[:i]:
            small, large = sorted((len(sets[x]), len(sets[y])))
            if 5 * small >= 4 * large and 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {d for d in ids if find(d) == d}


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"other{rng.randrange(10 ** 6)}"
    return " ".join(words)


def kept(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    return {r.doc_id for r in keep_first(frame).collect()}


def test_edited_copies_go(spark):
    rng = random.Random(3)
    docs = []
    for _ in range(30):
        base = " ".join(f"w{rng.randrange(500)}" for _ in range(200))
        docs += [base, edited(rng, base, 1), edited(rng, base, 3), edited(rng, base, 5)]
    docs = list(enumerate(docs))
    prints = {d: plain_fingerprint(t, 5) for d, t in docs}
    far = [d for d, _ in docs if d % 4 == 2 and (prints[d] ^ prints[d - 2]).bit_count() > 3]
    assert far and kept(spark, docs) == plain_kept(docs)
    assert not kept(spark, docs) & set(far)


@pytest.mark.parametrize("changes", [1, 8])
def test_a_large_group_is_linked_as_by_all_pairs(spark, changes):
    rng = random.Random(changes)
    base = " ".join(f"w{i}" for i in range(150))
    docs = [(d, edited(rng, base, rng.randint(0, changes))) for d in range(150)]
    assert kept(spark, docs) == plain_kept(docs)


def test_whole_table_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert kept(spark, docs) == plain_kept(docs)


def test_keys_find_the_stated_share(spark):
    rng = random.Random(9)
    missed = 0
    for _ in range(400):
        both = [rng.getrandbits(64) for _ in range(80)]
        one, other = ([*both, *(rng.getrandbits(64) for _ in range(10))] for _ in range(2))
        keys = [set(shingles.band_keys(shingles.np.array(x, "u8"))) for x in (one, other)]
        missed += not keys[0] & keys[1]
    assert missed == 0


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a c"), (7, "w " * 90000), (8, "w " * 5)]
    assert kept(spark, docs) == {1, 4, 6, 7}
    rows = [(3, "one two"), (3, "three four"), (None, "one two"), (4, "three four")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in keep_first(frame).collect()) == [
        (0, "one two"), (3, "one two"), (3, "three four")]
    assert keep_first(frame.limit(0)).count() == 0
