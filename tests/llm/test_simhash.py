"""SimHash: fingerprints and links against brute force."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from finloom.llm import simhash
from finloom.llm.common import components

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, size):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, x in enumerate(ids):
        for y in ids[:i]:
            if (prints[x] ^ prints[y]).bit_count() <= 3:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {d: find(d) for d in ids}


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text, 3) for r in docs}
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op4_simhash(spark, SF).collect()}
    wanted = plain_components(prints)
    assert found == {d: (f"{prints[d]:016x}", wanted[d]) for d in prints}


@pytest.mark.parametrize("hot", [2, 64])
def test_no_link_is_lost_with_and_without_hot_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_KEY", hot)
    rng = random.Random(5)
    values = {0, (1 << 64) - 1, 1 << 63, 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(14):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    tight = rng.getrandbits(64)
    values |= {tight ^ rng.getrandbits(9) for _ in range(120)}
    frame = spark.createDataFrame([(signed(v),) for v in values], "f long")
    found = {(r.a, r.b) for r in simhash.near_pairs(frame).collect()}
    wanted = {tuple(sorted((signed(x), signed(y)))) for x in values for y in values
              if x < y and (x ^ y).bit_count() <= 3}
    assert found == wanted


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", None), (4, "one two", "x"), (4, "one two", "x"),
            (None, "one two", "x"), (5, "A b C d", "x"), (6, "a B c D", "x"), (7, "long " * 60000 + "end", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, f string").withColumn("fingerprint", F.lit(1))
    found = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, 3).collect()}
    by_id = {d: (f, c) for d, f, c in found if d is not None}
    assert by_id[1] == by_id[2] == by_id[3] == ("0" * 16, 1)
    assert by_id[4][1] == 4 and by_id[5][0] == by_id[6][0] and by_id[6][1] == 5
    assert (None, by_id[4][0], None) in found
    kept = sorted((r.doc_id or 0) for r in simhash.keep_first(docs, 3).collect())
    assert kept == [0, 1, 4, 4, 5, 7]
    assert simhash.keep_first(docs, 3).columns == docs.columns


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}


def test_links_of_fingerprints_count_in_keep_first(spark):
    rng = random.Random(5)
    one = " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(7))
    # A passage repeated many times sets all bits; what stands around it makes other sets of shingles.
    docs = [(d, f"{one} " * 400 + " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(40))) for d in (3, 1, 2)]
    docs.append((4, "quite another text of a few words"))
    prints = {d: plain_fingerprint(t, 5) for d, t in docs}
    assert all((prints[1] ^ prints[d]).bit_count() <= 3 for d in (2, 3))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_first(frame).collect()) == [1, 4]
