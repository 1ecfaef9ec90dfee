"""The Jaccard join against all pairs; large groups, chains, frequent passages; filters; odd rows."""

import random
from fractions import Fraction

import pytest

from finloom.llm import ngram_join

SF = "/root/testdata/sf0.01"


def plain(docs, size=5, threshold=Fraction(4, 5)):
    sets = []
    for _, text in docs:
        words = (text or "").encode().lower().split()
        k = min(size, len(words))
        sets.append(frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else frozenset())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            small, large = sorted((len(x), len(y)))
            if small and small >= threshold * large and len(x & y) >= threshold * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs))


def found(spark, docs, **more):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    result = ngram_join.jaccard_components(frame, **more)
    assert result.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    return sorted(tuple(r) for r in result.collect())


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"other{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_edited_copies_link_as_by_all_pairs(spark):
    rng = random.Random(3)
    docs = []
    for _ in range(40):
        base = " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 200)))
        docs += [base, edited(rng, base, 1), edited(rng, base, 3), edited(rng, base, 5), base.upper()]
    docs = [(rng.randrange(10 ** 12), t) for t in docs]
    assert found(spark, docs) == plain(docs)


@pytest.mark.parametrize("changes", [1, 6, 9])
def test_a_large_group_links_as_by_all_pairs(spark, changes):
    rng = random.Random(changes)
    base = " ".join(f"w{i}" for i in range(150))
    docs = [(d, edited(rng, base, rng.randint(0, changes))) for d in range(120)]
    assert found(spark, docs) == plain(docs)


def test_chains_are_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    docs = [(900 - i, " ".join(words[4 * i:4 * i + 100])) for i in range(60)]
    result = found(spark, docs)
    assert result == plain(docs) and len({r[2] for r in result}) == 1


def test_a_passage_that_most_of_the_texts_share_does_not_link_them(spark):
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(80))
    docs = [(d, " ".join(f"x{rng.randrange(10 ** 6)}" for _ in range(own)) + " " + passage)
            for d, own in enumerate([0, 1, 4, 5, 8, 9, 12, 20] * 8)]
    assert found(spark, docs) == plain(docs)


def test_other_sizes_and_thresholds(spark):
    rng = random.Random(5)
    base = " ".join(f"w{rng.randrange(50)}" for _ in range(60))
    docs = [(d, edited(rng, base, rng.randint(0, 12))) for d in range(60)]
    for size, threshold in ((1, Fraction(9, 10)), (3, Fraction(1, 2))):
        assert found(spark, docs, shingle=size, threshold=threshold) == plain(docs, size, threshold)


def test_whole_table_equals_all_pairs(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, docs) == plain(docs)


def test_counts_of_tasks_add_up(spark):
    docs = spark.createDataFrame([(i, f"a b c d e {i % 3}") for i in range(60)], "doc_id long, text string").repartition(7)
    levels = ngram_join.levels_of(ngram_join.described(docs, 6))
    assert sorted(levels[levels > 0].tolist()) == [int(4 * ngram_join.np.log2(21))] * 3


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a c"), (7, "w " * 90000), (8, "w " * 5),
            (6, "one two three four five six"), (9, "a b c d e"), (9, "a b c d e")]
    assert found(spark, docs) == plain(docs)
    frame = spark.createDataFrame([(None, "a b", 1, "x"), (3, "a b", 2, "y")],
                                  "doc_id long, text string, n int, block string")
    assert sorted(map(str, map(tuple, ngram_join.jaccard_components(frame).collect()))) == [
        "(3, 1, 3)", "(None, 1, None)"]
    assert ngram_join.jaccard_components(frame.limit(0)).count() == 0
