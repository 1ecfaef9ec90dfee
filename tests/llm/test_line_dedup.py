"""Line dedup against the stated rule, with rare and with very common words, and odd rows."""

import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from finloom.llm import line_dedup


def plain(docs, least=1):
    """doc rows -> text after removal, by comparing every line with every earlier one."""
    lines = [(d, n, line) for d, text in sorted(docs) if text is not None
             for n, line in enumerate(text.split("\n"))]
    worded = [(d, n, {w for w in re.split(r"[\x09-\x0D ]+", line.lower()) if w}) for d, n, line in lines]
    gone = set()
    for i, (d, n, words) in enumerate(worded):
        if len(words) >= least and any(
                5 * len(words & other) >= 4 * len(words | other) for _, _, other in worded[:i] if len(other) >= least):
            gone.add((d, n))
    return {d: None if text is None else "\n".join(
        line for n, line in enumerate(text.split("\n")) if (d, n) not in gone) for d, text in docs}


def some_docs(seed, docs):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and"] * 6 + [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 16))] for _ in range(14)]
    out = []
    for d in range(docs):
        lines = []
        for _ in range(rng.randint(0, 5)):
            words = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rng.shuffle(words)
            lines.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in words))
        out.append((d, "\n".join(lines)))
    return out


@pytest.mark.parametrize("hot", [2, 4, 512])
def test_lines_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    docs = some_docs(hot, 60)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()}
    assert found == plain(docs)


def test_odd_rows(spark):
    line = "one two three four five six"
    docs = [(1, None), (2, ""), (3, f"{line}\n\n{line.upper()} \n short line\n short line"), (4, line), (5, "\n"),
            (6, f"\t{line}\nsix five four three two one"), (7, "word " * 50000 + "a b c d e")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("line_key", F.lit("x")).withColumn(
        "id", F.lit(None).cast("string"))
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(frame).collect()}
    assert {d: r.text for d, r in rows.items()} == plain(docs)
    assert rows[4].text == "" and rows[4].n_lines == rows[4].n_removed == 1
    assert rows[1].n_lines == 0 and rows[3].n_removed == 2 and rows[3].line_key == "x"


def test_short_lines_go_when_an_earlier_one_has_their_words(spark):
    docs = [(1, "Menu\n一行没有空格的文字\na b c d"), (2, "menu MENU\n一行没有空格的文字\n \na b c d e"), (3, "a b c\na b x\n\nd c b a")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()}
    assert found == plain(docs) == {1: docs[0][1], 2: " ", 3: "a b c\na b x\n"}
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, min_words=5).collect()}
    assert kept == plain(docs, 5) == dict(docs)


def test_no_similarity_but_equality(spark):
    frame = spark.createDataFrame([(1, "a b c d e f g h"), (2, "h g f e d c b a\na b c d e f g h i")], "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, threshold=Fraction(1)).collect()}
    assert found == {1: "a b c d e f g h", 2: "a b c d e f g h i"}


def test_repeated_rows_and_null_ids(spark):
    line = "one two three four five six"
    frame = spark.createDataFrame([(3, line), (3, line), (None, line), (4, line)], "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.text) for r in line_dedup.dedup_lines(frame).collect())
    assert found == [(0, line), (3, ""), (3, ""), (4, "")]
    assert line_dedup.dedup_lines(frame.limit(0)).count() == 0


def test_main_path_has_no_python(spark):
    frame = spark.createDataFrame(some_docs(1, 20), "doc_id long, text string")
    plan = line_dedup.dedup_lines(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_lines_do_not_meet_by_chance(spark):
    """Long lines that share a rare word and little else are no candidates; similar ones go as by brute force."""
    rng = random.Random(2)
    lines = [[f"rare{i % 40}", *(f"w{rng.randrange(4000)}" for _ in range(180))] for i in range(400)]
    near = [[*line[:-6], *(f"x{rng.randrange(4000)}" for _ in range(6))] for line in lines[:20]]
    docs = [(d, "  ".join(words)) for d, words in enumerate(lines + near)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    ranks = line_dedup.word_ranks(frame)
    postings = line_dedup.postings(line_dedup.set_lines(frame, ranks, line_dedup.THRESHOLD, 1).withColumn("id", F.col("doc_id")))
    met = postings.alias("a").join(postings.alias("b"), F.expr(
        "a.code = b.code and a.id < b.id and " + line_dedup.fits(line_dedup.THRESHOLD)))
    assert {(r.a, r.b) for r in met.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).collect()} == {
        (d, 400 + d) for d in range(20)}
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()}
    assert found == plain(docs) and sum(text == "" for text in found.values()) == 20


def test_one_common_word_is_no_key(spark):
    """Lines that share a rare word alone do not meet, however many they are; similar ones have a key in common."""
    lines = [["commonest", *(f"w{i}x{k}" for k in range(19))] for i in range(300)]
    near = [[*line[:-2], "changed"] for line in lines[:10]]
    frame = spark.createDataFrame([(d, " ".join(words)) for d, words in enumerate(lines + near)], "doc_id long, text string")
    sets = line_dedup.set_lines(frame, line_dedup.word_ranks(frame), line_dedup.THRESHOLD, 1).withColumn("id", F.col("doc_id"))
    keys = line_dedup.postings(sets).select("code", "id").distinct()
    met = keys.alias("a").join(keys.alias("b"), F.expr("a.code = b.code and a.id < b.id")).select("a.id", "b.id").distinct()
    assert {tuple(r) for r in met.collect()} == {(d, 300 + d) for d in range(10)}


@pytest.mark.parametrize("n", [5, 9, 10, 20, 45])
@pytest.mark.parametrize("hot", [2, 512])
def test_differences_that_part_the_most_neighbours(spark, monkeypatch, n, hot):
    """Every other one of the first words is missing: as many keys are lost as can be."""
    monkeypatch.setattr(line_dedup, "HOT", hot)
    words = ["x" * (n + 3 - i) for i in range(n)]
    fewer = [w for i, w in enumerate(words) if i % 2 == 0 or i >= 2 * (n // 5)]
    assert 5 * len(fewer) >= 4 * n
    docs = [(1, " ".join(words)), (2, " ".join(fewer)), (3, " ".join(fewer[1:])), (4, " ".join([*words, "yy"]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()} == plain(docs)


def test_words_by_counts_and_low_thresholds_find_the_same(spark):
    docs = some_docs(7, 50)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, counted=True).collect()} == plain(docs)
    lines = [(d, n, set(line.lower().split())) for d, text in docs for n, line in enumerate(text.split("\n"))]
    for threshold in (Fraction(1, 2), Fraction(3, 4)):
        removed = {d: 0 for d, _ in docs}
        for i, (d, _, words) in enumerate(lines):
            removed[d] += any(words and len(words & other) >= threshold * len(words | other) for _, _, other in lines[:i])
        found = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(frame, threshold=threshold).collect()}
        assert found == removed


@pytest.mark.parametrize("sign", [" ", "  ", "\t", "\v", "\f", "\r"])
def test_every_white_space_parts_words(spark, sign):
    docs = [(1, f"a b c d e{sign}\n"), (2, f"{sign}a{sign}b c{sign}d e"), (3, f"a{sign}b c d e")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()} == plain(docs)


def test_cuts_leave_no_shuffle_files(spark):
    from finloom.llm import common

    before = spark.conf.get(common.DROP_SHUFFLES, "false")
    written = common.cut(spark.range(2000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")), "cleanup")
    assert spark.conf.get(common.DROP_SHUFFLES) == before and {r.n for r in written.collect()} == {285, 286}


def test_near_copies_of_a_hot_key_make_no_pairs(spark, monkeypatch):
    """Near copies that do not resemble the first of their key are settled without a row for each two of them."""
    from finloom.llm import common

    made, cut = {}, common.Scratch.cut

    def counted(self, frame, purpose):
        written = cut(self, frame, purpose)
        made[purpose] = max(made.get(purpose, 0), written.count())
        return written

    monkeypatch.setattr(line_dedup.Scratch, "cut", counted)
    core = " ".join(f"corewords{i:02}" for i in range(20))
    docs = [(0, core + "".join(f" f{i}" for i in range(12))), *((d, f"{core} u{d}") for d in range(1, 120))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()}
    assert found == plain(docs) and sum(text == "" for text in found.values()) == 118
    assert made["lines-met"] <= len(docs) and made["lines-pairs"] <= len(docs)
