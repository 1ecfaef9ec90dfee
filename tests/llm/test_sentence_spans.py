"""Sentence spans against the stated rule; what no sentence end is; long passages; odd rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from finloom.llm import sentence_spans
from finloom.llm.sentence_spans import WORDS


def pieces(text):
    """Sentence by sentence, character by character."""
    out, begin, i = [], 0, 0
    blank = set(" \t\n\x0b\x0c\r.!?")
    while i < len(text):
        end = None
        if text[i] == "\n":
            end = i
        elif text[i] in ".!?" or text[i] in "。！？｡":
            wide, j = text[i] in "。！？｡", i
            while j < len(text) and text[j] in ("。！？｡" if wide else ".!?"):
                j += 1
            while j < len(text) and text[j] in "\"'”’»)]}" + "」』）" * wide:
                j += 1
            if wide or j == len(text) or text[j] in " \t\n\x0b\x0c\r":
                end = j
            i = j - 1
        if end is not None and set(text[begin:end]) - blank:
            out.append(text[begin:end])
            begin = end
        i += 1
    return out + [text[begin:]] * bool(set(text[begin:]) - blank)


def plain(docs):
    said = {d: [re.sub(r"[\x09-\x0D ]+", " ", p).strip(" ").lower() for p in pieces(t or "")] for d, t in docs}
    seen, gone = set(), set()
    for d in sorted(said):
        size = [len(s.split(" ")) + len(re.findall("[\u3040-\u30ff\u3400-\u9fff]", s)) // 2 for s in said[d]]
        n = len(size)
        enough = [(i, j) for i in range(n) for j in range(i, n) if sum(size[i:j + 1]) >= WORDS]
        spans = {(i, j) for i, j in enough if (i, j - 1) not in enough or j == i}
        spans = {min((s for s in enough if s[0] == i), default=None) for i in range(n)} | {
            max((s for s in enough if s[1] == j), default=None) for j in range(n)}
        for i, j in sorted(spans - {None}):
            run = tuple(said[d][i:j + 1])
            if run in seen:
                gone |= {(d, at) for at in range(i, j + 1)}
            seen.add(run)
    out = {}
    for d, t in docs:
        own = pieces(t or "")
        out[d] = t if not any((d, i) in gone for i in range(len(own))) else "".join(
            p for i, p in enumerate(own) if (d, i) not in gone) + t[len("".join(own)):]
    return out


def found(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return {r.doc_id: r.text for r in sentence_spans.dedup_spans(frame).collect()}


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_pieces_are_those_of_the_rule():
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b", ".", "!", "?", " ", "\n", '"', ")", "。", "」", "\r"]) for _ in range(25))
        assert sentence_spans.pieces_of(text) == pieces(text), repr(text)


def test_texts_equal_brute_force(spark):
    rng = random.Random(2)
    said = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(1, 30))) for _ in range(9)]
    docs = [(d, "".join(rng.choice(["", " ", "\n"]) + rng.choice([str.lower, str.upper])(rng.choice(said))
                        + rng.choice([".", "! ", "?... ", "\n", ". \n\n", ".) ", "。"]) for _ in range(rng.randint(0, 12))))
            for d in range(60)]
    assert found(spark, docs) == plain(docs)


@pytest.mark.parametrize(("text", "other"), [
    ("Our address 10.0.0.1 is up now. It serves all of it.", "But 192.0.0.1 is up now. So is 10.0.0.1 is up now."),
    ("By R.S.V.P.X. terms they stay. Of 3.5.1.2 nothing goes.", "The U.S.V.P.X. terms they stay. And 4.5.1.2 nothing goes."),
    ("Yes. No. Yes.", "Yes. No. Yes."),
])
def test_clean_texts_stay(spark, text, other):
    docs = [(1, other), (2, text), (3, text + " " + words(random.Random(7), 60) + ".")]
    assert found(spark, docs) == dict(docs)


def test_passages_of_fifty_words_go_whatever_their_sentences(spark):
    rng = random.Random(4)
    passages = [f"{words(rng, 55)}.", f"{words(rng, 30)}. {words(rng, 28)}.", "! ".join(words(rng, 50).split()) + ".",
                f"{words(rng, 2)}. {words(rng, 9)}! {words(rng, 40)}. {words(rng, 3)}."]
    docs = [(i, f"{words(rng, 8)}. {words(rng, 9)}.\n{p}\n{words(rng, 12)}. {words(rng, 5)}.")
            for i, p in enumerate(passages * 2)]
    result = found(spark, docs)
    for i, p in enumerate(passages):
        assert result[i] == docs[i][1]
        assert result[i + 4] == docs[i + 4][1].replace("\n" + p, "")


def test_passages_whose_ends_lie_inside_sentences_lose_their_whole_sentences(spark):
    rng = random.Random(6)
    core = f"{words(rng, 12)}. {words(rng, 14)}."
    passage = f"{words(rng, 15)}. {core} {words(rng, 15)}"
    docs = [(i, f"{words(rng, 6)} {passage} {words(rng, 6)}.") for i in range(2)]
    assert found(spark, docs) == {0: docs[0][1], 1: docs[1][1].replace(" " + core, "")}


def test_texts_without_spaces_have_sentences_too(spark):
    line = "。".join("".join(chr(0x4E00 + 40 * k + i) for i in range(12)) for k in range(4)) + "。"
    short = line[:26]
    docs = [(1, line), (2, line), (3, short), (4, short + "で")]
    assert found(spark, docs) == plain(docs) == dict(docs) | {2: ""}


def test_odd_rows(spark):
    text = "One two. Three four. Five six. " + words(random.Random(3), 24) + ". Seven"
    docs = [(1, None), (2, ""), (3, " ..!\n"), (4, text), (6, text + ".\n "), (7, "A b. " * 3000)]
    result = found(spark, docs)
    assert result[6] == " Seven.\n " and len(result[7]) < 100 and found(spark, docs[:5]) == plain(docs[:5])
    frame = spark.createDataFrame([(5, text), (5, text), (None, text)], "doc_id long, text string").withColumn(
        "span_key", F.lit("x")).withColumn("pos", F.lit("x")).withColumn("Span_rest", F.lit("y"))
    rows = sentence_spans.dedup_spans(frame).collect()
    assert sorted((r.doc_id or 0, r.text, r.n_removed, r.span_key, r.Span_rest) for r in rows) == [
        (0, text, 0, "x", "y"), (5, "", 5, "x", "y"), (5, "", 5, "x", "y")]
    assert sentence_spans.dedup_spans(frame.limit(0)).count() == 0
