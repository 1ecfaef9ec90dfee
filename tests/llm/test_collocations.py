"""Collocations against plain counting; automata against dictionaries; pruning, ranges and parts; odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from finloom.llm import collocations as C
from finloom.llm import automata as A
from finloom.llm.automata import Automaton, build, built, compose, union

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, min_count=100, max_words=5, top=2000, covered=100):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    wanted = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    out = {}
    for (lang, p), a in wanted.items():
        if any(lang == other and len(q) > len(p) and 100 * b >= covered * a
               and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (other, q), b in wanted.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]],
                                     f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -score) for lang, rows in out.items()
                  for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top]))


def found(spark, docs, **more):
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    result = C.collocations(frame, **more)
    assert result.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"),
                             *((name, "bigint") for name in ("a", "l", "r", "n", "score"))]
    return sorted(tuple(r) for r in result.collect())


def made(seed, docs):
    rng = random.Random(seed)
    words = ["the", "The", "of", "Été", "ÉTÉ", "a-b", "中文", "x\x00y", "new york", "a a a", "once upon a time", "w"]

    def text():
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! ", "\x0b"])
                       for _ in range(rng.randint(0, 60)))

    return [(rng.choice(["en", "de", None, "und", "a b"]), text()) for _ in range(docs)]


def some_phrases(seed, size):
    rng = random.Random(seed)
    return {tuple(rng.choice([b"a", b"b", b"ab", b"", b"\xff", b"c d"]) for _ in range(rng.randint(1, 5))):
            rng.randint(1, 2 ** 40) for _ in range(size)}


def test_automata_hold_what_they_are_built_from():
    for seed in range(20):
        phrases = some_phrases(seed, seed * 6)
        automaton = Automaton.from_bytes(build(sorted(phrases.items())).to_bytes())
        assert list(automaton.items()) == sorted(phrases.items())
    with pytest.raises(ValueError, match="ascend"):
        build([((b"b",), 1), ((b"a",), 1)])


def test_endings_in_common_are_stored_once():
    phrases = sorted((bytes([a]), b"x", b"y", bytes([z])) for a in range(65, 90) for z in range(65, 90))
    assert len(build((p, 1) for p in phrases).label) == 25 + 1 + 1 + 25


def test_union_adds_and_compose_looks_up():
    parts = [some_phrases(seed, 40) for seed in range(5)]
    whole = Counter()
    for part in parts:
        whole.update(part)
    automata = [build(sorted(part.items())) for part in parts]
    assert list(union(automata).items()) == sorted(whole.items())
    least = sorted(whole.values())[len(whole) // 2]
    assert list(union(automata, least).items()) == sorted((p, w) for p, w in whole.items() if w >= least)
    asked = some_phrases(77, 200)
    answer = compose(build(sorted((p, 1) for p in asked)), union(automata))
    assert list(answer.items()) == sorted((p, w) for p, w in whole.items() if p in asked)


@pytest.mark.parametrize("more", [{}, {"max_words": 3, "top": 5, "covered": 60}])
def test_equals_plain_counting(spark, monkeypatch, more):
    docs = made(4, 150)
    expected = plain(docs, 6, **more)
    assert len(expected) > 15
    monkeypatch.setattr(C, "RANGE", 8)
    monkeypatch.setattr(C, "SHARD", 50)
    monkeypatch.setattr(C, "CHUNK", 700)
    monkeypatch.setattr(C, "FAN", 3)
    assert found(spark, docs, min_count=6, **more) == expected


def test_colliding_hashes_change_nothing(spark, monkeypatch):
    docs = made(5, 80)
    monkeypatch.setattr(C, "mixed", lambda h: h & C.np.uint64(0xF << 60))
    assert found(spark, docs, min_count=5) == plain(docs, 5)


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 10)
    for text in (b"abc def. ghi jkl, mno pqr stu vwx yza bcd. e", b"no mark in it at all, but one", b"", b"." * 50):
        parts = [part for _, part in C.split_long(b"en", text)]
        assert b"".join(parts) == text and all(part[-1:] in C.BREAKS for part in map(bytes, parts[:-1]))


def test_odd_rows(spark):
    docs = [(None, None), ("en", ""), ("en", " .,"), ("und", "one two"), (None, "One  two"), ("en", "a " * 50000),
            ("de", "a b"), ("de", "a b"), ("", "x y x y")]
    assert found(spark, docs, min_count=2) == plain(docs, 2)
    assert found(spark, docs[:3], min_count=1) == []
    assert found(spark, [], min_count=1) == []
    frame = spark.createDataFrame([("en", "a b", 1, "x", None)], "lang string, text string, n int, phrase string, rank int")
    assert [tuple(r)[:4] for r in C.collocations(frame, min_count=1).collect()] == [("en", 1, "a b", 1)]


@pytest.mark.parametrize("small", [0, 512])
def test_arrays_fold_as_phrases_one_by_one(monkeypatch, small):
    monkeypatch.setattr(A, "SMALL", small)
    for seed in range(40):
        phrases = sorted(some_phrases(seed, seed * 20).items())
        words = sorted({word for phrase, _ in phrases for word in phrase})
        ids = np.array([[*map(words.index, p), *[-1] * (5 - len(p))] for p, _ in phrases], np.int32).reshape(-1, 5)
        one, other = build(phrases), built(words, ids, np.array([n for _, n in phrases], np.int64))
        assert (other.words, len(other.first), len(other.label)) == (one.words, len(one.first), len(one.label))
        for automaton in (one, other, Automaton.from_bytes(other.to_bytes())):
            assert list(automaton.items()) == phrases
            unfolded, counts = automaton.rows()
            assert [(tuple(automaton.words[i] for i in row if i >= 0), n)
                    for row, n in zip(unfolded.tolist(), counts.tolist(), strict=True)] == phrases
        assert union([one, other], 3, always=1).words == union([build((p, 2 * n) for p, n in phrases if 2 * n >= 3 or
                                                                      len(p) == 1)]).words


def test_a_shard_holds_no_more_than_its_phrases(spark, monkeypatch):
    monkeypatch.setattr(C, "SHARD", 50)
    monkeypatch.setattr(C, "HELD", 300, raising=False)
    docs = [(lang or "und", text) for lang, text in made(6, 60)]
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(2).selectExpr(
        "cast(lang as binary) lang", "cast(text as binary) text")
    shards = [list(Automaton.from_bytes(row["data"]).items()) for row in C.shards_of(frame, [], 3).collect()]
    assert len(shards) > 10 and max(map(len, shards)) <= 50
    added = Counter()
    for shard in shards:
        added.update(dict(shard))
    expected = Counter()
    for lang, text in docs:
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", text.translate(LOWER).encode()):
            words = re.findall(rb"[^\x20\x09]+", piece)
            expected[(lang.encode(),)] += len(words)
            expected.update((lang.encode(), *words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    assert added == Counter({p: n for p, n in expected.items() if n})


def test_ranges_are_cut_at_the_borders():
    phrases = sorted(some_phrases(9, 300).items())
    for borders in ([], [phrases[0][0]], [p for p, _ in phrases[5::7]], [(b"",), *(p for p, _ in phrases[100:104]), (b"z",)]):
        whole = Automaton.from_bytes(build(phrases).to_bytes())
        assert ([(place, list(part.items())) for place, part in C.cut_rows(whole, borders)]
                == [(place, list(part.items())) for place, part in C.cut_at(phrases, borders)])


def test_python_gets_small_batches_meanwhile(spark, monkeypatch):
    names = [f"spark.sql.execution.arrow.{x}PerBatch" for x in ("maxRecords", "maxBytes")]
    before, seen = [spark.conf.get(name) for name in names], []

    def stop(*_):
        seen.extend(int(spark.conf.get(name)) for name in names)
        raise KeyError("stop")

    monkeypatch.setattr(C, "frequent_phrases", stop)
    with pytest.raises(KeyError, match="stop"):
        found(spark, [("en", "a b")])
    assert seen[0] <= 1000 and seen[1] <= 4 << 20 and [spark.conf.get(name) for name in names] == before
