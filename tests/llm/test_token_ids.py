"""Simple-8b round trips, and the token files against the tokenizer itself."""

from pathlib import Path
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from finloom.llm import simple8b, token_ids

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_50k.json")
WIDE = st.one_of(st.integers(0, 1), st.integers(0, 3000), st.integers(0, 2**64 - 1))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(WIDE, st.just(0)), max_size=300))
def test_words_round_trip(values):
    array = np.array(values, np.uint64)
    words, escaped = simple8b.encode(array)
    assert simple8b.decode(words, escaped, len(array)).tolist() == values
    assert len(escaped) == sum(v >= 2**60 for v in values)
    assert len(words) <= max(1, len(values))


def test_small_values_share_words():
    assert len(simple8b.encode(np.zeros(240, np.uint64))[0]) == 2
    assert len(simple8b.encode(np.full(600, 1000, np.uint64))[0]) == 100


def plain(rows):
    tokenizer = Tokenizer.from_file(FILE)
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_tokenizer(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    rows = token_ids.op7_token_ids(spark, SF).collect()
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == plain(docs)


@pytest.mark.parametrize("size", [1, 64])
def test_odd_rows(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(token_ids, "REMEMBERED", 3)
    rows = [(None, "x y"), (-4, None), (1, ""), (2, " lead"), (3, "two  spaces\n\nlines \t tab nb"), (4, "a\nb c"),
            (5, "don't it's <|endoftext|> done"), (6, "café 你好 \U0001f600 1,234.5 ___"), (7, "rep " * 3000),
            (8, "same"), (8, "same"), (9, "end ")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("x")).repartition(3)
    path = str(tmp_path / "ids")
    token_ids.write_ids(frame, path, Path(FILE).read_text(encoding="utf-8"))
    found = token_ids.read_ids(spark, path)
    got = sorted((tuple(r) for r in found.collect()), key=lambda r: r[1])
    assert [r[:4] for r in got] == plain(rows)
    assert all(crc32(np.array(r[4], "<u4").tobytes()) == r[3] for r in got)


def test_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([], "doc_id long, text string")
    token_ids.write_ids(frame, str(tmp_path / "none"), Path(FILE).read_text(encoding="utf-8"))
    assert token_ids.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_plain_words_have_the_ids_of_the_whole_tokenizer():
    encoder = token_ids.Encoder(Path(FILE).read_text(encoding="utf-8"))
    signs = "abXYZéßĀɏЀҁяぁゖァヺ一鿌가힣ñ09,.;:'!?-_()[]`~{}$+<=>|^\\/\"#%&*@"
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list(signs), rng.integers(1, 6))) + end for end in ("", ".", "'s", "')", "...", "'")
             for _ in range(400)] + ["Straße,", "12.", "don't", "re'"]
    for known in (encoder.spaced, encoder.first):
        assert known.plain
        for word in words:
            assert np.frombuffer(known[word], "<u4").tolist() == encoder.tokenizer.encode(
                known.before + word, add_special_tokens=False).ids
    calls = []
    encoder.spaced.tokenizer = type("Counted", (), {"encode": lambda self, text, **_: calls.append(text)})()
    assert encoder.spaced["unheard"] and encoder.spaced["unheard,"] and not calls


@pytest.mark.parametrize("text", ["a b", "a\tb  c", " a", "a ", "a\n\nb", "a\nb c", "", "a b  c", "a  b", "a\x1cb"])
def test_loose_is_what_the_pattern_says(text):
    assert token_ids.loose(text) == bool(token_ids.LOOSE.search(text))


@pytest.mark.parametrize("size", [1, 40, 1 << 22])
def test_pieces_of_a_slice_are_looked_up_once(monkeypatch, size):
    import pyarrow as pa

    monkeypatch.setattr(token_ids, "SLICE", size)
    encoder = token_ids.Encoder(Path(FILE).read_text(encoding="utf-8"))
    texts = ["the same words", "", " lead", "a\nthe same words\nb", "two  spaces", "end\n", "x <|endoftext|> y", "a\tb c"] * 9
    asked, known = [], encoder.spaced

    class Asked:
        line_end = known.line_end

        def __getitem__(self, piece):
            asked.append(piece)
            return known[piece]

    encoder.spaced = Asked()
    parts = list(token_ids.slices(pa.array(texts)))
    found = [ids.tolist() for part in parts for ids in encoder.ids(part)]
    assert found == [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert sum(map(len, parts)) == len(texts) and (len(parts) == 1) == (size > 40)
    assert size < 50 or len(asked) == len(set(asked))


def test_blocks_are_read_where_they_lie(spark, tmp_path):
    """The blocks' places are broadcast to them, also where Spark by itself would shuffle both."""
    frame = spark.createDataFrame([(1, "x y"), (2, "z")], "doc_id long, text string")
    token_ids.write_ids(frame, str(tmp_path / "ids"), Path(FILE).read_text(encoding="utf-8"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = token_ids.read_ids(spark, str(tmp_path / "ids"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not any("number#" in line.split("]")[0] for line in plan.split("\n") if "SortMergeJoin" in line)
