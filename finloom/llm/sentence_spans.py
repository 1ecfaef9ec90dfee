"""Substring dedup by sliding sentence spans.

A sentence ends after a run of full stops, exclamation or question marks, with the quotes and brackets that close behind
it, where white space or the text's end follows; after ideographic stops; and at a line's end. Addresses, numbers and
abbreviations within a word so stay whole. The spans of a text are runs of consecutive sentences with at least ``WORDS``
words (two ideographs or kana count as a word more): from every sentence the shortest that begins with it, and the shortest that ends with it. Any repeated run of
sentences with so many words consists of spans that repeat, however many sentences it takes, and short phrases that
everybody says are no spans.

The spans of all documents meet in one grouping; of a span that occurs more than once every occurrence but the first (by
``doc_id``, then position) is a repeat, and the sentences it covers go. What is first is judged on the input, not on what
is left. Spans are compared in lower case with white space folded.

Partial aggregation folds frequent spans before they are shuffled, the join that marks their occurrences is split by
Spark where a span is in very many documents, and texts without a repeat stay where they are.

Defined cases: a null text stays null; a text without a sentence (empty, or only marks and spaces) stays as it is;
rows with one ``doc_id`` and one text are the same document and fare alike; a null ``doc_id`` comes before all
others; white space before a removed sentence goes with it; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.llm.common import among, cut, fresh, table

WORDS = 20
BLANK = " \t\n\x0b\x0c\r.!?"
CLOSING = "\"'”’»)\\]}"
WIDE = re.compile("[\u3040-\u30ff\u3400-\u9fff]")  # two of these count as a word
ENDS = re.compile(rf"[.!?]+[{CLOSING}]*(?=[\x09-\x0D ]|\Z)|[。！？｡]+[{CLOSING}」』）]*|(?=\n)")


def pieces_of(text: str) -> list[str]:
    """The sentences as they stand, each with what precedes it; only marks and spaces may follow the last."""
    out, begin = [], 0
    for match in ENDS.finditer(text):
        end = match.end()
        if end > begin and text[begin:end].strip(BLANK):
            out.append(text[begin:end])
            begin = end
    if text[begin:].strip(BLANK):
        out.append(text[begin:])
    return out


def said_in(piece: str) -> list[bytes]:
    return piece.lower().encode("utf-8", "surrogatepass").split()  # bytes: only ASCII white space splits


def size_of(piece: str, words: list[bytes]) -> int:
    return len(words) + (0 if piece.isascii() else len(WIDE.findall(piece)) // 2)


def spans_of(counts: list[int], least: int) -> list[tuple[int, int]]:
    """Where the spans of sentences with so many words begin and end (inclusive), each once."""
    ends = np.cumsum(counts)
    before = ends - counts
    last = np.searchsorted(ends, before + least)  # of the shortest span from each sentence on
    first = np.searchsorted(before, ends - least, "right") - 1  # of the shortest span up to each
    spans = {(i, j) for i, j in enumerate(last.tolist()) if j < len(counts)}
    return sorted(spans | {(i, j) for j, i in enumerate(first.tolist()) if i >= 0})


def runs_of(docs: DataFrame, least: int) -> DataFrame:
    """Every hashed span: ``doc_id, row, pos, k, a, b``; ``row`` is a hash of the text."""
    names, kinds = ["doc_id", "row", "pos", "k", "a", "b"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(),
                                                            pa.int64()]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            rows, keys = [], []
            for doc_id, row, text in zip(*(batch[name].to_pylist() for name in ("doc_id", "row", "text")), strict=True):
                own = pieces_of(text)
                said = [said_in(piece) for piece in own]
                marks = b"".join([digest(b" ".join(words)) for words in said])
                for i, j in spans_of(list(map(size_of, own, said)), least) if said else ():
                    rows.append((doc_id, row, i, j - i + 1))
                    keys.append(digest(marks[16 * i:16 * (j + 1)]))
            if rows:
                both = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
                columns = [*zip(*rows, strict=True), np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)], names)

    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"),
                                                  F.xxhash64("text").alias("row"), "text")
    return texts.mapInArrow(look, "doc_id long, row long, pos int, k int, a long, b long")


def repeated_sentences(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """Per document with repeats: ``doc_id``, ``row`` (hash of its text) and ``gone`` (sentence numbers)."""
    runs = cut(runs_of(docs, least), "spans")
    firsts = (runs.groupBy("a", "b").agg(F.min(F.struct("doc_id", "pos", "row")).alias("first"),
                                         F.count("*").alias("n")).where("n > 1").select("a", "b", "first"))
    repeats = runs.join(firsts, ["a", "b"]).where(
        "not (first.doc_id <=> doc_id and first.pos = pos and first.row = row)")
    return (repeats.select("doc_id", "row", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("k") - 1))
                           .alias("at"))
            .groupBy("doc_id", "row").agg(F.collect_set("at").alias("gone")))  # at most the document's sentences


def rest_of(text: Column, gone: Column) -> Column:
    """The number of sentences, and the text without those that go (null: none go)."""
    @F.pandas_udf("n int, text string")
    def kept(texts: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        rows = []
        for text, at in zip(texts, numbers, strict=True):
            pieces = pieces_of(text) if text is not None else []
            if at is None:
                rows.append((len(pieces), None))  # the text as it is needs no way back
                continue
            out = set(at.tolist())
            rest = text[sum(map(len, pieces)):]
            rows.append((len(pieces), "".join(p for i, p in enumerate(pieces) if i not in out) + rest))
        return pd.DataFrame(rows, columns=["n", "text"])

    return kept(text, gone)


def dedup_spans(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """All documents, ``text`` without its repeats, and two more columns: ``n_sentences``, ``n_removed``."""
    key, row, at, said = (fresh(docs, f"span_{name}") for name in ("key", "row", "gone", "rest"))
    gone = repeated_sentences(docs.select("doc_id", "text"), least).select(
        F.col("doc_id").alias(key), F.col("row").alias(row), F.col("gone").alias(at))
    gone = cut(gone, "spans-gone")
    # Documents that surely keep all sentences are not shuffled.
    touched = among([docs["doc_id"].cast("long"), F.xxhash64(docs["text"])], gone, [key, row])
    near = docs.where(touched)
    near = near.join(gone, near["doc_id"].cast("long").eqNullSafe(gone[key])
                     & (F.xxhash64(near["text"]) == gone[row]), "left").drop(key, row)
    joined = near.unionByName(docs.where(~touched).withColumn(at, F.lit(None).cast("array<int>")))
    joined = joined.withColumn(said, rest_of(F.col("text"), F.col(at)))
    return (joined.withColumn("n_sentences", F.col(f"{said}.n"))
            .withColumn("n_removed", F.coalesce(F.size(at), F.lit(0)))
            .withColumn("text", F.when(F.col(at).isNull(), F.col("text")).otherwise(F.col(f"{said}.text")))
            .drop(at, said))


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


# Sentence ends are marked with a character of the private use area, which no text holds.
OP6_SQL = rf"""
WITH marked AS (
  SELECT doc_id, text, regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''),
           '([.!?]+[{CLOSING.replace("'", "''")}]*)([\x09-\x0D ]|$)', '\1' || chr(57344) || '\2', 'g'),
           '([。！？｡]+[{CLOSING.replace("'", "''")}」』）]*)', '\1' || chr(57344), 'g'), '\n', chr(57344) || chr(10), 'g') AS m
  FROM documents),
parts AS (SELECT doc_id, string_split(m, chr(57344)) AS p FROM marked),
numbered AS (
  SELECT doc_id, unnest(p) AS part, unnest(range(len(p))) AS i FROM parts),
grouped AS (  -- a part of only marks and spaces belongs to the sentence after it
  SELECT *, coalesce(sum(CASE WHEN regexp_matches(part, '[^\x09-\x0D .!?]') THEN 1 ELSE 0 END)
                       OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nr
  FROM numbered),
glued AS (SELECT doc_id, nr::INTEGER AS nr, string_agg(part, '' ORDER BY i) AS piece FROM grouped GROUP BY ALL),
pieces AS (SELECT * FROM glued WHERE regexp_matches(piece, '[^\x09-\x0D .!?]')),
tails AS (SELECT doc_id, piece AS tail FROM glued WHERE NOT regexp_matches(piece, '[^\x09-\x0D .!?]')),
said AS (
  SELECT doc_id, nr, piece, lower(trim(regexp_replace(piece, '[\x09-\x0D ]+', ' ', 'g'))) AS s FROM pieces),
sized AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY nr) AS upto FROM (
    SELECT *, len(string_split(s, ' ')) + len(regexp_replace(s, '[^\x{{3040}}-\x{{30ff}}\x{{3400}}-\x{{9fff}}]', '', 'g')) // 2 AS n
    FROM said)),
spans AS (
  SELECT a.doc_id, a.nr AS i, min(b.nr) AS j FROM sized a JOIN sized b
    ON b.doc_id = a.doc_id AND b.nr >= a.nr AND b.upto - a.upto + a.n >= {WORDS} GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.nr), b.nr FROM sized a JOIN sized b
    ON b.doc_id = a.doc_id AND b.nr >= a.nr AND b.upto - a.upto + a.n >= {WORDS} GROUP BY b.doc_id, b.nr),
lists AS (SELECT doc_id, list(s ORDER BY nr) AS s FROM said GROUP BY doc_id),
runs AS (SELECT doc_id, i, j, s[i + 1:j + 1] AS run FROM spans JOIN lists USING (doc_id)),
counted AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS nth FROM runs),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS nr FROM counted WHERE nth > 1),
kept AS (
  SELECT n.doc_id, count(*) AS n_sentences, count(g.nr) AS removed,
         string_agg(n.piece, '' ORDER BY n.nr) FILTER (g.nr IS NULL) AS rest
  FROM pieces n LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.nr = n.nr GROUP BY n.doc_id)
SELECT d.doc_id, coalesce(n_sentences, 0)::INTEGER AS n_sentences, coalesce(removed, 0)::INTEGER AS n_removed,
       CASE WHEN coalesce(removed, 0) = 0 THEN text ELSE coalesce(rest, '') || coalesce(tail, '') END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN tails t ON t.doc_id = d.doc_id
"""
