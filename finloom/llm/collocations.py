"""Phrase collocations: phrases whose words come together more often than their parts let expect.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` and those pieces into words at spaces and tabs; a phrase lies
within a piece. Everything is counted by language (null: ``und``).

1. Pruning, one pass for each length. A phrase is frequent only if its first and its last words but one are, so a pass
   counts the hashes of just those phrases whose shorter ones were frequent. The hashes of the frequent ones become a bit
   array of ``FILTER_BITS`` bits. Hashes rule out, they don't decide: what collides is counted again by its words.
2. Shards. A last pass counts the phrases that are left by their words. The language is a phrase's first symbol and its
   own count that of all words. A task holds them as rows of word numbers in arrays and adds them up whenever ``HELD``
   rows have come; ``SHARD`` at a time, sorted, become a count transducer (``automata``).
3. Prefix ranges. Phrases whose hash is a multiple of ``RANGE`` are the borders between ranges: about ``RANGE`` phrases
   lie between two, below whatever prefix, so no range grows with a frequent word. Shards are cut at the borders, and the
   transducers of a range are united, counts added, first in ``SLOTS`` groups, then as a whole.
4. Parts. A range asks for the parts of its candidates with one acceptor for each range that holds some. There it is
   composed with the count transducer, and the answer goes back.
5. Scores are exact: Python integers. Candidates that a longer one covers go, and each language keeps its first ones.

What a task holds depends on none of the input's size, the documents in a file or the shards in one: Spark hands rows on in
batches of ``BATCH`` rows or ``BATCH_BYTES``.

Defined cases: a null or empty text has no words; rows with one ``doc_id`` all count; ``doc_id`` and other columns are not
read; an empty table gives an empty result; a null language and ``und`` are one.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import count as numbers
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finloom.llm.automata import Automaton, build, built, compose, summed, union
from finloom.llm.common import Scratch, cut, table

MIN_COUNT, MAX_WORDS, TOP, COVERED = 100, 5, 2000, 100
FILTER_BITS = 1 << 26
FILTER_BLOCKS = 128
CHUNK = 1 << 19  # bytes of text looked at together
SEEN = 1 << 19  # different hashes a task adds up before it hands them on
HELD = 3 << 18  # rows of phrases a task adds up before it hands them on
SHARD = 1 << 16
RANGE = 1 << 12
SLOTS, FAN = 16, 32
BATCH, BATCH_BYTES = 1000, 4 << 20
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
NO_LANGUAGE = "und"

BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KIND = np.zeros(256, np.uint8)  # 0: of a word
KIND[list(b" \t")] = 1
KIND[list(BREAKS)] = 2
BASE = 0x9E3779B97F4A7C15
MIXERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
Pieces = Iterator[tuple[bytes, bytes]]


def powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


POWERS, INVERSE = {}, {}  # by size, made once per worker


def powers_for(size: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK + 1, 1 << (size - 1).bit_length())
    if size not in POWERS:
        POWERS[size], INVERSE[size] = powers(BASE, size), powers(pow(BASE, -1, 1 << 64), size)
    return POWERS[size], INVERSE[size]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIXERS[0]
    h = (h ^ (h >> np.uint64(27))) * MIXERS[1]
    return h ^ (h >> np.uint64(31))


class Chunk:
    """The words of some texts: their bytes, places, whether each follows the word before it, language and hash."""

    def __init__(self, langs: list[bytes], texts: list[bytes]):
        self.data = LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
        kind = KIND[self.data]
        inside = np.concatenate([[False], kind == 0, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        self.follows = np.concatenate([[False], piece[1:] == piece[:-1]]) if len(piece) else np.zeros(0, bool)
        self.langs = sorted(set(langs))
        number = {lang: i for i, lang in enumerate(self.langs)}
        borders = np.cumsum([len(text) + 1 for text in texts])
        self.lang = np.array([number[lang] for lang in langs])[np.searchsorted(borders, self.starts, "right")]
        self.hashes = self.word_hashes()

    def word_hashes(self) -> np.ndarray:
        up, down = powers_for(len(self.data) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((self.data.astype(np.uint64) + np.uint64(1))
                                                          * up[:len(self.data)], dtype=np.uint64)])
        own = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        of_lang = np.array([xxhash.xxh64_intdigest(lang) for lang in self.langs], np.uint64)
        return mixed(own + (self.ends - self.starts).astype(np.uint64) * MIXERS[0]) ^ of_lang[self.lang]

    def phrases(self, filters: list[np.ndarray], length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """By length the places where a phrase starts that may be frequent, and its hash.

        The filter of a length rules phrases of it out, where there is one.
        """
        at, own = np.arange(len(self.starts)), self.hashes
        for words in range(1, length + 1):
            if words > 1:
                # Both its first and its last words but one must be left.
                left = np.zeros(len(self.starts) + words, bool)
                left[at] = True
                keep = left[at + 1] & np.append(self.follows, np.zeros(words, bool))[at + words - 1]
                at, own = at[keep], own[keep]
                own = mixed(own * MIXERS[1] + self.hashes[at + words - 1] + np.uint64(words))
            if words <= len(filters):
                keep = (filters[words - 1][own >> np.uint64(41)] >> (own >> np.uint64(38)).astype(np.uint8) % 8) & 1 > 0
                at, own = at[keep], own[keep]
            yield at, own


def split_long(lang: bytes, text: bytes) -> Pieces:
    """The text in parts of about ``CHUNK`` bytes, cut after a mark that ends a piece."""
    at = 0
    while len(text) - at > CHUNK:
        end = 1 + max(text.rfind(mark, at, at + CHUNK) for mark in (BREAKS[i:i + 1] for i in range(len(BREAKS))))
        if end <= at:
            later = [x for x in (text.find(BREAKS[i:i + 1], at + CHUNK) for i in range(len(BREAKS))) if x >= 0]
            end = 1 + min(later, default=len(text))
        yield lang, text[at:end]
        at = end
    yield lang, text[at:]


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    langs, texts, size = [], [], 0
    for batch in batches:
        for whole in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            for lang, text in split_long(*whole):
                if size and size + len(text) > CHUNK:
                    yield Chunk(langs, texts)
                    langs, texts, size = [], [], 0
                langs.append(lang)
                texts.append(text)
                size += len(text) + 1
    if texts:
        yield Chunk(langs, texts)


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def hash_counts(docs: DataFrame, filters: list, length: int) -> DataFrame:
    """How often the hash of each phrase of this length occurs, of phrases whose shorter ones may be frequent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [np.frombuffer(shared.value, np.uint8) for shared in filters]

        def handed(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["h", "n"])

        parts, size = [], 0
        for chunk in chunks_of(batches):
            *_, (_, own) = chunk.phrases(bits, length)
            parts.append(np.unique(own, return_counts=True))
            size += len(parts[-1][0])
            if size > SEEN:
                parts = [added(parts)]
                size = len(parts[0][0])
                if size > SEEN // 2:
                    yield handed(*parts[0])
                    parts, size = [], 0
        if parts:
            yield handed(*added(parts))

    return docs.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def filter_of(spark: SparkSession, hashes: DataFrame):
    """The hashes as a broadcast bit array of fixed size."""
    block_bytes = FILTER_BITS // FILTER_BLOCKS // 8

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, bits = None, np.zeros(0, np.uint8)
        for batch in batches:
            places = batch["place"].to_numpy()
            for block in np.unique(batch["block"]).tolist():
                if block != now:
                    if now is not None:
                        yield pd.DataFrame({"block": [now], "bits": [zlib.compress(bits.tobytes(), 1)]})
                    now, bits = block, np.zeros(block_bytes, np.uint8)
                own = places[batch["block"] == block]
                np.bitwise_or.at(bits, own >> 3, (1 << (own & 7)).astype(np.uint8))
        if now is not None:
            yield pd.DataFrame({"block": [now], "bits": [zlib.compress(bits.tobytes(), 1)]})

    spots = hashes.select(F.expr("cast(shiftrightunsigned(h, 57) as int)").alias("block"),
                          F.expr("cast(shiftrightunsigned(h, 38) & 524287 as int)").alias("place"))
    rows = spots.repartition("block").sortWithinPartitions("block").mapInPandas(fill, "block int, bits binary")
    whole = bytearray(FILTER_BITS // 8)
    with Scratch(spark) as scratch:  # written, so that the counts leave the disks
        for row in scratch.cut(rows, "phrase-filter").toLocalIterator():  # FILTER_BLOCKS rows of fixed size
            whole[row["block"] * block_bytes:(row["block"] + 1) * block_bytes] = zlib.decompress(row["bits"])
    return spark.sparkContext.broadcast(bytes(whole))


def phrase_rows(chunk: Chunk, bits: list[np.ndarray], length: int, number: dict) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's different phrases as rows of numbers of their language and words (``number``), with their counts."""
    langs = np.array([number[lang] for lang in chunk.langs], np.int32)
    totals = np.bincount(chunk.lang, minlength=len(langs))
    blocks, counts = [np.full((len(langs), length + 1), -1, np.int32)], [totals]
    blocks[0][:, 0] = langs
    data, ids, rank = chunk.data.tobytes(), np.full(len(chunk.starts), -1, np.int64), chunk.lang.astype(np.int64)
    for n, (at, _) in enumerate(chunk.phrases(bits, length), 1):
        if n == 1:
            said = map(data.__getitem__, map(slice, chunk.starts[at].tolist(), chunk.ends[at].tolist()))
            ids[at] = np.fromiter(map(number.__getitem__, said), np.int64, len(at))
        # Phrases are told apart by that of their first words and their last word, both exact numbers.
        _, first, place, times = np.unique(rank[at] * len(number) + ids[at + n - 1], return_index=True,
                                           return_inverse=True, return_counts=True)
        rank[at] = place
        own = at[first]
        rows = np.full((len(own), length + 1), -1, np.int32)
        rows[:, 0] = langs[chunk.lang[own]]
        rows[:, 1:n + 1] = ids[own[:, None] + np.arange(n)]
        blocks.append(rows)
        counts.append(times)
    ids, counts = np.concatenate(blocks), np.concatenate(counts)
    return ids[counts > 0], counts[counts > 0]


def shards_of(docs: DataFrame, filters: list, length: int) -> DataFrame:
    """Count transducers of the phrases that are left (``data``), and the borders among them (``border``)."""

    def shards(number: dict, ids: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        words, known = sorted(number), list(number)
        order = {word: i for i, word in enumerate(words)}
        ids, counts = summed(np.array([*map(order.__getitem__, known), -1], np.int32)[ids], counts, len(words))
        for start in range(0, len(ids), SHARD):
            own = ids[start:start + SHARD]
            borders = [pack(tuple(words[i] for i in row if i >= 0)) for row in own[are_borders(words, own, RANGE)].tolist()]
            data = built(words, own, counts[start:start + SHARD]).to_bytes()
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary()), pa.array([borders], pa.list_(pa.binary()))],
                                             ["data", "borders"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [np.frombuffer(shared.value, np.uint8) for shared in filters]
        number, parts, size = defaultdict(numbers().__next__), [], 0
        for chunk in chunks_of(batches):
            parts.append(phrase_rows(chunk, bits, length, number))
            size += len(parts[-1][0])
            if size >= HELD or len(number) >= HELD // 8:
                parts = [added_rows(parts, len(number))]
                size = len(parts[0][0])
                if size >= HELD * 3 // 4 or len(number) >= HELD // 8:
                    yield from shards(number, *parts.pop())
                    number, size = defaultdict(numbers().__next__), 0
        if parts:
            yield from shards(number, *added_rows(parts, len(number)))

    return docs.mapInArrow(look, "data binary, borders array<binary>")


def added_rows(parts: list[tuple[np.ndarray, np.ndarray]], words: int) -> tuple[np.ndarray, np.ndarray]:
    ids, counts = np.concatenate([ids for ids, _ in parts]), np.concatenate([counts for _, counts in parts])
    parts.clear()
    return summed(ids, counts, words)


def pack(phrase: tuple[bytes, ...]) -> bytes:
    return build([(phrase, 1)]).to_bytes()


def are_borders(words: list[bytes], ids: np.ndarray, every: int) -> np.ndarray:
    """Which phrases are borders: by a hash of their words, so it is the same ones in each shard."""
    own = np.array([*map(xxhash.xxh64_intdigest, words), 0], np.uint64)
    h = np.zeros(len(ids), np.uint64)
    for column in ids.T:
        longer = (h ^ own[column]) * MIXERS[0]
        h = np.where(column >= 0, longer ^ (longer >> np.uint64(29)), h)
    return (h % np.uint64(every) == 0) & ((ids >= 0).sum(axis=1) > 1)


def cut_at(phrases: Iterator[tuple[tuple[bytes, ...], int]], borders: list) -> Iterator[tuple[int, Automaton]]:
    """Ascending phrases as one automaton per prefix range."""
    now, held = None, []
    for phrase, weight in phrases:
        place = bisect_right(borders, phrase)
        if place != now:
            if held:
                yield now, build(held)
            now, held = place, []
        held.append((phrase, weight))
    if held:
        yield now, build(held)


def cut_rows(whole: Automaton, borders: list) -> Iterator[tuple[int, Automaton]]:
    """The same of a whole automaton, by the rows that the borders stand before."""
    ids, counts = whole.rows()

    def phrase(row: int) -> tuple[bytes, ...]:
        return tuple(whole.words[i] for i in ids[row].tolist() if i >= 0)

    start, place = 0, bisect_right(borders, phrase(0)) if len(ids) else 0
    while start < len(ids):
        end = bisect_left(range(len(ids)), borders[place], start, key=phrase) if place < len(borders) else len(ids)
        if end > start:
            yield place, built(whole.words, ids[start:end], counts[start:end])
        start, place = end, place + 1


def united(pieces: DataFrame, keys: list[str], least: int = 1) -> DataFrame:
    """One transducer for each key, ``FAN`` at a time in memory. Totals of a language stay whatever their count."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []

        def done() -> pd.DataFrame:
            return pd.DataFrame({"range": [key[0]], "data": [union(held, least, always=1).to_bytes()]})

        for batch in batches:
            for *own, data in zip(*(batch[k] for k in keys), batch["data"], strict=True):
                if own != key:
                    if held:
                        yield done()
                    key, held = own, []
                held.append(Automaton.from_bytes(data))
                if len(held) >= FAN:
                    held = [union(held)]
        if held:
            yield done()

    return pieces.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(merge, "range int, data binary")


def ranges_of(shards: DataFrame, borders, least: int) -> DataFrame:
    """The frequent phrases: ``range`` and its count transducer ``data``."""

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["data"]:
                slot = xxhash.xxh64_intdigest(data) % SLOTS
                rows = [(place, slot, part.to_bytes()) for place, part in cut_rows(Automaton.from_bytes(data), borders.value)]
                yield pd.DataFrame(rows, columns=["range", "slot", "data"])

    pieces = shards.select("data").mapInPandas(slices, "range int, slot int, data binary")
    return united(united(pieces, ["range", "slot"]), ["range"], least)


def parts_of(phrase: tuple[bytes, ...]) -> list[tuple[bytes, ...]]:
    """What a candidate's score needs: its language's total and both parts of every cut."""
    lang, words = phrase[:1], phrase[1:]
    return [lang, *(lang + words[:k] for k in range(1, len(words))), *(lang + words[k:] for k in range(1, len(words)))]


def asked(ranges: DataFrame, borders) -> DataFrame:
    """Acceptors of the parts that a range needs from a range: ``range``, ``source``, ``data``."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, data in zip(batch["range"], batch["data"], strict=True):
                parts = {part for phrase, _ in Automaton.from_bytes(data).items() if len(phrase) > 2
                         for part in parts_of(phrase)}
                rows = [(place, source, acceptor.to_bytes())
                        for place, acceptor in cut_at(((p, 1) for p in sorted(parts)), borders.value)]
                yield pd.DataFrame(rows, columns=["range", "source", "data"])

    return ranges.mapInPandas(ask, "range int, source int, data binary")


def answered(ranges: DataFrame, questions: DataFrame) -> DataFrame:
    """The acceptors composed with the counts of their range: ``range`` (that asked), ``source``, ``data``."""

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, counts = None, None
        for batch in batches:
            rows = []
            for at, source, data in zip(batch["range"], batch["source"], batch["data"], strict=True):
                if source < 0:
                    place, counts = at, Automaton.from_bytes(data)
                elif at == place:
                    rows.append((source, at, compose(Automaton.from_bytes(data), counts).to_bytes()))
            yield pd.DataFrame(rows, columns=["range", "source", "data"])

    both = ranges.select("range", F.lit(-1).alias("source"), "data").unionByName(questions)
    return both.repartition("range").sortWithinPartitions("range", "source").mapInPandas(
        answer, "range int, source int, data binary")


def scored(ranges: DataFrame, answers: DataFrame) -> DataFrame:
    """All candidates: ``lang, phrase, a, l, r, n, score`` and the shorter candidates inside (``inner``)."""

    def best(phrase: tuple[bytes, ...], a: int, n: int, known: dict) -> tuple[int, int, int, int]:
        cuts = []
        for k in range(2, len(phrase)):
            left, right = known[phrase[:k]], known[phrase[:1] + phrase[k:]]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        return min(cuts)

    def rows_of(own: Automaton, known: dict) -> Iterator[tuple]:
        for phrase, a in own.items():
            if len(phrase) > 2:
                n = known[phrase[:1]]
                score, _, left, right = best(phrase, a, n, known)
                words = [word.decode("utf-8", "replace") for word in phrase[1:]]
                inner = {" ".join(words[i:i + size]) for size in range(2, len(words))
                         for i in range(len(words) - size + 1)}
                yield (phrase[0].decode("utf-8", "replace"), " ".join(words), a, left, right, n, score, sorted(inner))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, own, known = None, None, {}

        def frames() -> Iterator[pd.DataFrame]:
            rows = rows_of(own, known)
            while some := list(islice(rows, BATCH)):
                yield pd.DataFrame(some, columns=["lang", "phrase", "a", "l", "r", "n", "score", "inner"])

        for batch in batches:
            for at, source, data in zip(batch["range"], batch["source"], batch["data"], strict=True):
                if source < 0:
                    if own is not None:
                        yield from frames()
                    place, own, known = at, Automaton.from_bytes(data), {}
                elif at == place:
                    known.update(Automaton.from_bytes(data).items())
        if own is not None:
            yield from frames()

    both = ranges.select("range", F.lit(-1).alias("source"), "data").unionByName(answers)
    return both.repartition("range").sortWithinPartitions("range", "source").mapInPandas(
        score, "lang string, phrase string, a long, l long, r long, n long, score long, inner array<string>")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile hands rows to Python in small batches; a larger one holds all shards of a file at once."""
    before = {key: spark.conf.get(key) for key in SMALL_BATCHES}
    for key, value in SMALL_BATCHES.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS):
    """The count transducers of all frequent phrases by prefix range, and the borders of the ranges."""
    spark = docs.sparkSession
    plain = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).cast("binary").alias("lang"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    filters = []
    for length in range(1, max_words + 1):
        filters.append(filter_of(spark, hash_counts(plain, filters, length).where(F.col("n") >= min_count)))
    with Scratch(spark) as scratch:
        shards = scratch.cut(shards_of(plain, filters, max_words), "phrase-shards")
        found = shards.select(F.explode("borders").alias("border")).distinct()
        borders = sorted(next(Automaton.from_bytes(row["border"]).items())[0] for row in found.toLocalIterator())
        shared = spark.sparkContext.broadcast(borders)  # one phrase in RANGE
        return cut(ranges_of(shards, shared, min_count), "phrase-ranges"), shared


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 covered: int = COVERED) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A candidate goes if some longer one that holds it occurs in ``covered`` percent of its places or more.
    """
    with small_batches(docs.sparkSession):
        ranges, borders = frequent_phrases(docs, min_count, max_words)
        candidates = cut(scored(ranges, answered(ranges, asked(ranges, borders))), "phrase-candidates")
    longer = (candidates.select("lang", F.explode("inner").alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = candidates.drop("inner").join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS pos
           FROM worded, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
counted AS (SELECT lang, k, w[pos:pos + k - 1] AS p, count(*) AS f FROM starts GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM counted WHERE k > 1 AND f >= 100),
cuts AS (SELECT lang, k, p, f, unnest(range(1, k)) AS c FROM candidates),
valued AS (
  SELECT c.lang, c.k, c.p, c.f AS a, x.f AS l, y.f AS r, n, c.c,
         ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
       JOIN counted x ON x.lang = c.lang AND x.p = c.p[1:c.c] JOIN counted y ON y.lang = c.lang AND y.p = c.p[c.c + 1:c.k]),
best AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
inner_starts AS (SELECT lang, p, f, k, size, unnest(range(1, k - size + 2)) AS pos
                 FROM candidates, (SELECT unnest(range(2, 5)) AS size) WHERE size < k),
longer AS (SELECT lang, p[pos:pos + size - 1] AS p, max(f) AS f FROM inner_starts GROUP BY ALL),
kept AS (SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM best b
         LEFT JOIN longer o ON o.lang = b.lang AND o.p = b.p WHERE o.f IS NULL OR 100 * o.f < 100 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
