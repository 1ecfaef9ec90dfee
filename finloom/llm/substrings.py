"""Substring dedup by suffix arrays: bytes covered by a ``LENGTH``-byte string that also starts elsewhere.

1. Anchors. In every string of ``LENGTH`` bytes the ``GRAM``-byte piece with the smallest hash is its anchor (the last
   of equals). Equal strings have equal anchors, so only strings of one anchor hash need comparing. Neighbouring
   strings mostly share the anchor; the stretch of text under them is one row, with a hash of its bytes.
2. One grouping by anchor tells stretches whose anchor occurs once (nothing repeats), those whose anchor always has
   the same stretch (all of it repeats) and the rest. Of the rest each different stretch is fetched once.
3. Shards of stretches are sorted by induced sorting; the common prefixes of neighbours in the suffix array, taken in
   order of places, show which strings repeat. A shard holds whole anchors and a bounded number of bytes. An anchor whose
   different stretches are more than fit a shard is split: its strings are dealt by their own hash, and those that
   meet another are found by counting.
4. The strings found are mapped back to every occurrence of their stretch, and to bytes per document.

Copies never multiply: equal stretches are folded before they are shuffled, however many there are. Documents without a
repeat are kept out of the last join by a filter of fixed size (it may let some through, it loses none).

Defined cases: a null text is empty; every row is a document, so repeated rows repeat each other; texts shorter than
``LENGTH`` bytes keep all; rows are told apart by ``doc_id`` and text, and a null ``doc_id`` is a value like others; other
columns are not read. Hashes decide which strings are compared and that two stretches are the same (128 bits).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.llm.common import among, cut, drop_folder, table, text_of, work_folder
from finloom.llm.suffixes import permuted_common_prefixes, suffix_array

LENGTH, GRAM = 200, 32
WINDOW = LENGTH - GRAM + 1
CHUNK = 1 << 19  # strings looked at together
SHARD_BYTES = 1 << 21  # a shard is closed beyond this, and an anchor with more is split
BASE = 0x9E3779B97F4A7C15
SEPARATOR = 255  # no byte of UTF-8


def powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


POWERS = powers(BASE, CHUNK + LENGTH)
INVERSE = powers(pow(BASE, -1, 1 << 64), CHUNK + LENGTH)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of every ``GRAM`` bytes."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * POWERS[:len(data)],
                                                      dtype=np.uint64)])
    out = (sums[GRAM:] - sums[:-GRAM]) * INVERSE[:len(data) - GRAM + 1]
    for shift in (32, 29):
        out ^= out >> np.uint64(shift)
        out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each string of ``LENGTH`` bytes where its anchor is, and the anchor's hash."""
    places, hashes = [], []
    for begin in range(0, len(data) - LENGTH + 1, CHUNK):
        part = data[begin:begin + CHUNK + LENGTH - 1]
        grams = gram_hashes(part)
        # The low bits tell places apart: the later of equal hashes is the smaller key.
        low = np.uint64((1 << 20) - 1)
        keys = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
        least, span = keys, 1
        while 2 * span <= WINDOW:
            least, span = np.minimum(least[:-span], least[span:]), 2 * span
        rest = WINDOW - span
        least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
        at = (low - (least & low)).astype(np.int64)
        places.append(at + begin)
        hashes.append(grams[at])
    return np.concatenate(places), np.concatenate(hashes)


def stretches(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with one anchor: first start, number of starts, anchor hash, hash of the bytes under them."""
    at, hashes = anchors(np.frombuffer(data, np.uint8))
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.append(first, len(at)))
    digest, view = xxhash.xxh3_64_intdigest, memoryview(data)
    under = np.fromiter((digest(view[a:a + n + LENGTH - 1]) for a, n in zip(first.tolist(), count.tolist(), strict=True)),
                        np.uint64, len(first))
    return first, count, hashes[first], under


def occurrences(docs: DataFrame) -> DataFrame:
    """All stretches: ``doc_id, row, first, starts, anchor, under``. ``docs`` holds ``doc_id, row, data``."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, missing, row, data in zip(batch["doc_id"], batch["missing"], batch["row"], batch["data"],
                                                  strict=True):
                if len(data) >= LENGTH:
                    first, count, anchor, under = stretches(data)
                    yield pd.DataFrame({
                        "doc_id": doc_id, "missing": missing, "row": row, "first": first, "starts": count,
                        "anchor": anchor.view(np.int64), "under": under.view(np.int64)})

    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, rows = [], 0
        for frame in look(batches):
            waiting.append(frame)
            rows += len(frame)
            if rows >= 50_000:
                yield pd.concat(waiting)
                waiting, rows = [], 0
        if waiting:
            yield pd.concat(waiting)

    plain = docs.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("missing"),
                        "row", "data")
    return plain.mapInPandas(gathered, "doc_id long, missing boolean, row int, first int, starts int, anchor long,"
                                       " under long").select(
        F.when(~F.col("missing"), F.col("doc_id")).alias("doc_id"), "row", "first", "starts", "anchor", "under")


def shard_repeats(texts: list[bytes]) -> list[np.ndarray]:
    """For each stretch which of its strings also start elsewhere in the shard."""
    joined = np.frombuffer(bytes([SEPARATOR]).join(texts) + bytes([SEPARATOR]), np.uint8)
    order = suffix_array(joined)
    # Only strings that lie within their stretch count, and what equals one lies within its own.
    lengths = np.array([len(text) for text in texts])
    starts = np.cumsum(lengths + 1) - lengths - 1
    wanted = np.zeros(len(joined) + 1, np.int8)
    wanted[starts] = 1
    wanted[starts + lengths - LENGTH + 1] = -1
    common = permuted_common_prefixes(joined, order, LENGTH, np.cumsum(wanted[:-1]) > 0) >= LENGTH
    # A string repeats if it agrees with the suffix before it or the one after it.
    repeated = common.copy()
    repeated[order[:-1][common[order[1:]]]] = True
    out, at = [], 0
    for text in texts:
        out.append(repeated[at:at + len(text) - LENGTH + 1])
        at += len(text) + 1
    return out


def shard_job(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows ``anchor, under, text`` sorted by anchor -> the stretches with repeats, ``bits`` by start."""
    waiting: list[tuple[int, int, bytes]] = []
    size = 0

    def solve():
        found = shard_repeats([text for _, _, text in waiting])
        kept = [(a, u, np.packbits(bits).tobytes()) for (a, u, _), bits in zip(waiting, found, strict=True)
                if bits.any()]
        return pd.DataFrame(kept, columns=["anchor", "under", "bits"])

    for batch in batches:
        for anchor, under, text in zip(batch["anchor"], batch["under"], batch["text"], strict=True):
            if size >= SHARD_BYTES and waiting[-1][0] != anchor:
                yield solve()
                waiting, size = [], 0
            waiting.append((anchor, under, text))
            size += len(text)
    if waiting:
        yield solve()


def single_strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every string of the stretches by a 128-bit hash."""
    for batch in batches:
        for anchor, under, text in zip(batch["anchor"], batch["under"], batch["text"], strict=True):
            view, n = memoryview(text), len(text) - LENGTH + 1
            hashed = [xxhash.xxh3_128_digest(view[i:i + LENGTH]) for i in range(n)]
            pairs = np.frombuffer(b"".join(hashed), "<i8").reshape(-1, 2)
            yield pd.DataFrame({"anchor": anchor, "under": under, "at": np.arange(n), "a": pairs[:, 0],
                                "b": pairs[:, 1]})


def bits_of(places: Column) -> Column:
    @F.pandas_udf("binary")
    def packed(lists: pd.Series) -> pd.Series:
        out = []
        for places in lists:
            bits = np.zeros(max(places) + 1, bool)
            bits[places] = True
            out.append(np.packbits(bits).tobytes())
        return pd.Series(out)

    return packed(places)


def repeated_strings(docs: DataFrame) -> DataFrame:
    """Stretches with strings that start elsewhere too: ``doc_id, row, first, starts, bits`` (null: all of them)."""
    spark = docs.sparkSession
    folder = work_folder(spark, "substring-stretches")
    occurrences(docs).write.option("compression", "zstd").parquet(folder)
    seen = spark.read.parquet(folder)
    kinds = (seen.groupBy("anchor").agg(F.count("*").alias("n"), F.min("under").alias("least"),
                                        F.max("under").alias("most")).where("n > 1")
             .select("anchor", (F.col("least") == F.col("most")).alias("same")))
    often = cut(seen.join(kinds, "anchor"), "substring-often")
    drop_folder(spark, folder)

    mixed = often.where("not same")
    each = cut(mixed.groupBy("anchor", "under").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "row", "first", "starts")).alias("from")),
        "substring-mixed")
    hot = each.groupBy("anchor").agg(F.sum(F.col("from.starts") + LENGTH - 1).alias("size")).where(
        F.col("size") > SHARD_BYTES).select("anchor")
    hot = cut(hot, "substring-hot")
    wanted = (each.select("anchor", "under", "from.*").groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("anchor", "under", "first", "starts")).alias("parts")))  # of one document each
    wanted = cut(wanted.withColumnsRenamed({"doc_id": "want_id", "row": "want_row"}), "substring-wanted")
    texts = matching(docs, wanted, "want_id", "want_row").dropDuplicates(["want_id", "want_row"])
    texts = texts.select(F.explode(F.transform("parts", lambda p: F.struct(
        p["anchor"].alias("anchor"), p["under"].alias("under"),
        F.substring(F.col("data"), p["first"] + 1, p["starts"] + LENGTH - 1).alias("text")))).alias("p")).select("p.*")
    texts = cut(texts, "substring-texts")

    usual = texts.join(hot, "anchor", "left_anti")
    found = usual.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(
        shard_job, "anchor long, under long, bits binary")
    singles = texts.join(hot, "anchor", "left_semi").mapInPandas(
        single_strings, "anchor long, under long, at int, a long, b long")
    singles = cut(singles, "substring-singles")
    twice = singles.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b")
    in_hot = (singles.join(twice, ["a", "b"]).groupBy("anchor", "under").agg(F.collect_list("at").alias("places"))
              .select("anchor", "under", bits_of(F.col("places")).alias("bits")))
    whole = each.where("n > 1").select("anchor", "under", F.lit(None).cast("binary").alias("bits"))
    partly = found.unionByName(in_hot).join(each.where("n > 1").select("anchor", "under"), ["anchor", "under"],
                                            "left_anti")
    known = cut(whole.unionByName(partly), "substring-known")
    return (often.where("same").select("doc_id", "row", "first", "starts", F.lit(None).cast("binary").alias("bits"))
            .unionByName(mixed.join(known, ["anchor", "under"])
                         .select("doc_id", "row", "first", "starts", "bits")))


def picked(docs: DataFrame, rows: DataFrame, key: str, row: str) -> Column:
    return among([docs["doc_id"], docs["row"]], rows, [key, row])


def matching(docs: DataFrame, rows: DataFrame, key: str, row: str, how: str = "inner") -> DataFrame:
    near = docs.where(picked(docs, rows, key, row))
    return near.join(rows, near["doc_id"].eqNullSafe(rows[key]) & (near["row"] == rows[row]), how)


def remove(data: bytes, parts: list[dict]) -> tuple[bytes, int]:
    """The bytes that no repeated string covers, and the number of removed runs."""
    delta = np.zeros(len(data) + 1, np.int32)
    for part in parts:
        first, starts, bits = part["first"], part["starts"], part["bits"]
        if bits is None:
            delta[first] += 1
            delta[first + starts + LENGTH - 1] -= 1
        else:
            at = first + np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8))[:starts])
            np.add.at(delta, at, 1)
            np.add.at(delta, at + LENGTH, -1)
    gone = np.cumsum(delta[:-1]) > 0
    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), spans


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, kept`` (the bytes that stay) and ``n_spans`` (removed runs)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash(text_of()).alias("row"),
                       text_of().cast("binary").alias("data"))
    marks = repeated_strings(rows).distinct().groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("first", "starts", "bits")).alias("parts"))  # of one document each
    marks = cut(marks.withColumnsRenamed({"doc_id": "mark_id", "row": "mark_row"}), "substring-marks")

    def strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [remove(data, parts) if parts is not None else (data, 0)
                    for data, parts in zip(batch["data"], batch["parts"], strict=True)]
            yield pd.DataFrame({"doc_id": batch["doc_id"].where(~batch["missing"], None).astype("Int64"),
                                "n_bytes": [len(data) for data in batch["data"]],
                                "kept": [kept for kept, _ in done], "n_spans": [spans for _, spans in done]})

    near = matching(rows, marks, "mark_id", "mark_row", "left")
    near = near.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("missing"),
                       "data", "parts").mapInPandas(strip, "doc_id long, n_bytes long, kept binary, n_spans long")
    far = rows.where(~picked(rows, marks, "mark_id", "mark_row")).select(
        "doc_id", F.octet_length("data").cast("long").alias("n_bytes"), F.col("data").alias("kept"),
        F.lit(0).cast("long").alias("n_spans"))
    return near.unionByName(far)


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_substrings(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256"))
