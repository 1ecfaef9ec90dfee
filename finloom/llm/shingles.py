"""Near copies of texts: the Jaccard similarity of their word shingles, candidates by min-hash bands.

1. Texts with one set of shingles are one row, so copies, however many, never meet in a join.
2. Of every set ``BANDS`` keys are made, each from the smallest hashes under ``ROWS`` mixings. Two sets of similarity J
   share no key with probability ``(1 - J ** ROWS) ** BANDS``: 3 in a million at 0.8, less above.
3. The sets under a key first meet one of them. Only those that this does not link meet the others, so near copies by
   the thousand cost one comparison each, and the components are those of all pairs.
4. Pairs that share a key are compared exactly, on shingles read again for those texts alone.

Defined cases: a text of fewer words than a shingle is one shingle; a text without words resembles only others of
its kind.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType

from finloom.llm.common import among, cut

SEED = 42
THRESHOLD = Fraction(4, 5)
BANDS, ROWS = 24, 4
PART = 1 << 14  # shingles mixed at a time
_DRAWN = np.random.RandomState(SEED).bytes(2 * 8 * BANDS * ROWS)
MIXES = np.frombuffer(_DRAWN, "<u8").astype(np.uint64).reshape(2, BANDS * ROWS, 1) | np.uint64(1)


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """The hash of every shingle in the order of the text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:].tolist(), strict=True)),
                       np.uint64, len(starts))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One key a band, as signed longs; none of an empty set."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(hashes), PART):
        mixed = (hashes[begin:begin + PART] ^ MIXES[0]) * MIXES[1]
        mixed ^= mixed >> np.uint64(32)
        mixed *= MIXES[1]
        np.minimum(least, mixed.min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)],
                    np.uint64).view(np.int64).tolist()


def set_column(text: Column, shingle: int, fingerprint: Callable[[np.ndarray], int] | None = None) -> Column:
    """The 128-bit name of the set of shingles, its size, its keys and, where asked for, a fingerprint of all shingles."""
    @F.pandas_udf("h1 long, h2 long, n int, bands array<long>, f long")
    def described(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            every = shingle_hashes(text, shingle)
            hashes = np.unique(every)
            h1, h2 = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), "<i8").tolist()
            f = int(np.uint64(fingerprint(every)).astype(np.int64)) if fingerprint else None
            rows.append((h1, h2, len(hashes), band_keys(hashes), f))
        return pd.DataFrame(rows, columns=["h1", "h2", "n", "bands", "f"]).astype({"f": "Int64"})

    return described(text)


def hashes_column(text: Column, shingle: int) -> Column:
    @F.pandas_udf(BinaryType())
    def packed(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(text, shingle)).tobytes() for text in texts], dtype=object)

    return packed(text)


def name_column(packed: Column) -> Column:
    @F.pandas_udf("h1 long, h2 long")
    def named(sets: pd.Series) -> pd.DataFrame:
        names = [np.frombuffer(xxhash.xxh3_128_digest(x), "<i8").tolist() for x in sets]
        return pd.DataFrame(names, columns=["h1", "h2"])

    return named(packed)


def alike(one: Column, other: Column, threshold: Fraction) -> Column:
    top, below = threshold.numerator, threshold.denominator

    @F.pandas_udf(BooleanType())
    def reaches(xs: pd.Series, ys: pd.Series) -> pd.Series:
        def holds(x: bytes, y: bytes) -> bool:
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            return both * below >= top * (len(a) + len(b) - both)
        return pd.Series([holds(x, y) for x, y in zip(xs, ys, strict=True)], dtype=bool)

    return reaches(one, other)


def linked(pairs: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, threshold: Fraction) -> DataFrame:
    """Those of the pairs (``a``, ``b``) whose similarity reaches the threshold."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = cut(classes.join(ids, "id", "left_semi").select("id", "rep", "h1", "h2"), "shingles-wanted")
    near = texts.where(among([texts["doc_id"]], wanted, ["rep"]))
    read = near.join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    read = cut(read.select("doc_id", hashes_column(F.col("text"), shingle).alias("x")), "shingles-read")
    named = read.select("doc_id", "x", name_column(F.col("x")).alias("s")).select("doc_id", "x", "s.*")
    coded = cut(named.join(wanted.withColumnRenamed("rep", "doc_id"), ["doc_id", "h1", "h2"])
                .dropDuplicates(["id"]).select("id", "x"), "shingles-coded")
    return cut(pairs.join(coded.select(F.col("id").alias("a"), "x"), "a")
               .join(coded.select(F.col("id").alias("b"), F.col("x").alias("y")), "b")
               .where(alike(F.col("x"), F.col("y"), threshold)).select("a", "b"), "shingles-linked")


def similar_sizes(threshold: Fraction, one: str, other: str) -> Column:
    top, below = threshold.numerator, threshold.denominator
    return F.expr(f"{one} * {below} >= {other} * {top} and {other} * {below} >= {one} * {top}")


def near_copies(docs: DataFrame, shingle: int = 5, threshold: Fraction = THRESHOLD,
                fingerprint: Callable[[np.ndarray], int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Of ``doc_id`` (long, not null) and ``text`` (not null): ``doc_id, rep, f`` by row, and the links ``a, b`` of reps.

    ``rep`` is the smallest ``doc_id`` with the same shingles, ``f`` the fingerprint, as a signed long. The components
    of the links are those of all pairs.
    """
    sets = cut(docs.select("doc_id", set_column(F.col("text"), shingle, fingerprint).alias("s")).select("doc_id", "s.*"),
               "shingles-sets")
    classes = cut(sets.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"),
                                               F.first("bands").alias("bands"))
                  .withColumn("id", F.monotonically_increasing_id()), "shingles-classes")
    keys = classes.select("id", "n", F.explode("bands").alias("key"))
    shared = (keys.groupBy("key").agg(F.min(F.struct("id", "n")).alias("pivot"), F.count("*").alias("members"))
              .where("members > 1").select("key", "pivot"))
    members = cut(keys.join(shared, "key").where(F.col("id") != F.col("pivot.id"))
                  .select("key", "id", "n", F.col("pivot.id").alias("pivot"), F.col("pivot.n").alias("pivot_n")),
                  "shingles-members")
    first = cut(members.where(similar_sizes(threshold, "n", "pivot_n"))
                .select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct(), "shingles-first")
    links = linked(first, classes, docs, shingle, threshold)

    apart = members.join(links.select(F.col("a").alias("pivot"), F.col("b").alias("id")), ["pivot", "id"], "left_anti")
    second = (apart.alias("u").join(members.alias("v"), F.expr("u.key = v.key and u.id <> v.id")
                                    & similar_sizes(threshold, "u.n", "v.n"))
              .select(F.least("u.id", "v.id").alias("a"), F.greatest("u.id", "v.id").alias("b")).distinct())
    second = cut(second.join(first, ["a", "b"], "left_anti"), "shingles-second")
    if not second.isEmpty():
        links = links.unionByName(linked(second, classes, docs, shingle, threshold))
    named = (links.join(classes.select(F.col("id").alias("a"), F.col("rep").alias("x")), "a")
             .join(classes.select(F.col("id").alias("b"), F.col("rep").alias("y")), "b")
             .select(F.col("x").alias("a"), F.col("y").alias("b")))
    return sets.join(classes.select("h1", "h2", "rep"), ["h1", "h2"]).select("doc_id", "rep", "f"), named
