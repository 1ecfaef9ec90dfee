"""Jaccard join of documents by their word shingles: prefix filtering, rarest shingles first.

1. Every text becomes the set of its shingles' hashes. Texts with one set (128-bit name) are one row from here on, so
   copies, however many, never meet in a join. The same pass counts shingles in ``BUCKETS`` hash buckets; a task hands
   on only the buckets it has seen.
2. A shingle's rank is the level of its bucket's count, then its hash: an order common to all sets, rare before common.
   It decides only how many candidates there are, never which pairs link.
3. Sets of similarity ``t`` share one of their first ``n - ceil(t n) + 1`` shingles (prefix filter). These meet in one
   shuffle by shingle, where each first meets the set that has the shingle furthest in front, the pivot: an unedited
   text comes before its edited copies. Sets alone under a shingle are gone here.
4. A pair stays while sizes (length filter), the places of the common shingle (positional filter) and the sets' counts
   in ``PARTS`` parts of the hash range allow the similarity. The last is the suffix filter with its parts fixed
   beforehand: the sizes' differences, summed over the parts, bound the symmetric difference from below.
5. Each pair that is left is verified once, on shingles read again for its two texts.
6. Under a shingle whose sets lie in different components after that, sets of different components meet as well (steps 4
   and 5). Links inside a component can't change it, so a group of thousands of near copies costs one comparison each.

A shingle in the prefix of very many sets is a run of rows that one task passes through in order, holding none; such
shingles come by the dozen in a group of near copies, so its rows spread over as many tasks.

Defined cases: a text of fewer words than a shingle is one shingle; a null text or one without words has an empty set and
links with nothing; rows with one ``doc_id`` are documents of their own; rows whose ``doc_id`` is null take no part and
have a null component; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finloom.llm.common import components, cut, table, text_of
from finloom.llm.shingles import linked, shingle_hashes, similar_sizes

THRESHOLD = Fraction(4, 5)
SHINGLE = 5
BUCKETS, BLOCK = 1 << 22, 1 << 16
PARTS = 32
SLOTS = 32  # partial sums of a block of buckets before its total


def sets_of(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    for text in texts.to_pylist():
        yield np.unique(shingle_hashes(text, shingle))


def name_of(hashes: np.ndarray) -> list[int]:
    return np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), "<i8").tolist()


def described(docs: DataFrame, shingle: int) -> DataFrame:
    """One row per document (``doc_id, h1, h2, n``) and each task's bucket counts (``block, at, counts``)."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, empty = np.zeros(BUCKETS, np.uint32), pa.nulls
        for batch in batches:
            rows = []
            for hashes in sets_of(batch["text"], shingle):
                rows.append((*name_of(hashes), len(hashes)))
                np.add.at(seen, hashes >> np.uint64(64 - 22), 1)
            h1, h2, n = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(n, pa.int32()), empty(len(rows), pa.int32()), empty(len(rows), pa.binary()),
                 empty(len(rows), pa.binary())], ["doc_id", "h1", "h2", "n", "block", "at", "counts"])
        for block, at, counts in sparse(seen):
            yield pa.RecordBatch.from_arrays(
                [empty(1, pa.int64()), empty(1, pa.int64()), empty(1, pa.int64()), empty(1, pa.int32()),
                 pa.array([block], pa.int32()), pa.array([at], pa.binary()), pa.array([counts], pa.binary())],
                ["doc_id", "h1", "h2", "n", "block", "at", "counts"])

    return docs.select("doc_id", "text").mapInArrow(
        look, "doc_id long, h1 long, h2 long, n int, block int, at binary, counts binary")


def sparse(counts: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """The blocks that hold a count: number, places in the block (16 bit) and counts there."""
    for block in range(len(counts) // BLOCK):
        part = counts[block * BLOCK:(block + 1) * BLOCK]
        at = np.flatnonzero(part)
        if len(at):
            yield block, at.astype("<u2").tobytes(), part[at].astype("<u4").tobytes()


def summed(counts: DataFrame, *keys: str) -> DataFrame:
    """Counts of one key (its last column ``block``) added, one key at a time and row by row."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, total = None, np.zeros(BLOCK, np.uint64)

        def done() -> pd.DataFrame:
            at = np.flatnonzero(total)
            most = np.minimum(total[at], np.iinfo(np.uint32).max)
            return pd.DataFrame({"block": [key[-1]], "at": [at.astype("<u2").tobytes()],
                                 "counts": [most.astype("<u4").tobytes()]})

        for batch in batches:
            for *own, at, values in zip(*(batch[k] for k in keys), batch["at"], batch["counts"], strict=True):
                if own != key:
                    if key is not None:
                        yield done()
                    key, total = own, np.zeros(BLOCK, np.uint64)
                total[np.frombuffer(at, "<u2")] += np.frombuffer(values, "<u4")
        if key is not None:
            yield done()

    return counts.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(
        add, "block int, at binary, counts binary")


def levels_of(looked: DataFrame) -> np.ndarray:
    """The level of every bucket: four to a doubling of its count, one byte each."""
    counts = looked.where("block is not null").select(
        "block", "at", "counts", F.pmod(F.xxhash64("at"), F.lit(SLOTS)).alias("slot"))
    levels = np.zeros(BUCKETS, np.uint8)
    for row in summed(summed(counts, "slot", "block"), "block").toLocalIterator():  # 64 rows of fixed size
        at = np.frombuffer(row["at"], "<u2").astype(np.int64) + row["block"] * BLOCK
        levels[at] = np.minimum(255, 4 * np.log2(np.frombuffer(row["counts"], "<u4") + 1.0)).astype(np.uint8)
    return levels


def prefix_size(n: int, threshold: Fraction) -> int:
    return n - -(-threshold.numerator * n // threshold.denominator) + 1


def prefixes(docs: DataFrame, shared, shingle: int, threshold: Fraction) -> DataFrame:
    """Per different set that is not empty: ``h1, h2, n``, ``prefix`` (rarest first) and ``parts`` (counts)."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, known = shared.value, set()
        for batch in batches:
            rows, flat = [], []
            for hashes in sets_of(batch["text"], shingle):
                name = tuple(name_of(hashes))
                if not len(hashes) or name in known:
                    continue
                known.add(name)
                ranks = (levels[hashes >> np.uint64(64 - 22)].astype(np.uint64) << np.uint64(56)) | (
                    hashes >> np.uint64(8))
                size = prefix_size(len(hashes), threshold)
                flat.append(hashes[np.argsort(ranks, kind="stable")[:size]].view(np.int64))
                rows.append((*name, len(hashes), size, np.bincount(hashes & np.uint64(PARTS - 1), minlength=PARTS)))
            if not rows:
                continue
            h1, h2, n, sizes, parts = zip(*rows, strict=True)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            places = (np.arange(len(rows) + 1) * PARTS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(n, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat))),
                 pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate(parts).astype(np.int32)))],
                ["h1", "h2", "n", "prefix", "parts"])

    return docs.select("text").mapInArrow(look, "h1 long, h2 long, n int, prefix array<long>, parts array<int>")


def needed(threshold: Fraction, one: str, other: str) -> str:
    """The common shingles that the similarity asks of sets of these sizes."""
    top, below = threshold.numerator, threshold.numerator + threshold.denominator
    return f"(({top} * (cast({one} as long) + {other}) + {below - 1}) div {below})"


def fits(threshold: Fraction, n: str, pos: str, other_n: str, other_pos: str) -> Column:
    """Length and positional filter. At a pair's first common shingle nothing before it is common."""
    return similar_sizes(threshold, n, other_n) & F.expr(
        f"least({n} - {pos}, {other_n} - {other_pos}) >= {needed(threshold, n, other_n)}")


def suffix_filtered(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """Those pairs (``a``, ``b``) whose counts by part allow the similarity."""
    apart = F.expr("aggregate(zip_with(x, y, (u, v) -> abs(u - v)), 0L, (s, d) -> s + d)")
    ends = [sets.select(F.col("id").alias(end), F.col("n").alias(f"n_{end}"), F.col("parts").alias(parts))
            for end, parts in (("a", "x"), ("b", "y"))]
    return pairs.join(ends[0], "a").join(ends[1], "b").where(
        apart <= F.expr(f"n_a + n_b - 2 * {needed(threshold, 'n_a', 'n_b')}")).select("a", "b")


def members_of(sets: DataFrame) -> DataFrame:
    """The sets that share a prefix shingle with another, each beside the shingle's pivot (``p``)."""
    postings = sets.select("id", "n", F.posexplode("prefix").alias("pos", "token"))
    front = Window.partitionBy("token").orderBy("pos", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (postings.withColumn("p", F.first(F.struct("id", "n", "pos")).over(front))
            .where(F.col("id") != F.col("p.id")).select("token", "id", "n", "pos", "p"))


def with_component(frame: DataFrame, roots: DataFrame, key: Column, name: str) -> DataFrame:
    own = roots.select(F.col("node").alias("own_node"), F.col("root").alias("own_root"))
    return frame.join(own, key == F.col("own_node"), "left").withColumn(
        name, F.coalesce("own_root", key)).drop("own_node", "own_root")


def between_components(members: DataFrame, links: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs that share a shingle but lie in different components of the links; pivots are not among them."""
    roots = cut(components(links), "join-roots")
    placed = with_component(with_component(members, roots, F.col("id"), "c"), roots, F.col("p.id"), "pivot_c")
    mixed = cut(placed.where("c <> pivot_c").select("token", "id", "n", "pos", "c", "pivot_c"), "join-mixed")
    tokens = mixed.select("token").distinct()
    others = cut(placed.join(tokens, "token", "left_semi").select("token", "id", "n", "pos", "c", "pivot_c"),
                 "join-others")
    # Where both stand apart from the pivot either finds the pair; one is enough.
    once = F.expr("u.token = v.token and u.c <> v.c and (v.c = v.pivot_c or u.id < v.id)")
    return (mixed.alias("u").join(others.alias("v"), once & fits(threshold, "u.n", "u.pos", "v.n", "v.pos"))
            .select(F.least("u.id", "v.id").alias("a"), F.greatest("u.id", "v.id").alias("b")).distinct())


def jaccard_links(docs: DataFrame, shingle: int = SHINGLE, threshold: Fraction = THRESHOLD
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``doc_id`` (long, not null) and ``text`` (not null): rows, classes and links.

    Rows are ``doc_id, h1, h2, n``; classes ``id, rep, h1, h2, n`` for every set that is not empty; the links ``a, b``
    of class ids reach the threshold, and their components are those of all pairs that do.
    """
    spark = docs.sparkSession
    looked = cut(described(docs, shingle), "join-looked")
    rows = looked.where("block is null").select("doc_id", "h1", "h2", "n")
    shared = spark.sparkContext.broadcast(levels_of(looked))  # BUCKETS bytes
    sets = cut(prefixes(docs, shared, shingle, threshold).groupBy("h1", "h2").agg(
        *(F.first(name).alias(name) for name in ("n", "prefix", "parts")))
        .withColumn("id", F.monotonically_increasing_id()), "join-sets")
    reps = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"))
    classes = cut(sets.select("id", "h1", "h2", "n").join(reps, ["h1", "h2"]), "join-classes")

    members = cut(members_of(sets), "join-members")
    star = (members.where(fits(threshold, "n", "pos", "p.n", "p.pos"))
            .select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b")).distinct())
    star = cut(suffix_filtered(star, sets, threshold), "join-star")
    links = linked(star, classes, docs, shingle, threshold)
    rest = between_components(members, links, threshold).join(star, ["a", "b"], "left_anti")
    rest = cut(suffix_filtered(rest, sets, threshold), "join-rest")
    if not rest.isEmpty():
        links = links.unionByName(linked(rest, classes, docs, shingle, threshold))
    return rows, classes, links


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, threshold: Fraction = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id`` (smallest linked doc_id)."""
    key = F.col("doc_id").cast("long")
    plain = docs.select(key.alias("doc_id"), text_of().alias("text"))
    rows, classes, links = jaccard_links(plain.where("doc_id is not null"), shingle, threshold)
    placed = with_component(classes.select("id", "h1", "h2", "rep"), components(links), F.col("id"), "root")
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_class = placed.join(least, "root").select("h1", "h2", "component_id")
    known = rows.join(of_class, ["h1", "h2"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    lost = described(plain.where("doc_id is null"), shingle).where("block is null").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return known.unionByName(lost)


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


# Prefixes by the shingles' own order, no counts and no hashes: the same links.
OP12_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
said AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3),
                                                             lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
  FROM worded),
sets AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM said WHERE len(s) > 0 GROUP BY s),
prefixes AS (SELECT rep, n, unnest(s[1:(n - (4 * n + 4) // 5 + 1)]) AS w FROM sets),
pairs AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM prefixes a JOIN prefixes b
          ON a.w = b.w AND a.rep < b.rep AND a.n * 5 >= b.n * 4 AND b.n * 5 >= a.n * 4),
linked AS (SELECT a, b FROM pairs JOIN sets x ON x.rep = a JOIN sets y ON y.rep = b
           WHERE 9 * len(list_intersect(x.s, y.s)) >= 4 * (x.n + y.n)),
both_ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reached AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reached r JOIN both_ways l ON l.a = r.b),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(least(l.b, x.rep), x.rep, d.doc_id) AS component_id
FROM said d LEFT JOIN sets x ON x.s = d.s LEFT JOIN least l ON l.a = x.rep
"""
