"""Near-duplicate documents by SimHash, candidates pruned by the pigeonring principle.

The 64 bits of a fingerprint are cut into a ring of ``SEGMENTS`` segments. If two fingerprints
differ in at most ``bits`` bits, some segment starts a chain around the ring whose every prefix of
``l`` segments differs in at most ``l * bits / SEGMENTS`` bits. The first two links of such a chain
are the join key (the first segment is equal, the second differs in at most one bit), the remaining
prefixes are checked on what the join finds, and only survivors reach the full Hamming check.

Everything works on distinct fingerprints: equal documents, however many, are one row before the join.
A key that many distinct fingerprints share is not joined as it is. Its third segment is added to the
key, with every change the budget still allows, so its members meet only those that fit three links.

Defined cases: a null or empty text has fingerprint zero, which links like any other; rows with equal
``doc_id`` are kept as they are and share a component; rows whose ``doc_id`` is null take no part and have
a null component. Columns beside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from finloom.llm.common import components, cut, fresh, table, text_of, without
from finloom.llm.shingles import near_copies, shingle_hashes

SEGMENTS, WIDTH = 4, 16
BITS = 3
HOT_KEY = 64  # distinct fingerprints under one two-segment key, above which the third segment joins the key
LANES = np.uint64(0x0101010101010101)


def fingerprint(hashes: np.ndarray) -> int:
    """Of the hashes of all shingles of a text, repeats included."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), 255 * 4096):  # a lane of a byte holds 255 ones
        part = hashes[begin:begin + 255 * 4096]
        cuts = np.arange(0, len(part), 255)
        for bit in range(8):
            lanes = np.add.reduceat((part >> np.uint64(bit)) & LANES, cuts)
            counts[bit::8] += lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprint_column(text: Column, shingle: int) -> Column:
    @F.pandas_udf(LongType())
    def signed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(shingle_hashes(t, shingle)) for t in texts], np.uint64).view(np.int64))

    return signed(text)


def segment(value: Column, at: int) -> Column:
    return F.shiftrightunsigned(value, WIDTH * (at % SEGMENTS)).bitwiseAND((1 << WIDTH) - 1)


def long_mask(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def masks(at: int, changed: int) -> list[int]:
    """Masks that change so many bits of a segment."""
    base = WIDTH * (at % SEGMENTS)
    return [long_mask(sum(1 << (base + bit) for bit in bits)) for bits in combinations(range(WIDTH), changed)]


def ring_key(value: Column, start: int, links: int) -> Column:
    """Ring start and the next segments packed into one long (two links) or two longs (three)."""
    two = (F.lit(start).cast("long") * (1 << 32)) + segment(value, start) * (1 << WIDTH) + segment(value, start + 1)
    return two if links == 2 else two * (1 << WIDTH) + segment(value, start + 2)


def differing(one: Column, other: Column) -> Column:
    return F.bit_count(one.bitwiseXOR(other))


def chain_holds(one: Column, other: Column, start: int) -> Column:
    """Every prefix of the chain from ``start`` is within its share of the budget."""
    total, holds = F.lit(0), F.lit(True)
    for length in range(1, SEGMENTS + 1):
        total = total + F.bit_count(segment(one.bitwiseXOR(other), start + length - 1))
        holds = holds & (total <= length * BITS // SEGMENTS)
    return holds


def near_pairs(prints: DataFrame) -> DataFrame:
    """Pairs of distinct fingerprints with at most ``BITS`` differing bits: columns ``a``, ``b``.

    ``prints`` holds distinct longs in ``f``.
    """
    f = F.col("f")
    base = prints.select("f", F.explode(F.array(*[
        F.struct(F.lit(s).alias("start"), ring_key(f, s, 2).alias("key")) for s in range(SEGMENTS)])).alias("k")
    ).select("f", "k.start", "k.key")
    keys = base.groupBy("key").agg(F.count("*").alias("n")).where("n > 1 or n is null")
    hot = cut(keys.where(F.col("n") > HOT_KEY).select(F.col("key").alias("hot_key")), "simhash-hot")

    # A pair that differs by one bit in the second segment is found from the side whose bit is zero.
    flips = F.array(*[F.struct(F.lit(s).alias("start"), F.lit(m).cast("long").alias("mask"))
                      for s in range(SEGMENTS) for m in [0, *masks(s + 1, 1)]])
    probes = (prints.select("f", F.explode(flips).alias("p"))
              .where(f.bitwiseAND(F.col("p.mask")) == 0)
              .select(F.col("f").alias("probe"), F.col("p.start").alias("start"), F.col("p.mask").alias("mask"),
                      f.bitwiseXOR(F.col("p.mask")).alias("seen")))
    key = F.coalesce(*[F.when(F.col("start") == s, ring_key(F.col("seen"), s, 2)) for s in range(SEGMENTS)])
    probes = probes.select("probe", "start", "mask", "seen", key.alias("key"))

    hot_side = hot.withColumnRenamed("hot_key", "key")
    cool = probes.join(hot_side, "key", "left_anti").join(base.join(hot_side, "key", "left_anti"), ["key", "start"])
    cool = cool.where((F.col("mask") != 0) | (F.col("probe") < F.col("f")))

    three = F.coalesce(*[F.when(F.col("start") == s, ring_key(F.col("seen"), s, 3)) for s in range(SEGMENTS)])
    third = F.coalesce(*[F.when(F.col("start") == s, F.array(*[F.lit(m).cast("long") for c in (0, 1, 2)
                                                              for m in masks(s + 2, c)])) for s in range(SEGMENTS)])
    allowed = F.when(F.col("mask") == 0, F.col("third")).otherwise(F.slice("third", 1, 1 + WIDTH))
    refined_probe = (probes.join(hot_side, "key", "left_semi").withColumn("third", third)
                     .select("probe", "start", "mask", "seen", F.explode(allowed).alias("more"))
                     .withColumn("seen", F.col("seen").bitwiseXOR(F.col("more")))
                     .select("probe", "start", "mask", "more", three.alias("key3")))
    refined_base = (base.join(hot_side, "key", "left_semi").withColumn("seen", F.col("f"))
                    .select("f", "start", three.alias("key3")))
    # With the second segment equal, both sides find the pair; one is enough.
    heated = (refined_probe.join(refined_base, ["key3", "start"])
              .where((F.col("mask") != 0) | (F.col("probe") < F.col("f"))))

    found = cool.select("probe", "f", "start").unionByName(heated.select("probe", "f", "start"))
    holds = F.coalesce(*[F.when(F.col("start") == s, chain_holds(F.col("probe"), F.col("f"), s))
                         for s in range(SEGMENTS)])
    return (found.where(holds).where(differing(F.col("probe"), F.col("f")) <= BITS)
            .select(F.least("probe", "f").alias("a"), F.greatest("probe", "f").alias("b")).distinct())


def print_links(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``doc_id`` (long, not null) and ``f``: ``f, rep`` by fingerprint, and the links ``a, b`` of reps.

    A fingerprint is known by the smallest document that has it. ``prints`` must be written.
    """
    classes = cut(prints.groupBy("f").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    pairs = cut(near_pairs(classes.select("f")), "simhash-pairs")
    return classes, (pairs.join(classes.select(F.col("f").alias("a"), F.col("rep").alias("x")), "a")
                     .join(classes.select(F.col("f").alias("b"), F.col("rep").alias("y")), "b")
                     .select(F.col("x").alias("a"), F.col("y").alias("b")))


def near_duplicates(docs: DataFrame, shingle: int = 5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (hex), ``component_id`` (smallest linked doc_id)."""
    prints = cut(docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                             fingerprint_column(text_of(text), shingle).alias("f")), "simhash-prints")
    classes, links = print_links(prints.where("doc_id is not null"))
    roots = components(links)
    of_class = (classes.join(roots, F.col("rep") == F.col("node"), "left")
                .select("f", F.coalesce("root", "rep").alias("component_id")))
    # Equal texts may be a third of all rows: the class table is the small side, AQE splits its hot key.
    return (prints.join(of_class, "f", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def keep_first(docs: DataFrame, shingle: int = 5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without the near copies of an earlier one; all columns stay as they are.

    Texts are near copies where their fingerprints link, as in ``near_duplicates``, and from a Jaccard similarity of 0.8
    of their shingles on, since a few bits can't tell those of edited copies: the components are those of both links.
    Of rows with one ``doc_id`` all stay or go; documents without an id stay.
    """
    own = fresh(docs, "gone")
    known = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"),
                                                         text_of(text).alias("text"))
    of_class, links = near_copies(known, shingle, fingerprint=fingerprint)
    of_class = cut(of_class, "near-classes")
    by_print, print_pairs = print_links(of_class.select(F.col("rep").alias("doc_id"), "f"))
    same_print = of_class.join(by_print.withColumnRenamed("rep", "first"), "f").select(
        F.col("rep").alias("a"), F.col("first").alias("b"))
    roots = components(links.unionByName(print_pairs).unionByName(same_print))
    gone = (of_class.join(roots, F.col("rep") == F.col("node"), "left")
            .where(F.coalesce("root", "rep") != F.col("doc_id")).select(F.col("doc_id").alias(own)).distinct())
    return without(docs, [docs[doc_id].cast("long")], cut(gone, "near-gone"), [own])


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3)
