"""Nearest neighbours by a block matrix join over int8 tiles.

Vectors are packed into blocks. A tile is one block of queries against a group of blocks of candidates; both sides
meet by an equi-join on the tile's number, and blocks have a fixed size, so no tile grows with the data. Inside a
tile, unit vectors are held as int8 with one scale and one error norm each. The product of two int8 blocks is exact,
and by the triangle inequality a cosine differs from it by at most ``e + f + e * f`` (the two error norms). Pairs
whose upper bound reaches a query's k-th best lower bound survive, get their cosine in double precision from the
original vectors, and are merged by heaps, within a tile and then over all tiles. Nothing is missed: recall is 1.

Defined cases: vectors that are null, empty, zero or hold a null or a non-finite number take no part; neither do
rows without an id. Only vectors of one length are compared. Rows with a query's id are its own and no candidates;
repeated ids count once, with their best score (as queries: with their smallest vector). Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finloom.llm.common import cut, table

QUERY_BLOCK, BLOCK, BLOCKS_PER_TILE = 8192, 4096, 2
STRIP = 1024  # candidates multiplied at once
PAIRS = 1 << 16  # pairs recomputed at once
BLOCK_SCHEMA = "dim int, block long, ids binary, vectors binary"


def usable(vector: Column) -> Column:
    """Finite throughout, and not zero."""
    return (F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(vector, lambda x: x != 0))


def packed(vectors: DataFrame, size: int) -> DataFrame:
    """Rows ``vec_id``, ``v`` as blocks of up to ``size`` vectors of one length."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, list] = {}
        n = 0

        def block(dim, rows):
            nonlocal n
            n += 1
            return pd.DataFrame({
                "dim": [dim], "block": [n], "ids": [np.array([i for i, _ in rows], np.int64).tobytes()],
                "vectors": [np.array([v for _, v in rows], np.float64).tobytes()]})

        for batch in batches:
            for vec_id, vector in zip(batch["vec_id"], batch["v"], strict=True):
                rows = waiting.setdefault(len(vector), [])
                rows.append((vec_id, vector))
                if len(rows) == size:
                    yield block(len(vector), waiting.pop(len(vector)))
        for dim, rows in waiting.items():
            yield block(dim, rows)

    return vectors.mapInPandas(pack, BLOCK_SCHEMA)


class Quantised:
    """A block: ids, original columns, unit vectors as int8 with scale and error norm."""

    def __init__(self, ids: bytes, vectors: bytes, dim: int):
        self.ids = np.frombuffer(ids, np.int64)
        rows = np.frombuffer(vectors, np.float64).reshape(-1, dim)
        # A power of two changes no digit of a cosine and keeps squares in range.
        rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])
        self.columns = np.ascontiguousarray(rows.T)
        square = np.zeros(len(rows))
        for column in self.columns:
            square += column * column
        self.norms = np.sqrt(square)
        unit = rows / self.norms[:, None]
        self.scales = np.abs(unit).max(axis=1) / 127
        self.codes = np.rint(unit / self.scales[:, None]).astype(np.int8)
        self.errors = np.sqrt(((unit - self.codes * self.scales[:, None]) ** 2).sum(axis=1)) + 1e-7


def cosines(one: Quantised, i: np.ndarray, other: Quantised, j: np.ndarray) -> np.ndarray:
    """Cosines of pairs in double precision, summed component by component."""
    out = np.empty(len(i))
    for begin in range(0, len(i), PAIRS):
        a, b = i[begin:begin + PAIRS], j[begin:begin + PAIRS]
        total = np.zeros(len(a))
        for x, y in zip(one.columns, other.columns, strict=True):
            total += x[a] * y[b]
        out[begin:begin + PAIRS] = total / (one.norms[a] * other.norms[b])
    return out


def best(rows: list[tuple[float, int]], k: int) -> list[tuple[float, int]]:
    """The k best of (negative score, id), an id once; smallest first."""
    out, seen = [], set()
    heapq.heapify(rows)
    while rows and len(out) < k:
        row = heapq.heappop(rows)
        if row[1] not in seen:
            seen.add(row[1])
            out.append(row)
    return out


def search(queries: Quantised, blocks: list[Quantised], dim: int, k: int) -> Iterator[tuple[int, int, float]]:
    kind = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64  # products of codes stay exact
    codes = queries.codes.astype(kind)
    found: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
    bar = np.full(len(queries.ids), -np.inf)
    for block in blocks:
        for begin in range(0, len(block.ids), STRIP):
            part = slice(begin, begin + STRIP)
            near = (codes @ block.codes[part].astype(kind).T).astype(np.float64)
            near *= queries.scales[:, None] * block.scales[None, part]
            slack = (1 + queries.errors[:, None]) * (1 + block.errors[None, part]) - 1
            near[queries.ids[:, None] == block.ids[None, part]] = -np.inf
            if len(set(block.ids[part].tolist())) == near.shape[1] >= k:  # each id once: k lower bounds are k ids
                lower = np.partition(near - slack, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
                bar = np.maximum(bar, lower)
            i, j = np.nonzero((near + slack >= bar[:, None]) & (near > -np.inf))
            j = j + begin
            scores = cosines(queries, i, block, j)
            cuts = np.searchsorted(i, np.arange(len(queries.ids) + 1))
            for q in np.unique(i).tolist():
                own = slice(cuts[q], cuts[q + 1])
                merged = list(zip((-scores[own]).tolist(), block.ids[j[own]].tolist(), strict=True)) + found[q]
                found[q] = best(merged, k)
                if len(found[q]) == k:
                    bar[q] = max(bar[q], -found[q][-1][0])
    for query, rows in zip(queries.ids.tolist(), found, strict=True):
        for score, vec_id in rows:
            yield query, vec_id, -score


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """The k nearest of ``vectors`` for every query (both ``vec_id``, ``v``): ``query_id, rank, vec_id, score``."""

    def clean(frame: DataFrame) -> DataFrame:
        v = F.col("v").cast("array<double>")
        return (frame.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
                .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & usable(F.col("v"))))

    asked = clean(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = cut(asked, "nearest-queries")
    query_blocks = cut(packed(asked.repartition(max(1, -(-asked.count() // QUERY_BLOCK))), QUERY_BLOCK),
                       "nearest-asked")
    blocks = cut(packed(clean(vectors), BLOCK).withColumn("block", F.monotonically_increasing_id()), "nearest-blocks")
    groups = max(1, -(-blocks.count() // BLOCKS_PER_TILE))
    numbered = query_blocks.withColumn("at", F.monotonically_increasing_id())
    asked_tiles = numbered.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    # Each block goes once to every query block of its dimension.
    tiles = (blocks.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
             .join(numbered.select("dim", "at"), "dim")
             .select(*[F.col(c).alias(f"tile_{c}") for c in ("dim", "at", "part")], "ids", "vectors"))

    def tile(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        dim = int(key[0])
        sides = [[Quantised(ids, vs, dim) for ids, vs in zip(f["ids"], f["vectors"], strict=True)]
                 for f in (left, right)]
        rows = [row for one in sides[0] for row in search(one, sides[1], dim, k)] if all(sides) else []
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = asked_tiles.groupBy("dim", "at", "part").cogroup(
        tiles.groupBy("tile_dim", "tile_at", "tile_part")).applyInPandas(
        tile, "query_id long, vec_id long, score double")
    # A query meets k rows of each tile; Spark keeps k of them before it shuffles.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("v"))
    return nearest(vectors.where("vec_id % 50 = 0"), vectors)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)
         / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
