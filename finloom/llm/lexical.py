"""Ranked lexical search, reversed: the queries are indexed and the documents stream past them.

1. The terms of the items make an inverted index: for each term the items that hold it. It is broadcast, in blocks of
   items of at most ``BLOCK_TERMS`` (item, term) entries, so the size of a broadcast has a bound whatever the number of
   items; every block sees all documents.
2. One pass over the documents counts what the weights need: documents with a term, all terms, and for the indexed terms
   the documents that hold them. Each task adds its counts before they are shuffled.
3. The second pass counts each document's indexed terms, adds up the scores of all items that share one, and keeps the
   best ``k`` documents of every item in a heap. A task so holds ``k`` entries an item, however many documents it reads.
4. The tasks' heaps are merged by item; Spark again keeps no more than ``k`` of them in each task before the shuffle.

Scores are whole numbers: a weight is ``floor(1000 * ln((2 N + 2) / (2 df + 1)))``, all else 64-bit integers.

Defined cases: a null or empty text has no terms and counts nowhere; a document without a ``doc_id`` counts in all
statistics but is not ranked; rows with one ``doc_id`` are documents of their own; item rows with one ``item_id`` are one
item with the terms of all of them; items without an id, without text or without a match have no rows; other columns
are not read; without documents or items the result is empty.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finloom.llm.common import cut, table

K = 10
BLOCK_TERMS = 1 << 18  # (item, term) entries of one broadcast index
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
RANKED = "item_id long, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text in its order: bytes, so that only A-Z are lower-cased."""
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


class Index:
    """The inverted index over a block of items: the rows of each term's items, end to end."""

    def __init__(self, items: dict[int, set[bytes]]):
        self.items = sorted(items)
        rows: dict[bytes, list[int]] = {}
        for row, item in enumerate(self.items):
            for term in items[item]:
                rows.setdefault(term, []).append(row)
        self.terms = sorted(rows)
        self.number = {term: i for i, term in enumerate(self.terms)}
        self.rows = [np.array(rows[term], np.int64) for term in self.terms]

    def counts(self, terms: list[bytes]) -> Counter:
        """How often each indexed term occurs, by number."""
        return Counter(map(self.number.__getitem__, filter(self.number.__contains__, terms)))


def blocks_of(items: DataFrame) -> Iterator[Index]:
    """Indexes over all items, each of at most ``BLOCK_TERMS`` entries unless one item alone has more."""
    known = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    block: dict[int, set[bytes]] = {}
    size = 0
    # Rows come one partition at a time and in order of their id, so those of an item follow each other.
    for row in known.sort("item_id").toLocalIterator():
        if size >= BLOCK_TERMS and row["item_id"] not in block:
            yield Index(block)
            block, size = {}, 0
        terms = block.setdefault(row["item_id"], set())
        size -= len(terms)
        terms.update(terms_of(row["text"]))
        size += len(terms)
    if block:
        yield Index(block)


def statistics(docs: DataFrame, shared) -> DataFrame:
    """Rows ``term, n``: the documents that hold each indexed term; under -1 the documents, under -2 all terms."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, found = shared.value, Counter()
        for batch in batches:
            for text in batch["text"]:
                terms = terms_of(text)
                if terms:
                    found[-1] += 1
                    found[-2] += len(terms)
                    found.update(index.counts(terms).keys())
        yield pd.DataFrame({"term": list(found.keys()), "n": list(found.values())}, dtype="int64")

    return docs.select("text").mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))


def best_of(docs: DataFrame, shared, totals: dict[int, int], k: int) -> DataFrame:
    """Of every task the best ``k`` documents of each item: ``item_id, doc_id, score``."""
    n_docs, n_terms = totals[-1], totals[-2]

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * totals.get(i, 0) + 1)))
                   for i in range(len(index.terms))]
        heaps: list[list[tuple[int, int]]] = [[] for _ in index.items]  # (score, -doc_id), the worst first
        least = np.zeros(len(index.items), np.int64)  # the worst score of a full heap
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"], strict=True):
                terms = terms_of(text)
                counts = index.counts(terms)
                if not counts:
                    continue
                m = 100 - 90 + (90 * len(terms) * n_docs) // n_terms
                parts = [weights[t] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m)) for t, tf in counts.items()]
                scores = np.zeros(len(index.items), np.int64)
                rows = [index.rows[t] for t in counts]
                np.add.at(scores, np.concatenate(rows), np.repeat(parts, [len(r) for r in rows]))
                # A tie may still win by its doc_id; a full heap's worst is above zero.
                for row in np.flatnonzero((scores >= least) & (scores > 0)).tolist():
                    heap, entry = heaps[row], (int(scores[row]), -doc_id)
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == k:
                        least[row] = heap[0][0]
        yield pd.DataFrame([(item, -d, s) for item, heap in zip(index.items, heaps, strict=True) for s, d in heap],
                           columns=["item_id", "doc_id", "score"], dtype="int64")

    return (docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInPandas(rank, RANKED))


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """The best ``k`` documents of each item: ``item_id, rank, doc_id, score``, equal scores by ``doc_id``."""
    spark = docs.sparkSession
    found = []
    for index in blocks_of(items):
        shared = spark.sparkContext.broadcast(index)
        totals = {row["term"]: row["n"] for row in statistics(docs, shared).collect()}  # one row an indexed term
        if -1 in totals:
            found.append(cut(best_of(docs, shared, totals, k), "search"))
    merged = spark.createDataFrame([], RANKED)
    for part in found:
        merged = merged.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


def op13_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sized AS (SELECT doc_id, terms, len(terms) AS n FROM words WHERE len(terms) > 0),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sized),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
said AS (SELECT doc_id, n, unnest(terms) AS term FROM sized),
counted AS (SELECT doc_id, n, term, count(*) AS tf FROM said WHERE term IN (SELECT term FROM wanted)
            GROUP BY doc_id, n, term),
held AS (SELECT term, count(*) AS df FROM counted GROUP BY term),
weighted AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM held, whole),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // whole.terms))))
           ::BIGINT AS score
  FROM counted JOIN weighted USING (term) JOIN wanted USING (term), whole GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, doc_id, score,
                  row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
           FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
