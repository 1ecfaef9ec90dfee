"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL-proximal updates.

A text is read whole. Its words are runs of letters and digits, or runs of other signs; every word and every
pair of neighbours is hashed into ``BUCKETS`` weights. Two more n-gram features carry what hashing loses: a pair
of equal words, and a word in capitals. A feature's value is ``1 + ln(count)``, scaled to unit length per text,
so a score is one sparse dot product.

Training uses a bounded sample: at most ``max_examples`` labelled documents, those with the smallest hash of
their id, at every size of the corpus. Their features are built where the texts are; the updates, which depend
on each other, run in one task over that bounded sample, and ``BUCKETS`` weights (2 MB) come back.

Defined cases: a null or empty text holds the bias alone; a null label teaches nothing; several labels of one id
count as their majority (a tie as 1); of several documents with one id one is learnt; without any usable
label every score is 0.5; a null doc_id is scored and never held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.llm.common import table, text_of

BUCKETS = 1 << 18
BIAS, SAME, UPPER = 0, 1, 2  # the first weights are not hashed into
MAX_EXAMPLES = 20_000
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s]+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct feature indices of a text and their values; the bias comes first."""
    raw = WORD.findall(text.encode("utf-8", "surrogatepass"))
    if not raw:
        return np.array([BIAS], np.int32), np.ones(1)
    upper = sum(map(bytes.isupper, raw))
    words = np.fromiter(map(crc32, map(bytes.lower, raw)), np.uint64, len(raw))
    pairs = (words[:-1] * MIX) ^ (words[1:] + (words[:-1] << np.uint64(7)))
    hashed = np.concatenate([words * MIX, pairs * MIX]) >> np.uint64(64 - 18)
    index, counts = np.unique(hashed % np.uint64(BUCKETS - 3) + np.uint64(3), return_counts=True)
    same = int(np.count_nonzero(words[1:] == words[:-1]))
    extra = [(at, n) for at, n in ((SAME, same), (UPPER, upper)) if n]
    index = np.concatenate([np.array([at for at, _ in extra], np.int64), index.astype(np.int64)])
    values = 1 + np.log(np.concatenate([np.array([n for _, n in extra], float), counts.astype(float)]))
    values /= np.sqrt(values @ values)
    return np.concatenate([[BIAS], index]).astype(np.int32), np.concatenate([[1.0], values])


def probability(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


@dataclass
class Ftrl:
    """Follow the regularised leader with per-coordinate rates."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.01

    def fit(self, examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int) -> np.ndarray:
        z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for _ in range(epochs):
            for index, stored, label in examples:
                values = stored.astype(float)
                weights = self.weights(z[index], n[index])
                gradient = (probability(weights @ values) - label) * values
                grown = n[index] + gradient**2
                sigma = (np.sqrt(grown) - np.sqrt(n[index])) / self.alpha
                z[index] += gradient - sigma * weights
                n[index] = grown
        return self.weights(z, n)

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, max_examples: int) -> DataFrame:
    """At most ``max_examples`` learnable documents: ``rank``, ``text``, ``label``."""
    chosen = (labels.where("doc_id is not null and quality is not null")
              .select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
              .where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
              .withColumn("rank", F.xxhash64("doc_id"))
              .orderBy("rank", "doc_id").limit(max_examples))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # Bounded side: at most max_examples rows of three numbers.
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def train(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, epochs: int = 3) -> np.ndarray:
    """The weights learnt from a bounded sample of the rows that are not held out."""

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            built = [features(text) for text in batch["text"]]
            yield pd.DataFrame({"rank": batch["rank"], "label": batch["label"],
                                "at": [index.tobytes() for index, _ in built],
                                "value": [values.astype(np.float32).tobytes() for _, values in built]})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        examples = [(np.frombuffer(at, np.int32), np.frombuffer(value, np.float32), label)  # views of the bytes
                    for batch in batches
                    for at, value, label in zip(batch["at"], batch["value"], batch["label"], strict=True)]
        weights = Ftrl().fit(examples, epochs)
        kept = np.flatnonzero(weights)
        yield pd.DataFrame({"at": kept, "weight": weights[kept]})

    built = sample(docs, labels, max_examples).select("rank", "text", "label").mapInPandas(
        extract, "rank long, label int, at binary, value binary")
    learnt = built.repartition(1).sortWithinPartitions("rank").mapInPandas(learn, "at long, weight double")
    weights = np.zeros(BUCKETS)
    for row in learnt.collect():  # at most BUCKETS numbers
        weights[row["at"]] = row["weight"]
    return weights


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", name: str = "score") -> DataFrame:
    """The documents with one more column, the probability of good quality."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        known = shared.value
        out = np.empty(len(texts))
        for at, (index, values) in enumerate(map(features, texts)):
            out[at] = probability(known[index] @ values)
        return pd.Series(out)

    return docs.withColumn(name, scored(text_of(text)))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = train(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), weights).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
