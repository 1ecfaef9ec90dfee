"""Packing: optimal length buckets, and token-budget batches inside each bucket.

Every document is padded to the boundary of its bucket. The boundaries come from dynamic programming over the
histogram of all lengths: with costs ``L_j * (C_j - C_i) - (S_j - S_i)`` (boundary, counts and tokens up to an index)
the best last cut of every prefix is the lowest of straight lines, so each layer is linear in the number of distinct
lengths and exact in integers. That histogram is the only thing the driver sees. It has at most ``sqrt(2 * tokens)``
rows, since distinct lengths add up to no more than all tokens.

A document's place in its bucket follows its length, then its id. The histogram gives the place where a length begins;
within a length, counts per span of ``CELL`` ids are summed, and rows are numbered inside one span. So no task
orders a bucket or a frequent length as a whole.

Defined cases: a null or empty text has length zero; a document longer than the budget is a batch of its own; rows
with one id follow each other in no fixed order; a null id comes first; of equally good cuts the smaller boundaries
win; an empty table gives no rows. With fewer distinct lengths than buckets each length is a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finloom.llm.common import cut, table, text_of

BUCKETS = 16
TOKEN_BUDGET = 32_768
CELL = 1 << 16


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, r"[\x09-\x0D ]+"), ""))


def layer(before: list[int], lengths: list[int], counts: list[int], tokens: list[int], first: int) -> list[int]:
    """Least padding of each prefix with one bucket more; ``before[i]`` is that of the first ``i`` lengths.

    Prefix ``j`` takes the minimum over ``first <= i < j`` of ``before[i] + tokens[i] - lengths[j] * counts[i]``.
    Slopes fall and lengths grow, so one sweep keeps the lower hull.
    """
    hull: list[tuple[int, int]] = []  # (slope, height)
    at, out = 0, [0] * len(before)
    for j in range(first + 1, len(before)):
        slope, height = -counts[j - 1], before[j - 1] + tokens[j - 1]
        while len(hull) - at >= 2:
            (m1, b1), (m2, b2) = hull[-2:]
            if (height - b1) * (m1 - m2) > (b2 - b1) * (m1 - slope):
                break
            hull.pop()
        hull.append((slope, height))
        x = lengths[j - 1]
        while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
            at += 1
        out[j] = hull[at][0] * x + hull[at][1] + x * counts[j] - tokens[j]
    return out


def boundaries(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """The upper lengths of the buckets that need the least padding, in ascending order."""
    lengths = [length for length, _ in histogram]
    counts, tokens = [0], [0]
    for length, n in histogram:
        counts.append(counts[-1] + n)
        tokens.append(tokens[-1] + n * length)
    size, used = len(lengths), min(buckets, len(lengths))
    one = [0] + [lengths[j - 1] * counts[j] - tokens[j] for j in range(1, size + 1)]
    layers = [[], one]
    for k in range(2, used + 1):
        layers.append(layer(layers[-1], lengths, counts, tokens, k - 1))
    cuts, j = [], size
    for k in range(used, 0, -1):
        cuts.append(lengths[j - 1])
        if k > 1:
            j = next(i for i in range(k - 1, j) if layers[k][j] == layers[k - 1][i]
                     + lengths[j - 1] * (counts[j] - counts[i]) - (tokens[j] - tokens[i]))
    return cuts[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, length: Column | None = None,
         doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, n_tokens, bucket, pad_to, batch`` (within its bucket) and ``slot``.

    ``length`` is the number of tokens of a row; without it, words of ``text`` count.
    """
    spark = docs.sparkSession
    sized = cut(docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                            (word_count(text_of()) if length is None else length).cast("int").alias("n_tokens"))
                .withColumn("cell", F.shiftright("doc_id", CELL.bit_length() - 1)), "packing")
    histogram = [(r["n_tokens"], r["n"]) for r in
                 sized.groupBy("n_tokens").agg(F.count("*").alias("n")).orderBy("n_tokens").collect()]
    uppers = boundaries(histogram, buckets)
    plan, bucket, start = [], 0, 0
    for value, n in histogram:
        if value > uppers[bucket]:
            bucket, start = bucket + 1, 0
        plan.append((value, bucket, uppers[bucket], start))
        start += n
    plan = spark.createDataFrame(plan, "n_tokens int, bucket int, pad_to int, start long")

    spans = (sized.groupBy("n_tokens", "cell").agg(F.count("*").alias("n"))
             .withColumn("ahead", F.sum("n").over(Window.partitionBy("n_tokens").orderBy("cell")) - F.col("n"))
             .select(F.col("n_tokens").alias("span_tokens"), F.col("cell").alias("span"), "ahead"))
    numbered = sized.withColumn("nth", F.row_number().over(
        Window.partitionBy("n_tokens", "cell").orderBy("doc_id")) - 1)
    placed = numbered.join(spans, (F.col("n_tokens") == F.col("span_tokens")) & F.col("cell").eqNullSafe(F.col("span")))
    place = F.col("start") + F.col("ahead") + F.col("nth")
    capacity = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("pad_to"), F.lit(1)))).cast("long")
    return (placed.join(plan, "n_tokens").withColumn("place", place).withColumn("capacity", capacity)
            .select("doc_id", "n_tokens", "bucket", "pad_to", F.expr("place div capacity").alias("batch"),
                    (F.col("place") % F.col("capacity")).cast("int").alias("slot")))


def op3_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


# The same recurrence over all pairs of cuts.
OP3_SQL = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, len(list_filter(string_split_regex(coalesce(text, ''), '[\\x09-\\x0D ]+'),
                                 lambda w: w <> ''))::INTEGER AS n_tokens FROM documents),
h AS (
  SELECT n_tokens, row_number() OVER (ORDER BY n_tokens) AS j, sum(count(*)) OVER (ORDER BY n_tokens)::HUGEINT AS c,
         sum(sum(n_tokens)) OVER (ORDER BY n_tokens)::HUGEINT AS s FROM sized GROUP BY n_tokens),
last AS (SELECT max(j) AS j, least({BUCKETS}, max(j)) AS k FROM h),
dp AS (
  SELECT 1::BIGINT AS k, j, n_tokens * c - s AS cost FROM h
  UNION ALL
  SELECT dp.k + 1, h.j, min(dp.cost + h.n_tokens * (h.c - p.c) - (h.s - p.s))
  FROM dp JOIN h p ON p.j = dp.j JOIN h ON h.j > dp.j WHERE dp.k < (SELECT k FROM last) GROUP BY dp.k, h.j),
steps AS (
  SELECT a.k, a.j, min(b.j) AS back FROM dp a JOIN h ON h.j = a.j JOIN dp b ON b.k = a.k - 1 AND b.j < a.j
  JOIN h p ON p.j = b.j WHERE a.cost = b.cost + h.n_tokens * (h.c - p.c) - (h.s - p.s) GROUP BY a.k, a.j),
way AS (
  SELECT k, j FROM last
  UNION ALL
  SELECT way.k - 1, steps.back FROM way JOIN steps ON steps.k = way.k AND steps.j = way.j),
bounds AS (
  SELECT row_number() OVER (ORDER BY way.j)::INTEGER - 1 AS bucket, n_tokens AS pad_to,
         coalesce(lag(n_tokens) OVER (ORDER BY way.j), -1) AS above FROM way JOIN h ON h.j = way.j),
placed AS (
  SELECT doc_id, n_tokens, bucket, pad_to, greatest(1, {TOKEN_BUDGET} // greatest(pad_to, 1)) AS capacity,
         row_number() OVER (PARTITION BY bucket ORDER BY n_tokens, doc_id) - 1 AS place
  FROM sized JOIN bounds ON n_tokens > above AND n_tokens <= pad_to)
SELECT doc_id, n_tokens, bucket, pad_to, place // capacity AS batch, (place % capacity)::INTEGER AS slot FROM placed
"""
