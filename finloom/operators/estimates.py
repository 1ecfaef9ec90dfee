"""Estimates with stated bounds: keys by mergeable sketches, weights and NULL rates by their sampling error."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.functions.values import clamp_rate

LOG_BUCKETS = 14
SIGMAS = 4.0


def sketch_error(log_buckets: int = LOG_BUCKETS) -> float:
    """Relative error of a merged sketch that all but one in 15 000 stay within (four standard errors)."""
    return SIGMAS * 1.04 / math.sqrt(1 << log_buckets)


def key_sketches(df: DataFrame, key: str, by: Sequence[str] = (), log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """One sketch of the key for each slice, of a few KB whatever its rows: ``row_count, null_count, sketch``.

    Sketches of slices can be kept and merged, so a slice that is written again is all that is read again.
    """
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(key).isNull()).alias("null_count"),
                               F.hll_sketch_agg(key, log_buckets).alias("sketch"))


def key_estimate(sketches: DataFrame, table: str, key: str, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """Merged sketches as one report row. Its status is ``estimated`` or ``failed``, never ``ok``.

    It fails where NULLs are counted, or where rows exceed the estimate by more than its error: fewer duplicates than
    that share of the rows go unseen.
    """
    bound = sketch_error(log_buckets)
    merged = sketches.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
                          F.coalesce(F.sum("null_count"), F.lit(0)).alias("null_count"),
                          F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("estimate"))
    bad = (F.col("null_count") > 0) | (F.col("row_count") > F.col("estimate") * (1 + bound))
    return merged.select(F.lit(table).alias("table_name"), F.lit(key).alias("column_name"), "row_count", "null_count",
                         F.col("estimate").alias("distinct_estimate"), F.lit(bound).alias("error_bound"),
                         F.when(F.col("row_count") == 0, "empty").when(bad, "failed").otherwise("estimated").alias("status"))


def chi_square_tail(x: float, freedom: int) -> float:
    """The chance that chi-square with so many degrees of freedom exceeds ``x``."""
    a, x = freedom / 2, x / 2
    if x <= 0:
        return 1.0
    if x < a + 1:  # series of the lower part
        term = total = 1 / a
        k = a
        while term > total * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1 - total * math.exp(-x + a * math.log(x) - math.lgamma(a))
    # Continued fraction of the upper part, evaluated from the front.
    b, c = x + 1 - a, 1e300
    d = 1 / b
    value = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b)
        c = b + step / c
        value *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return value * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi_square_critical(freedom: int, alpha: float) -> float:
    """The value that chi-square exceeds with chance ``alpha``."""
    low, high = 0.0, 10.0 * freedom + 100
    while chi_square_tail(high, freedom) > alpha:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_tail(middle, freedom) > alpha else (low, middle)
    return high


def weight_fit(df: DataFrame, table: str, column: str, values: Sequence, weights: Sequence[float],
               alpha: float = 0.001) -> DataFrame:
    """Do the values come in their declared proportions? One scan, one row: Pearson's chi-square.

    NULLs do not count. A value that is not listed, or of weight 0, fails the fit by being there (``unlisted``). The
    bound follows the rows: of columns drawn as declared a share of ``alpha`` fails, at any size.
    """
    total = sum(weights)
    listed = [(value, weight / total) for value, weight in zip(values, weights, strict=True) if weight > 0]
    seen = [F.count_if(F.col(column) == value).alias(f"n{i}") for i, (value, _) in enumerate(listed)]
    rows = F.col("row_count")
    terms = [(F.col(f"n{i}") - rows * share) * (F.col(f"n{i}") - rows * share) / (rows * share)
             for i, (_, share) in enumerate(listed)]
    freedom = len(listed) - 1
    critical = chi_square_critical(freedom, alpha) if freedom else 0.0
    statistic = F.when(rows > 0, sum(terms[1:], terms[0])).otherwise(F.lit(0.0))
    return (df.agg(F.count(column).alias("row_count"), *seen)
            .withColumn("statistic", statistic)
            .withColumn("unlisted", rows - sum((F.col(f"n{i}") for i in range(1, len(listed))), F.col("n0")))
            .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "row_count", "unlisted",
                    "statistic", F.lit(freedom).alias("freedom"), F.lit(critical).alias("critical"),
                    ((F.col("unlisted") == 0) & (F.col("statistic") <= critical)).alias("ok")))


def null_rate_fit(df: DataFrame, table: str, declared: Mapping[str, float], sigmas: float = SIGMAS) -> DataFrame:
    """Observed against declared NULL rates, within the sampling error of so many rows; a rate of 0 or 1 is exact."""
    rates = {column: clamp_rate(rate) for column, rate in declared.items()}
    seen = [F.count_if(F.col(column).isNull()).alias(f"n{i}") for i, column in enumerate(rates)]
    entries = [F.struct(F.lit(column).alias("column_name"), F.col(f"n{i}").alias("null_count"),
                        F.lit(float(rate)).alias("declared_rate")) for i, (column, rate) in enumerate(rates.items())]
    spread = F.sqrt(F.col("row_count") * F.col("declared_rate") * (1 - F.col("declared_rate")))
    allowed = F.when(spread > 0, sigmas * spread + 0.5).otherwise(F.lit(0.0))
    apart = F.abs(F.col("null_count") - F.col("row_count") * F.col("declared_rate"))
    return (df.agg(F.count(F.lit(1)).alias("row_count"), *seen)
            .select("row_count", F.inline(F.array(*entries)))
            .select(F.lit(table).alias("table_name"), "column_name", "row_count", "null_count", "declared_rate",
                    allowed.alias("allowed"), (apart <= allowed).alias("ok")))
