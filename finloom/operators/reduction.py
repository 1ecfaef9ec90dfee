"""Semi-join reduction: fact rows without a partner in a large branch go before the fact is shuffled.

The branch's keys become bits of a hash filter of at most ``MAX_WORDS`` longs, which is broadcast in place of the branch.
A row whose bit is not set has no partner for certain; a row that stays without one is dropped by the join that follows.
Spark puts in filters of its own only behind a selective predicate, which a hierarchy that is partial by itself lacks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.operators.checks import INTEGRAL

KEY_BITS = 16  # per key: one in sixteen rows without a partner stays
MAX_WORDS = 1 << 20  # 8 MB of bits, some 50 MB as a broadcast relation
WORD_BITS = 64


def filter_words(rows: int | None) -> int:
    """Longs of the filter for that many keys, a power of two; unknown sizes take the largest filter."""
    wanted = MAX_WORDS if rows is None else max(1, rows * KEY_BITS // WORD_BITS)
    return min(MAX_WORDS, 1 << (wanted - 1).bit_length())


def shared_type(fact: DataFrame, fact_key: str, table: DataFrame, key: str) -> str | None:
    """The type under which equal keys have equal hashes, if the two sides have one."""
    kinds = {fact.schema[fact_key].dataType.simpleString(), table.schema[key].dataType.simpleString()}
    if kinds <= set(INTEGRAL):
        return "bigint"
    return kinds.pop() if len(kinds) == 1 and kinds <= {"string", "date"} else None


def _spot(key: str, kind: str, words: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`").cast(kind)), F.lit(words * WORD_BITS))


def key_filter(table: DataFrame, key: str, kind: str, words: int) -> DataFrame:
    """The set words of the filter: ``__word``, ``__bits``. Folded map-side, so no task hands on more than the filter."""
    spot = _spot(key, kind, words)
    return (table.where(F.col(f"`{key}`").isNotNull())
            .select(F.call_function("div", spot, F.lit(WORD_BITS)).alias("__word"), (spot % WORD_BITS).cast("int").alias("bit"))
            .groupBy("__word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit")))
                                   .alias("__bits")))


def reduced(fact: DataFrame, fact_key: str, table: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """The fact without most of the rows that have no partner under ``fact_key = key``; none with a partner goes.

    The fact is returned as it is where the key is not its own, where the types have no common hash, or where the table
    is known to hold more keys than the largest filter has bits.
    """
    if fact_key not in fact.columns or (rows is not None and rows > MAX_WORDS * WORD_BITS):
        return fact
    kind = shared_type(fact, fact_key, table, key)
    if kind is None:
        return fact
    words = filter_words(rows)
    spot = _spot(fact_key, kind, words)
    bit = F.call_function("shiftright", F.col("__bits"), (spot % WORD_BITS).cast("int")).bitwiseAND(F.lit(1))
    return fact.join(F.broadcast(key_filter(table, key, kind, words)),
                     (F.call_function("div", spot, F.lit(WORD_BITS)) == F.col("__word")) & (bit == 1), "left_semi")
