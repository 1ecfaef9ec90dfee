"""Star joins, the downstream aggregate, join survival and roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.operators.reduction import reduced

BROADCAST_BYTES = 256 * 1024 * 1024
TEXT_BYTES, VALUE_BYTES, ROW_BYTES = 64, 16, 32


@dataclass(frozen=True)
class Branch:
    """One dimension or hierarchy of the star, equi-joined on ``fact_key = key``.

    ``rows`` is an upper bound of its size when one is known, as it is for every
    declared or counted dimension. ``partial`` says that it lacks many of the fact's
    keys, as a hierarchy over a part of its dimension does.
    """

    table: DataFrame
    fact_key: str
    key: str
    rows: int | None = None
    partial: bool = False

    def bytes_bound(self) -> int | None:
        """Generous size bound from the row bound and the column types."""
        if self.rows is None:
            return None
        width = sum(TEXT_BYTES if kind == "string" else VALUE_BYTES for _, kind in self.table.dtypes)
        return self.rows * (ROW_BYTES + width)

    def side(self, limit: int = BROADCAST_BYTES) -> DataFrame:
        """The table, marked for broadcast only when its size bound is within the limit."""
        bound = self.bytes_bound()
        return F.broadcast(self.table) if bound is not None and bound <= limit else self.table


def broadcast_plan(branches: Sequence[Branch], limit: int) -> list[bool]:
    """Which branches to broadcast, in their order: as many as the limit holds together."""
    chosen = []
    for branch in branches:
        bound = branch.bytes_bound()
        chosen.append(bound is not None and bound <= limit)
        limit -= bound if chosen[-1] else 0
    return chosen


def reduce_fact(fact: DataFrame, branches: Sequence[Branch], chosen: Sequence[bool]) -> DataFrame:
    """The fact thinned by the keys of all partial branches that are not broadcast, before any join moves it."""
    for branch, small in zip(branches, chosen):
        if branch.partial and not small:
            fact = reduced(fact, branch.fact_key, branch.table, branch.key, branch.rows)
    return fact


def star_join(fact: DataFrame, branches: Sequence[Branch], broadcast_limit: int = BROADCAST_BYTES) -> DataFrame:
    """Inner-join the branches in the order given; put the ones that filter most first.

    Branches with a proven small size are broadcast, so the fact is not moved for them, as long as all of them together
    stay within the limit. Any other is left to Spark: its own size check, or a sort-merge join in which adaptive
    execution splits hot fact keys. Where such a branch is partial, a filter over its keys thins the fact first.
    """
    chosen = broadcast_plan(branches, broadcast_limit)
    joined = reduce_fact(fact, branches, chosen)
    for branch, small in zip(branches, chosen):
        side = F.broadcast(branch.table) if small else branch.table
        joined = joined.join(side, F.col(branch.fact_key) == F.col(branch.key), "inner")
    return joined


def star_aggregate(fact: DataFrame, branches: Sequence[Branch], group_by: Sequence[Column | str],
                   measures: Mapping[str, Column], broadcast_limit: int = BROADCAST_BYTES) -> DataFrame:
    """The star join grouped by fact and dimension attributes."""
    return (star_join(fact, branches, broadcast_limit)
            .groupBy(*group_by)
            .agg(*[measure.alias(name) for name, measure in measures.items()]))


def survival_estimate(sizes: Mapping[str, int], filters: Sequence[tuple[str, str]]) -> float:
    """Expected share of fact rows that pass every (hierarchy, dimension) filter: the product of size ratios."""
    share = 1.0
    for hierarchy, dimension in filters:
        share *= min(1.0, sizes[hierarchy] / sizes[dimension])
    return share


def survival_by_key(fact: DataFrame, branch: Branch) -> DataFrame:
    """(row_count, surviving) for one branch, with the fact folded per key before the join."""
    grouped = fact.groupBy(F.col(branch.fact_key).alias("child_key")).agg(F.count(F.lit(1)).alias("n"))
    keys = branch.table.select(F.col(branch.key).alias("parent_key")).distinct()
    return (grouped.join(keys, F.col("child_key") == F.col("parent_key"), "left")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
                 F.coalesce(F.sum(F.when(F.col("parent_key").isNotNull(), F.col("n"))), F.lit(0))
                 .cast("bigint").alias("surviving")))


def surviving_rows(fact: DataFrame, branches: Sequence[Branch], broadcast_limit: int = BROADCAST_BYTES) -> DataFrame:
    """Fact rows that find a partner in every branch; a semi join cannot multiply rows."""
    only_keys = [replace(branch, table=branch.table.select(F.col(branch.key).alias("parent_key")), key="parent_key")
                 for branch in branches]
    chosen = broadcast_plan(only_keys, broadcast_limit)
    kept = reduce_fact(fact, only_keys, chosen)
    for branch, small in zip(only_keys, chosen):
        side = F.broadcast(branch.table) if small else branch.table
        kept = kept.join(side, F.col(branch.fact_key) == F.col("parent_key"), "left_semi")
    return kept


def roll_up(df: DataFrame, levels: Sequence[str], sums: Mapping[str, str], count_as: str = "row_count"
            ) -> DataFrame:
    """Totals at every prefix of ``levels`` down to the grand total.

    Rows are folded at the finest level first; only those few rows are then
    expanded to the coarser levels. ``level`` tells how many levels are kept,
    since a NULL level name may also be data.
    """
    finest = df.groupBy(*levels).agg(
        F.count(F.lit(1)).alias(count_as), *[F.sum(column).alias(name) for name, column in sums.items()])
    kept = sum((1 - F.grouping(level).cast("int") for level in levels), F.lit(0))
    return finest.rollup(*levels).agg(
        kept.alias("level"), F.sum(count_as).alias(count_as),
        *[F.sum(name).alias(name) for name in sums])


def level_totals(df: DataFrame, levels: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Totals per member of each level on its own: (level_nm, member, row_count, sums); NULL members drop out.

    Folded at the full path first, then each folded row is repeated once per level.
    """
    finest = df.groupBy(*levels).agg(
        F.count(F.lit(1)).alias("row_count"), *[F.sum(column).alias(name) for name, column in sums.items()])
    members = F.inline(F.array(*[F.struct(F.lit(level).alias("level_nm"), F.col(level).alias("member"))
                                 for level in levels]))
    return (finest.select("row_count", *sums, members)
            .where(F.col("member").isNotNull())
            .groupBy("level_nm", "member")
            .agg(F.sum("row_count").alias("row_count"), *[F.sum(name).alias(name) for name in sums]))


def fiscal_roll_up(df: DataFrame, period: str, calendar: DataFrame, levels: Sequence[str],
                   sums: Mapping[str, str]) -> DataFrame:
    """Roll up by calendar attributes; the facts are folded per period before they meet the calendar.

    Facts of periods that the calendar does not hold (or without one) form members of their own, whose attributes
    are NULL, and are part of every total.
    """
    per_period = df.groupBy(F.col(period).alias("__period")).agg(
        F.count(F.lit(1)).alias("row_count"), *[F.sum(column).alias(name) for name, column in sums.items()])
    dated = per_period.join(calendar, F.col("__period") == F.col("fiscal_year_period_nbr"), "left")
    kept = sum((1 - F.grouping(level).cast("int") for level in levels), F.lit(0))
    return dated.rollup(*levels).agg(kept.alias("level"), F.sum("row_count").alias("row_count"),
                                     *[F.sum(name).alias(name) for name in sums])
