"""Fiscal periods as ``YYYYPP`` ints: twelve per year, ``MAX_PERIODS`` in a calendar of the default span."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First fiscal year and calendar length.
START_YEAR = 2018
YEARS = 16
MAX_PERIODS = YEARS * 12


def period_count(requested: int | None, years: int = YEARS) -> int:
    """How many periods a calendar of the requested size holds; none or < 1 means all, more than it has raises."""
    full = years * 12
    if requested is not None and requested > full:
        raise ValueError(f"a calendar of {years} years has {full} periods, not {requested}: ask for more years")
    return full if requested is None or requested < 1 else int(requested)


def nth_period(position: Column, start_year: int = START_YEAR) -> Column:
    """Period at a 0-based position."""
    year = F.call_function("div", position, F.lit(12)) + start_year
    return (year * 100 + position % 12 + 1).cast("int")


def fiscal_period(draw: str, count: int | None, start_year: int = START_YEAR, years: int = YEARS) -> Column:
    """Uniform period out of the first ``count``."""
    return nth_period(F.expr(f"{draw} % {period_count(count, years)}L"), start_year)


def place_of(period: int, start_year: int) -> int:
    """0-based position of a period given as a number."""
    year, month = divmod(period, 100)
    if not 1 <= month <= 12:
        raise ValueError(f"{period} is no fiscal period")
    return (year - start_year) * 12 + month - 1


def period_between(draw: str, low: int, high: int, count: int | None, start_year: int = START_YEAR,
                   years: int = YEARS) -> Column:
    """Uniform period between two, both included; both must be among the first ``count`` of the calendar."""
    first, last, held = place_of(low, start_year), place_of(high, start_year), period_count(count, years)
    if not 0 <= first <= last < held:
        raise ValueError(f"periods {low}..{high} are not a range of the calendar's {held} periods from {start_year}")
    return nth_period(F.expr(f"{draw} % {last - first + 1}L + {first}L"), start_year)


def fiscal_year(period: Column) -> Column:
    return F.call_function("div", period, F.lit(100)).cast("int")


def period_of_date(moment: Column) -> Column:
    return (F.year(moment) * 100 + F.month(moment)).cast("int")


def period_position(period: Column, start_year: int = START_YEAR) -> Column:
    """1-based position of a period in the calendar."""
    return ((fiscal_year(period) - start_year) * 12 + period % 100).cast("int")
