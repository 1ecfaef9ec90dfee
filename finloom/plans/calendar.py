"""Fiscal calendar: every column is an expression over the period, so it needs no driver loop and no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom import functions as fn
from finloom.functions import fiscal

TABLE = "calendar_fiscal_period_v"
KEY = "fiscal_year_period_nbr"


def calendar_columns(period: Column, start_year: int = fiscal.START_YEAR) -> list[Column]:
    """The 39 calendar columns of a ``YYYYPP`` period; fiscal quarters equal calendar quarters."""
    year = fn.fiscal_year(period)
    month = period % 100
    position = fn.period_position(period, start_year)
    first = F.make_date(year, month, F.lit(1))
    last = F.last_day(first)
    quarter = (F.call_function("div", month - 1, F.lit(3)) + 1).cast("int")
    half = F.when(month >= 7, F.lit(2)).otherwise(F.lit(1))
    year_text, quarter_text = year.cast("string"), quarter.cast("string")
    two_digits = fn.padded(month, 2)
    fiscal_year_code = F.concat(F.lit("FY"), year_text)
    season = F.concat(F.lit("S"), half.cast("string"))
    named = {
        KEY: period.cast("int"),
        "month_long_nm": F.date_format(first, "MMMM"),
        "month_short_nm": F.date_format(first, "MMM"),
        "month_nbr": month.cast("int"),
        "year_mth": (year * 100 + month).cast("int"),
        "month_relevance_dt": first,
        "month_start_dt": first,
        "month_end_dt": last,
        "month_sort_sequence_nbr": position,
        "fiscal_period_nbr": month.cast("int"),
        "fiscal_period_cd": F.concat(F.lit("P"), two_digits),
        "fiscal_period_sort_sequence_nbr": position,
        "fiscal_year_period_cd": F.concat(fiscal_year_code, F.lit("P"), two_digits),
        "fiscal_year_period_nm": F.concat(fiscal_year_code, F.lit(" Period "), two_digits),
        "season_period_cd": season,
        "season_alternate_period_cd": F.concat(season, F.lit("A")),
        "season_nm": F.when(half == 2, F.lit("Fall/Winter")).otherwise(F.lit("Spring/Summer")),
        "season_relevance_dt": first,
        "season_start_dt": first,
        "season_end_dt": last,
        "season_sort_sequence_nbr": position,
        "quarter_calendar_nbr": quarter,
        "quarter_calendar_sequence_nbr": quarter,
        "quarter_business_nbr": quarter,
        "fiscal_quarter_nbr": quarter,
        "fiscal_quarter_cd": F.concat(F.lit("Q"), quarter_text),
        "fiscal_quarter_sort_sequence_nbr": quarter,
        "fiscal_year_quarter_nbr": (year * 10 + quarter).cast("int"),
        "fiscal_year_quarter_cd": F.concat(fiscal_year_code, F.lit("Q"), quarter_text),
        "fiscal_year_quarter_alternate_cd": F.concat(fiscal_year_code, F.lit("-Q"), quarter_text),
        "year_cd": year_text,
        "year_nm": fiscal_year_code,
        "year_nbr": year_text,
        "year_start_dt": F.make_date(year, F.lit(1), F.lit(1)),
        "year_end_dt": F.make_date(year, F.lit(12), F.lit(31)),
        "business_year_nbr": year,
        "fiscal_year_nbr": year,
        "fiscal_year_cd": fiscal_year_code,
        "fiscal_period_sort": position,
    }
    return [column.alias(name) for name, column in named.items()]


def calendar(spark: SparkSession, rows: int | None = None, start_year: int = fiscal.START_YEAR,
             years: int = fiscal.YEARS) -> DataFrame:
    """The first ``rows`` periods; more than ``years`` times twelve raise."""
    count = fn.period_count(rows, years)
    positions = spark.range(0, count, 1, 1).select(fn.nth_period(F.col("id"), start_year).alias("period"))
    return positions.select(*calendar_columns(F.col("period"), start_year))


def calendar_fields(spark: SparkSession) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in calendar(spark, 1).schema.fields]
