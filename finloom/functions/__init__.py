"""Pure Column functions: value streams, keys, categories, templates, amounts, dates, fiscal periods."""

from finloom.functions.streams import null_out, salt, stream
from finloom.functions.keys import (
    dense_key, int_key, pad_width, padded, parse_text_key, ref, text_key,
)
from finloom.functions.values import (
    amount, clamp_rate, cycle, day, pick, real, whole,
)
from finloom.functions.templates import template_regex, text
from finloom.functions.fiscal import (
    MAX_PERIODS, fiscal_period, fiscal_year, nth_period, period_between, period_count, period_of_date,
    period_position,
)

__all__ = [
    "MAX_PERIODS", "amount", "clamp_rate", "cycle", "day", "dense_key", "fiscal_period",
    "fiscal_year", "int_key", "nth_period", "null_out", "pad_width", "padded", "parse_text_key",
    "period_between", "period_count", "period_of_date", "period_position", "pick", "real", "ref", "salt", "stream",
    "template_regex", "text", "text_key", "whole",
]
