"""Categories, whole and decimal ranges, and dates drawn from a stream."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal
from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F

LOOKUP_LIMIT = 1000
DRAW_LIMIT = 2**62


def clamp_rate(rate: float | None) -> float:
    return min(1.0, max(0.0, float(rate or 0.0)))


def sql_literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def _lookup(values: Sequence, position: str, type_name: str) -> Column:
    literal = ", ".join(sql_literal(v) for v in values)
    return F.expr(f"cast(get(array({literal}), cast({position} as int)) as {type_name})")


def weight_slots(weights: Sequence[int]) -> list[int]:
    """Weights over their common divisor; relative, so they need not sum to 100."""
    if any(w < 0 or w != int(w) for w in weights) or sum(weights) <= 0:
        raise ValueError(f"weights must be whole, not negative and not all zero: {weights}")
    shared = gcd(*[int(w) for w in weights])
    return [int(w) // shared for w in weights]


def pick(draw: str, values: Sequence, weights: Sequence[int] | None = None,
         type_name: str = "string") -> Column:
    """Uniform or weighted choice.

    Small weight totals become one literal array indexed by the draw: no branch
    per value, which keeps the generated code of wide tables short.
    """
    if not values:
        raise ValueError("no values to pick from")
    if weights is None:
        return _lookup(values, f"{draw} % {len(values)}", type_name)
    if len(weights) != len(values):
        raise ValueError("one weight per value is needed")
    slots = weight_slots(weights)
    total = sum(slots)
    if total <= LOOKUP_LIMIT:
        spread = [value for value, slot in zip(values, slots) for _ in range(slot)]
        return _lookup(spread, f"{draw} % {total}", type_name)
    branches, bound = [], 0
    for value, slot in zip(values, slots):
        bound += slot
        branches.append(f"WHEN {draw} % {total}L < {bound}L THEN {sql_literal(value)}")
    return F.expr(f"cast(CASE {' '.join(branches)} END as {type_name})")


def cycle(number: str, values: Sequence, type_name: str = "string") -> Column:
    """Values in order by id (SQL text): 1 takes the first, and it starts over at the end."""
    return _lookup(values, f"(({number}) - 1) % {len(values)}", type_name)


def whole(draw: str, low: int, high: int, type_name: str = "int") -> Column:
    """Uniform whole number, both ends included."""
    if high < low:
        raise ValueError(f"empty range {low}..{high}")
    return F.expr(f"cast({draw} % {high - low + 1}L + {low}L as {type_name})")


def real(draw: str, low: float, high: float) -> Column:
    """Uniform float on a 24-bit grid."""
    grain = 1 << 24
    return F.expr(f"cast({float(low)}D + cast({draw} % {grain} as double) / {grain}D"
                  f" * {float(high) - float(low)}D as float)")


def amount_units(low, high, scale: int) -> tuple[int, int, int]:
    """(draw scale, lowest unit, number of units) that fit the 63-bit draw."""
    low, high = Decimal(str(low)), Decimal(str(high))
    if high < low:
        raise ValueError(f"empty range {low}..{high}")
    for draw_scale in range(scale, -1, -1):
        first, last = int(low.scaleb(draw_scale)), int(high.scaleb(draw_scale))
        if last - first + 1 <= DRAW_LIMIT and max(abs(first), abs(last)) < 10**18:
            return draw_scale, first, last - first + 1
    raise ValueError(f"range {low}..{high} is too wide")


def amount(draw: str, low, high, precision: int = 28, scale: int = 5) -> Column:
    """Uniform exact decimal: a whole number of smallest units, never a float."""
    draw_scale, first, units = amount_units(low, high, scale)
    unit = f"{Decimal(1).scaleb(-draw_scale):f}BD"
    return F.expr(f"cast(cast({draw} % {units}L + {first}L as decimal(18,0)) * {unit}"
                  f" as decimal({precision},{scale}))")


def day(draw: str, begin: str, end: str) -> Column:
    """Uniform date, both ends included."""
    span = (date.fromisoformat(end) - date.fromisoformat(begin)).days
    if span < 0:
        raise ValueError(f"empty range {begin}..{end}")
    return F.expr(f"date_add(date'{begin}', cast({draw} % {span + 1} as int))")
