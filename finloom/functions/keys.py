"""Dense keys, prefixed text keys and join-free references into them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MAX = 2**31 - 1


def dense_key(row_id: Column) -> Column:
    return row_id.cast("bigint")


def int_key(row_id: Column, rows: int) -> Column:
    if rows > INT_MAX:
        raise ValueError(f"{rows} rows do not fit an int key")
    return row_id.cast("int")


def pad_width(pad: int, rows: int, strict: bool = False) -> int:
    """Digits needed so that ``lpad`` never cuts an id of ``1..rows``.

    ``lpad`` truncates longer input, which would make keys collide; the width
    grows with the domain instead, or ``strict`` refuses.
    """
    needed = len(str(max(1, rows)))
    if strict and needed > pad:
        raise ValueError(f"pad {pad} cannot hold {rows} distinct ids")
    return max(pad, needed)


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def text_key(number: Column, prefix: str, width: int) -> Column:
    """``PREFIX_000001`` for the id 1."""
    return F.concat(F.lit(f"{prefix}_"), padded(number, width))


def parse_text_key(key: Column, prefix: str) -> Column:
    """The id inside a text key, or NULL when the shape is wrong."""
    digits = F.regexp_extract(key, f"^{prefix}_([0-9]+)$", 1)
    return F.nullif(digits, F.lit("")).cast("bigint")


def ref(draw: str, domain_rows: int | None) -> Column:
    """Uniform id of ``1..domain_rows``: always a parent, and no join to find it."""
    return F.expr(f"{draw} % {max(1, domain_rows or 1)}L + 1L")
