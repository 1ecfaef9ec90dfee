"""Deterministic per-column value streams.

Every generated value is a function of (seed, table, column, row id), so a lost
task recomputes the same rows and the partition count never changes the data.
``rand(seed)`` has neither property.

A stream is handled as SQL text over the row id; the generators turn it into a
Column with a single ``F.expr``, which keeps the planning of wide tables cheap.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_GRAIN = 1_000_000


def salt(seed: int, table: str, column: str) -> int:
    """63-bit literal naming one stream."""
    digest = hashlib.md5(f"{seed}/{table}/{column}".encode()).digest()
    return int.from_bytes(digest[:8], "big") >> 1


def stream(row_id: str, seed: int, table: str, column: str) -> str:
    """Uniform non-negative 63-bit bigint per row id, as SQL text; ``row_id`` is SQL text of a bigint."""
    return f"shiftrightunsigned(xxhash64({salt(seed, table, column)}L, {row_id}), 1)"


def null_out(value: Column, draw: str, rate: float) -> Column:
    """Blank ``rate`` of the rows, decided by a stream of its own."""
    threshold = round(rate * NULL_GRAIN)
    if threshold <= 0:
        return value
    return F.when(F.expr(f"{draw} % {NULL_GRAIN} >= {threshold}"), value)
