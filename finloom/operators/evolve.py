"""Fitting the rows of an append to the columns a table already has.

Nothing is written until every column fits. What a table may take on beyond its columns is asked for by name:

``add``    columns that the table lacks join it; its older rows read NULL there
``fill``   columns that the rows lack are written as NULL
``widen``  a column takes the wider of its type and the rows' type, where no value of either is lost

Rows of a narrower type always fit. Names compare without case and keep the table's spelling.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WAYS = ("add", "fill", "widen")
WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
WHOLE = list(WHOLE_DIGITS)


class SchemaMismatch(ValueError):
    """Rows that do not fit the columns of their table."""


def digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point, of an exact number."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (WHOLE_DIGITS[type(kind)], 0) if type(kind) in WHOLE_DIGITS else None


def wider(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The type that holds every value of both, or None where there is none."""
    if one == other:
        return one
    if type(one) in WHOLE_DIGITS and type(other) in WHOLE_DIGITS:
        return max(one, other, key=lambda kind: WHOLE.index(type(kind)))
    sizes = digits(one), digits(other)
    if None not in sizes:
        before, after = (max(pair) for pair in zip(*sizes, strict=True))
        return T.DecimalType(before + after, after) if before + after <= 38 else None
    kinds = {type(one), type(other)}
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if T.DoubleType in kinds and kinds & {T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None


def nullable(kind: T.DataType) -> T.DataType:
    """The type with every nested part nullable, as a reader sees stored columns."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType), True)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in kind.fields])
    return kind


def stored_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in schema.fields])


def fitted(df: DataFrame, stored: T.StructType, evolve: Collection[str] = (), fixed: Collection[str] = (),
           table: str = "table") -> tuple[DataFrame, T.StructType]:
    """The rows with the columns of the table, and the table's schema once they are in it.

    ``fixed`` names columns whose type may not change (those a table is partitioned by). Raises ``SchemaMismatch`` with
    every column that does not fit.
    """
    unknown = set(evolve) - set(WAYS)
    if unknown:
        raise ValueError(f"ways to evolve are {WAYS}, not {sorted(unknown)}")
    names = Counter(name.lower() for name in df.columns)
    problems = [f"{name}: {n} columns of this name" for name, n in names.items() if n > 1]
    if problems:
        raise SchemaMismatch(f"{table}: " + "; ".join(problems))
    offered = {f.name.lower(): f for f in df.schema.fields}
    kept, columns, fields = {name.lower() for name in fixed}, [], []
    for field in stored.fields:
        new = offered.pop(field.name.lower(), None)
        kind = field.dataType
        if new is None:
            if "fill" not in evolve:
                problems.append(f"{field.name}: absent")
            columns.append(F.lit(None).cast(kind).alias(field.name))
        else:
            kind = wider(field.dataType, nullable(new.dataType))
            said = f"stored {field.dataType.simpleString()}, offered {new.dataType.simpleString()}"
            if kind is None:
                problems.append(f"{field.name}: {said}")
            elif kind != field.dataType and ("widen" not in evolve or field.name.lower() in kept):
                problems.append(f"{field.name}: {said}, wider")
            columns.append(F.col(f"`{new.name}`").cast(kind or field.dataType).alias(field.name))
        fields.append(T.StructField(field.name, kind or field.dataType, True))
    for field in offered.values():
        if "add" not in evolve:
            problems.append(f"{field.name}: not a column of the table")
        columns.append(F.col(f"`{field.name}`"))
        fields.append(T.StructField(field.name, nullable(field.dataType), True))
    if problems:
        raise SchemaMismatch(f"{table}: " + "; ".join(problems))
    return df.select(*columns), T.StructType(fields)
