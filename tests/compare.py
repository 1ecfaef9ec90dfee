"""Run a registered query and its SQL side by side and compare rows as a multiset."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, Decimal):
        return ("dec", value.normalize())
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(row[i]).__name__, cell(row[i])) for i in order) for row in rows)


def compare(con, frame, sql: str) -> str | None:
    """None when equal, else what differs."""
    names = frame.columns
    spark_rows = rows_of(names, frame.collect())
    result = con.execute(sql)
    duck_names = [d[0] for d in result.description]
    duck_rows = rows_of(duck_names, result.fetchall())
    if sorted(names) != sorted(duck_names):
        return f"columns differ: {sorted(set(names) ^ set(duck_names))}"
    if spark_rows != duck_rows:
        only_spark, only_duck = spark_rows - duck_rows, duck_rows - spark_rows
        return (f"{sum(spark_rows.values())} rows against {sum(duck_rows.values())}; "
                f"spark only {list(only_spark)[:2]}; sql only {list(only_duck)[:2]}")
    return None
