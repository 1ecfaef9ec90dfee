"""Declared contracts: column types, key, not-null and relations of a table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from finloom.sources.domains import load_mapping

PLAIN_TYPES = {
    "bigint": T.LongType(), "long": T.LongType(), "int": T.IntegerType(), "integer": T.IntegerType(),
    "float": T.FloatType(), "double": T.DoubleType(), "date": T.DateType(), "boolean": T.BooleanType(),
}
DEFAULT_PRECISION, DEFAULT_SCALE = 18, 5


def spark_type(declared: str) -> T.DataType:
    """Declared type to Spark type. Anything unknown is a string; a bare decimal is (18,5)."""
    text = declared.lower().strip()
    if text in PLAIN_TYPES:
        return PLAIN_TYPES[text]
    if text.startswith("decimal"):
        numbers = [n.strip() for n in text.removeprefix("decimal").strip(" ()").split(",")]
        precision = int(numbers[0]) if numbers[0] else DEFAULT_PRECISION
        scale = int(numbers[1]) if len(numbers) > 1 and numbers[1] else DEFAULT_SCALE
        return T.DecimalType(precision, scale)
    return T.StringType()


def base_type(declared: str) -> str:
    """Coarse type name: ``varchar(n)`` is string, ``decimal(p,s)`` is decimal."""
    head = declared.lower().strip().split("(")[0].strip()
    return "string" if head == "varchar" else head


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    constraints: tuple[str, ...] = ()

    @property
    def is_key(self) -> bool:
        return "primary_key" in self.constraints

    @property
    def is_required(self) -> bool:
        return self.is_key or "not_null" in self.constraints


@dataclass(frozen=True)
class ContractRelation:
    column: str
    ref_table: str
    ref_column: str


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[ContractColumn, ...]
    relations: tuple[ContractRelation, ...] = field(default=())

    def column(self, name: str) -> ContractColumn:
        for column in self.columns:
            if column.name == name:
                return column
        raise KeyError(f"{self.name} declares no column {name}")

    @property
    def key(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if c.is_key)

    @property
    def foreign_keys(self) -> dict[str, tuple[str, str]]:
        return {r.column: (r.ref_table, r.ref_column) for r in self.relations}

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, spark_type(c.type), not c.is_required) for c in self.columns])


def read_contracts(source) -> dict[str, Contract]:
    """Contracts from a mapping or a YAML/JSON file: ``tables`` with ``columns`` and ``relationships``."""
    document = source if isinstance(source, Mapping) else load_mapping(source)
    contracts = {}
    for table in document.get("tables", []):
        columns = tuple(ContractColumn(c["name"], c.get("data_type", "string"), tuple(c.get("constraints", ())))
                        for c in table.get("columns", []))
        relations = tuple(ContractRelation(r["column"], r["references"]["table"], r["references"]["column"])
                          for r in table.get("relationships", []))
        contracts[table["name"]] = Contract(table["name"], columns, relations)
    return contracts
