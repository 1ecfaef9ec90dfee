"""The driver's tables against declared contracts that they keep in part."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver.tables import read
from finloom.operators.contracts import cycles, declared_type, verify_contracts
from finloom.sources.contract import read_contracts

# "key": part of the primary key, "set": never NULL. A table is columns, then references.
DECLARED = {
    "region": ({"r_regionkey": "int key", "r_name": "string set"}, {"r_regionkey": "nation.n_nationkey"}),
    "nation": ({"n_nationkey": "int key", "n_name": "varchar(25) set", "n_regionkey": "bigint"},
               {"n_regionkey": "region.r_regionkey"}),
    "customer": ({"c_custkey": "bigint key", "c_name": "string set", "c_nationkey": "int", "c_acctbal": "double",
                  "c_mktsegment": "string", "c_since": "date set"}, {"c_nationkey": "nation.n_nationkey"}),
    "supplier": ({"s_suppkey": "bigint key", "s_name": "string", "s_nationkey": "int", "s_acctbal": "decimal(12,2)"},
                 {"s_nationkey": "nation.n_nationkey", "s_name": "customer.c_custkey"}),
    "part": ({"p_partkey": "bigint key", "p_name": "string", "p_brand": "string", "p_size": "int", "p_retailprice": "double"},
             {}),
    "orders": ({"o_orderkey": "bigint key", "o_custkey": "bigint set", "o_orderstatus": "string", "o_totalprice": "double",
                "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
               {"o_custkey": "customer.c_custkey", "o_clerk": "clerk.clerk_id"}),
    "lineitem": ({"l_orderkey": "bigint key", "l_linenumber": "int key", "l_partkey": "bigint", "l_suppkey": "bigint",
                  "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
                  "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
                 {"l_orderkey": "orders.o_orderkey", "l_partkey": "part.p_partkey", "l_suppkey": "supplier.s_suppkey"}),
    "events": ({"user_id": "bigint key", "event_id": "bigint set", "ts": "timestamp_ntz", "event_type": "string",
                "value": "double", "props": "string"}, {"user_id": "solvent.c_custkey"}),
    "documents": ({"doc_id": "bigint key", "text": "string set", "lang": "string", "source": "string", "n_chars": "int"}, {}),
    "embeddings": ({"vec_id": "bigint key", "embedding": "array<float>", "label": "int"}, {}),
    "pages": ({"page_id": "bigint key", "url": "string set", "html": "string"}, {}),
    "benchmark": ({"item_id": "bigint key", "text": "string set"}, {}),
    "labels": ({"doc_id": "bigint key", "quality": "int", "toxic": "int"}, {"doc_id": "documents.doc_id"}),
    "conversations": ({"conv_id": "bigint key", "turn": "bigint key", "role": "string", "text": "string"},
                      {"turn": "orders_open.o_custkey"}),
    # Orders in process have no customer yet; customers who owe have no row among the solvent; nobody returns a thing.
    "orders_open": ({"o_orderkey": "bigint key", "o_custkey": "bigint set", "o_orderstatus": "string",
                     "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
                    {"o_custkey": "customer.c_custkey"}),
    "returns": ({"return_id": "bigint key", "order_id": "bigint"}, {"order_id": "orders.o_orderkey"}),
}
SOURCES = {"orders_open": ("orders", """SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey)
                                        FROM orders"""),
           "solvent": ("customer", "SELECT * FROM customer WHERE c_acctbal >= 0"),
           "returns": (None, ""), "clerk": (None, "")}
MARKS = {"key": ["primary_key"], "set": ["not_null"]}


def contracts():
    def column(name: str, said: str) -> dict:
        kind, *marks = said.split()
        return {"name": name, "data_type": kind, "constraints": [m for mark in marks for m in MARKS[mark]]}

    return read_contracts({"tables": [
        {"name": name, "columns": [column(*pair) for pair in columns.items()],
         "relationships": [{"column": c, "references": dict(zip(("table", "column"), target.split("."), strict=True))}
                           for c, target in references.items()]}
        for name, (columns, references) in DECLARED.items()]})


def load(spark: SparkSession, sf: str, name: str) -> DataFrame | None:
    if name == "orders_open":
        late = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
        return read(spark, sf, "orders").withColumn("o_custkey", late)
    if name == "solvent":
        return read(spark, sf, "customer").where("c_acctbal >= 0")
    try:
        return read(spark, sf, name)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def verify_contract(spark: SparkSession, sf: str) -> DataFrame:
    return verify_contracts(spark, contracts(), lambda name: load(spark, sf, name))


def verify_contract_sql() -> str:
    """Columns and types come from DuckDB's own catalogue, all counts from the tables."""
    declared = contracts()
    source = {name: SOURCES.get(name, (name, f"SELECT * FROM {name}")) for name in
              {*declared, *(r.ref_table for c in declared.values() for r in c.relations)}}
    owned = {name: {column.name for column in contract.columns} for name, contract in declared.items()}
    held = {name: owned.get(name, set()) for name in source}
    held["customer"] = held["customer"] - {"c_since"}
    wanted, rows = [], []
    for name, contract in declared.items():
        base, sql = source[name]
        rows.append(f"SELECT '{name}', '', 'table', '', '{'' if base else 'absent'}', NULL, {0 if base else 1}")
        for column in contract.columns if base else ():
            wanted.append(f"('{name}', '{base}', '{column.name}', '{declared_type(column.type)}')")
            if column.is_required and column.name in held[name]:
                rows.append(f"""SELECT '{name}', '{column.name}', 'not_null', '', '', count(*),
                                       count(*) FILTER ({column.name} IS NULL) FROM ({sql})""")
        keys = ", ".join(contract.key)
        if base:
            present = " AND ".join(f"{key} IS NOT NULL" for key in contract.key)
            rows.append(f"""SELECT '{name}', '{",".join(contract.key)}', 'key', '', '', sum(n), sum(n) - count(*) FILTER ({present})
                            FROM (SELECT {keys}, count(*) AS n FROM ({sql}) GROUP BY ALL)""")
        else:
            rows.append(f"SELECT '{name}', '{','.join(contract.key)}', 'key', '', 'absent', NULL, NULL")
        for relation in contract.relations:
            target = f"{relation.ref_table}.{relation.ref_column}"
            head = f"SELECT '{name}', '{relation.column}', 'reference', '{target}', "
            parent, parent_sql = source[relation.ref_table]
            lost = [f"{table} is absent" for table in (name, relation.ref_table) if not source[table][0]]
            lost += [f"{name}.{relation.column} is absent"] if base and relation.column not in held[name] else []
            if lost:
                rows.append(f"{head}'{', '.join(lost)}', NULL, NULL")
            elif relation.column == "s_name":
                rows.append(f"{head}'string against bigint', NULL, NULL")
            else:
                rows.append(f"""{head}'', count(*), count(*) FILTER ({relation.column} IS NOT NULL AND {relation.column} NOT IN (
                    SELECT {relation.ref_column} FROM ({parent_sql}) WHERE {relation.ref_column} IS NOT NULL)) FROM ({sql})""")
            of_parent = declared.get(relation.ref_table)
            if of_parent is not None and of_parent.key != (relation.ref_column,):
                rows.append(f"SELECT '{name}', '{relation.column}', 'parent_key', '{target}', '{','.join(of_parent.key)}', NULL, 1")
    rows += [f"SELECT '{group[0]}', '', 'cycle', '', '{' > '.join((*group, group[0]))}', NULL, 1" for group in cycles(declared)]
    bases = ", ".join(f"('{name}', '{source[name][0]}')" for name in declared if source[name][0])
    return f"""WITH wanted(table_name, base, column_name, expected) AS (VALUES {', '.join(wanted)}),
bases(table_name, base) AS (VALUES {bases}),
held AS (
  SELECT table_name AS base, column_name, CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(data_type) END AS kind
  FROM information_schema.columns),
shape AS (
  SELECT w.table_name, w.column_name, CASE WHEN kind IS NULL THEN 'column' ELSE 'type' END AS rule, expected,
         coalesce(kind, '') AS actual, NULL AS row_count, CASE WHEN kind = expected THEN 0 ELSE 1 END AS failures
  FROM wanted w LEFT JOIN held h ON h.base = w.base AND h.column_name = w.column_name
  UNION ALL
  SELECT b.table_name, h.column_name, 'extra', '', kind, NULL, 1 FROM bases b JOIN held h ON h.base = b.base
  WHERE NOT EXISTS (FROM wanted w WHERE w.table_name = b.table_name AND w.column_name = h.column_name)),
counted(table_name, column_name, rule, expected, actual, row_count, failures) AS ({' UNION ALL '.join(rows)}),
found AS (FROM shape UNION ALL FROM counted)
SELECT table_name, column_name, rule, expected, actual, row_count::BIGINT AS row_count, failures::BIGINT AS failures,
  CASE WHEN actual LIKE '% against %' THEN 'failed' WHEN failures IS NULL THEN 'skipped' WHEN failures > 0 THEN 'failed'
       ELSE 'ok' END AS status,
  CASE WHEN actual LIKE '% against %' THEN false WHEN failures IS NOT NULL THEN failures = 0 END AS ok
FROM found"""


def contract_queries() -> dict[str, tuple[Callable, Callable[[], str]]]:
    return {"verify_contract": (verify_contract, verify_contract_sql)}
