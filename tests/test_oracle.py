"""Every registered query against its SQL on the smallest driver tables."""

import __spark_entry__ as contract
import pytest
from compare import compare, connect

SF = "/root/testdata/sf0.001"
CORPUS = contract.corpus_registry()  # has its own tests
QUERIES = {name: run for name, run in contract.queries().items() if name not in CORPUS}
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert name in SQL
    assert compare(duck, QUERIES[name](spark, SF), SQL[name]) is None


def test_entry_returns_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
