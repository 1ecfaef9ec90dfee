"""The corpus queries that have SQL, side by side with it."""

import pytest
from compare import compare, connect

from finloom.llm.registry import registry

SF = "/root/testdata/sf0.001"
WITH_SQL = sorted(name for name, (_, sql) in registry().items() if sql)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_sql(spark, name):
    run, sql = registry()[name]
    con = connect(SF)
    try:
        assert compare(con, run(spark, SF), sql) is None
    finally:
        con.close()


def test_every_operator_is_registered():
    assert sorted(name.split("_")[0] for name in registry()) == sorted(["pipeline", *(f"op{n}" for n in range(1, 14))])
