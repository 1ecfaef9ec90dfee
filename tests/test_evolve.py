"""Appends that change a table's columns, refusals ahead of any write, and slices written again."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.operators.evolve import SchemaMismatch, fitted, wider
from finloom.operators.writer import write_table
from finloom.sources.location import Location
from finloom.sources.record import ConcurrentChange, Record, read_record, write_record


def rows(spark, ddl, *values):
    return spark.createDataFrame(list(values), ddl)


def held(place, spark, table="t"):
    return sorted(map(tuple, place.read(spark, table).collect()), key=str)


@pytest.fixture
def place(tmp_path):
    return Location(path=str(tmp_path))


@pytest.mark.parametrize(("one", "other", "both"), [
    ("int", "bigint", "bigint"), ("smallint", "tinyint", "smallint"), ("float", "double", "double"),
    ("int", "double", "double"), ("bigint", "double", None), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
    ("decimal(38,2)", "decimal(38,10)", None), ("int", "decimal(4,2)", "decimal(12,2)"), ("string", "int", None),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "timestamp", None), ("bigint", "decimal(5,0)", "decimal(19,0)"),
])
def test_wider_types_lose_no_value(spark, one, other, both):
    kinds = [spark.createDataFrame([], f"c {kind}").schema["c"].dataType for kind in (one, other)]
    found = {wider(*pair) for pair in (kinds, kinds[::-1])}
    assert {kind and kind.simpleString() for kind in found} == {both}


def test_columns_join_and_widen(spark, place):
    write_table(rows(spark, "id int, x float, amt decimal(6,2)", (1, 1.5, None)), place, "t")
    newer = rows(spark, "ID bigint, x double, amt decimal(9,4), note string", (2 ** 40, 0.1, None, "n"))
    write_table(newer, place, "t", "append", evolve=("add", "widen"))
    write_table(rows(spark, "id smallint, amt int", (3, 7)), place, "t", "append", evolve=("fill", "widen"))
    found = place.read(spark, "t")
    assert [f.simpleString() for f in found.schema] == ["id:bigint", "x:double", "amt:decimal(14,4)", "note:string"]
    assert [(r.id, r.x, r.amt and float(r.amt), r.note) for r in found.orderBy("id").collect()] == [
        (1, 1.5, None, None), (3, None, 7.0, None), (2 ** 40, 0.1, None, "n")]
    assert found.where("amt > 6").count() == 1 and found.where("note is null").count() == 2


@pytest.mark.parametrize(("ddl", "ways", "said"), [
    ("id int, a string", (), "a: stored int, offered string"),
    ("id int", (), "a: absent"),
    ("id bigint, a int", (), "id: stored int, offered bigint, wider"),
    ("id int, a int, b int", ("fill", "widen"), "b: not a column"),
    ("id int, a string", ("add", "fill", "widen"), "a: stored int, offered string"),
    ("id int, a array<int>", ("add", "fill", "widen"), "a: stored int, offered array<int>"),
])
def test_what_does_not_fit_is_refused_ahead_of_any_write(spark, place, ddl, ways, said):
    write_table(rows(spark, "id int, a int", (1, 2)), place, "t")
    before = place.read(spark, "t").inputFiles()
    with pytest.raises(SchemaMismatch, match=said.replace("<", r"\<")):
        write_table(spark.createDataFrame([], ddl), place, "t", "append", evolve=ways)
    assert place.read(spark, "t").inputFiles() == before and held(place, spark) == [(1, 2)]
    assert read_record(spark, place.name("t")).version == 1


def test_doubled_names_and_unknown_ways(spark):
    schema = T.StructType([T.StructField("a", T.LongType())])
    with pytest.raises(SchemaMismatch, match="2 columns"):
        fitted(spark.range(1).selectExpr("id as a", "id as A"), schema)
    with pytest.raises(ValueError, match="ways to evolve"):
        fitted(spark.range(1), schema, ("bend",))


def test_a_slice_written_again_replaces_itself_alone(spark, place):
    table = rows(spark, "id int, part string", (1, "01"), (2, "01"), (3, "2"), (4, None))
    write_table(table, place, "t", partition_by=["part"])
    slice_ = rows(spark, "id int, part string, note string", (7, "01", "new"))
    for _ in range(2):
        write_table(slice_, place, "t", "slices", evolve=("add",))
    assert held(place, spark) == [(3, None, "2"), (4, None, None), (7, "new", "01")]
    with pytest.raises(SchemaMismatch, match="partitioned by"):
        write_table(slice_, place, "t", "append", ["id"])
    with pytest.raises(SchemaMismatch, match="wider|stored string"):
        write_table(slice_.withColumn("part", F.lit(1)), place, "t", "append", evolve=("widen",))
    write_table(rows(spark, "id int", (1,)), place, "plain")
    with pytest.raises(ValueError, match="the table has none"):
        write_table(rows(spark, "id int", (1,)), place, "plain", "slices")


def test_an_overwrite_begins_a_new_record(spark, place):
    write_table(rows(spark, "id int", (1,)), place, "t")
    write_table(rows(spark, "id bigint", (2,)), place, "t", "append", evolve=("widen",))
    assert read_record(spark, place.name("t")).version == 2
    write_table(rows(spark, "name string", ("x",)), place, "t")
    assert read_record(spark, place.name("t")).version == 1 and held(place, spark) == [("x",)]
    write_table(rows(spark, "name string", ("x",)), place, "t", "append")
    assert held(place, spark) == [("x",), ("x",)]


def test_of_two_writers_of_one_version_the_second_raises(spark, place):
    write_table(rows(spark, "id int", (1,)), place, "t")
    with pytest.raises(ConcurrentChange):
        write_record(spark, place.name("t"), Record(spark.range(1).schema))
    assert held(place, spark) == [(1,)]


def test_files_without_a_record_can_be_appended_to(spark, place):
    spark.range(2).selectExpr("cast(id as int) id").write.parquet(place.name("t"))
    write_table(rows(spark, "id bigint", (2 ** 40,)), place, "t", "append", evolve=("widen",))
    assert held(place, spark) == [(0,), (1,), (2 ** 40,)]


def test_a_catalog_table_takes_columns_and_slices(spark):
    place = Location(schema="evolve_here")
    place.ensure(spark)
    try:
        write_table(rows(spark, "id int, part int", (1, 1), (2, 2)), place, "t", partition_by=["part"])
        newer = rows(spark, "part int, id int, note string", (1, 9, "n"))
        write_table(newer, place, "t", "slices", evolve=("add",))
        write_table(newer, place, "t", "append")
        assert sorted((r.id, r.part, r.note) for r in place.read(spark, "t").collect()) == [
            (2, 2, None), (9, 1, "n"), (9, 1, "n")]
        with pytest.raises(ValueError, match="can't widen"):
            write_table(rows(spark, "id bigint, part int, note string", (1, 1, "x")), place, "t", "append",
                        evolve=("widen",))
        with pytest.raises(SchemaMismatch):
            write_table(rows(spark, "id string, part int, note string", ("1", 1, "x")), place, "t", "append")
    finally:
        spark.sql("DROP SCHEMA evolve_here CASCADE")
