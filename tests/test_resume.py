"""A dataset job that is stopped, gone on with, and refused when its plan has changed; jobs over given rows."""

import pytest
from pyspark.sql import functions as F

from finloom.plans.dataset import PlanChanged, build_dataset, ids_digest
from finloom.plans.specs import Options
from finloom.plans.tables import ROW_ID, build_table, table_names
from finloom.sources.location import Location
from finloom.sources.volumes import Volumes

TABLES = ["company_code", "profit_center", "general_ledger_fact"]
VOLUMES = Volumes({name: 50 for name in table_names() if not name.startswith(("calendar", "division", "atscale"))}
                  | {"general_ledger_fact": 200, "calendar_fiscal_period_v": 24, "division_text": 20})


def ids(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], f"{ROW_ID} bigint")


@pytest.fixture
def place(tmp_path):
    return Location(path=str(tmp_path))


def run(spark, place, **more):
    return build_dataset(spark, place, VOLUMES, TABLES, **more)


def test_a_stopped_job_goes_on(spark, place, monkeypatch):
    from finloom.plans import dataset

    real, calls = dataset.write_table, []

    def stops(df, location, table, *rest, **more):
        calls.append(table)
        if len(calls) == 2:
            df.limit(3).write.parquet(location.name(table))  # begun, not finished
            raise KeyboardInterrupt
        real(df, location, table, *rest, **more)

    monkeypatch.setattr(dataset, "write_table", stops)
    with pytest.raises(KeyboardInterrupt):
        run(spark, place)
    monkeypatch.undo()
    assert run(spark, place, resume=True) == [t for t in ("profit_center", "company_code", "general_ledger_fact")
                                              if t != calls[0]]
    assert place.read(spark, calls[1]).count() == 50
    assert run(spark, place, resume=True) == []
    assert run(spark, place, resume=True, overrides={"general_ledger_fact": {"partitions": 3}}) == []
    assert len(run(spark, place)) == 3


@pytest.mark.parametrize(("change", "said"), [
    ({"seed": 7}, "seed was 42, is 7"), ({"overrides": {"company_code": {"rows": 9}}}, "company_code: rows was 50, is 9"),
    ({"options": Options(ragged=True)}, "options"), ({"domains": {"currency_cd": {"values": ["USD"]}}}, "domains"),
    ({"partition_by": {"general_ledger_fact": ["fiscal_year_period_nbr"]}}, "partition_by"),
])
def test_a_changed_plan_is_refused_ahead_of_any_write(spark, place, change, said):
    run(spark, place)
    files = {t: place.read(spark, t).inputFiles() for t in TABLES}
    with pytest.raises(PlanChanged, match=said):
        run(spark, place, resume=True, **change)
    assert files == {t: place.read(spark, t).inputFiles() for t in TABLES}


def test_given_rows_are_built_and_told_apart(spark, place):
    some = ids(spark, 3, 50, 7)
    build_dataset(spark, place, VOLUMES, ["company_code"], sources={"company_code": some}, resume=True)
    whole = build_table(spark, "company_code", 50, None, VOLUMES.domain_sizes())
    assert sorted(place.read(spark, "company_code").collect()) == sorted(
        whole.where(F.col("company_id").isin(3, 7, 50)).collect())
    same = ids(spark, 7, 3, 50).repartition(3)
    assert ids_digest(same) == ids_digest(some)
    assert build_dataset(spark, place, VOLUMES, ["company_code"], sources={"company_code": same}, resume=True) == []
    with pytest.raises(PlanChanged, match="source was"):
        build_dataset(spark, place, VOLUMES, ["company_code"], resume=True)
    with pytest.raises(KeyError, match="no row ids"):
        build_dataset(spark, place, VOLUMES, ["company_code"], sources={"calendar_fiscal_period_v": some})


def test_appends_cannot_be_resumed(spark, place):
    with pytest.raises(ValueError, match="come twice"):
        run(spark, place, mode="append", resume=True)


def test_manifests_in_a_catalog(spark):
    place = Location(schema="resume_here")
    try:
        build_dataset(spark, place, VOLUMES, ["company_code"], domains={"currency_cd": {"values": ["it's", "a\\b"]}})
        same = {"domains": {"currency_cd": {"values": ["it's", "a\\b"]}}}
        assert build_dataset(spark, place, VOLUMES, ["company_code"], resume=True, **same) == []
        with pytest.raises(PlanChanged):
            build_dataset(spark, place, VOLUMES, ["company_code"], resume=True, seed=1, **same)
    finally:
        spark.sql("DROP SCHEMA resume_here CASCADE")


def test_a_partitioned_build_moves_ids_alone(spark, place):
    import re

    from finloom.plans.dataset import plan

    by = ["fiscal_year_period_nbr"]
    (step,) = plan(spark, VOLUMES, ["general_ledger_fact"])
    text = step.build(by)._jdf.queryExecution().optimizedPlan().toString()
    below = text[text.index("RebalancePartitions"):].splitlines()
    moved = re.search(r"Project \[(.*)\]", below[1]).group(1)
    assert len(re.findall(r" AS ", moved)) == 2, below[1]
    whole = build_table(spark, "general_ledger_fact", 200, None, VOLUMES.domain_sizes())
    build_dataset(spark, place, VOLUMES, ["general_ledger_fact"], partition_by={"general_ledger_fact": by})
    found = place.read(spark, "general_ledger_fact")
    assert place.partitioning(spark, "general_ledger_fact") == tuple(by)
    assert found.select(*whole.columns).exceptAll(whole).isEmpty() and found.count() == 200


def test_the_environment_names_place_and_mode(spark, tmp_path):
    volumes = Volumes({"environment": {"path": str(tmp_path), "write_mode": "append"}, "company_code": 5})
    for n in (5, 10):
        assert build_dataset(spark, None, volumes, ["company_code"]) == ["company_code"]
        assert volumes.place().read(spark, "company_code").count() == n
    build_dataset(spark, None, volumes, ["company_code"], mode="overwrite", overrides={"company_code": {"rows": 3}})
    assert volumes.place().read(spark, "company_code").count() == 3
    assert Volumes({"environment": {"catalog": "c", "schema": "s"}}).place() == Location(schema="c.s")
    with pytest.raises(ValueError, match="give a location"):
        build_dataset(spark, None, {"company_code": 5}, ["company_code"])
    for wrong in ({"catalog": "c"}, {"path": "p", "schema": "s"}, {"plaec": "p"}):
        with pytest.raises(ValueError, match="environment"):
            Volumes({"environment": wrong}).place()
