import json
from types import SimpleNamespace

import pytest
from pyspark.sql import types as T

from finloom.operators import checks
from finloom.operators.writer import session_settings, tune_session, write_table
from finloom.plans.specs import Options
from finloom.plans.dataset import CURRENT_TABLES, build_dataset, plan, verify_dataset
from finloom.plans.tables import table_names
from finloom.sources.contract import Contract, base_type, read_contracts, spark_type
from finloom.sources.domains import read_domains
from finloom.sources.location import Location, shared_folder
from finloom.sources.volumes import DEFAULT_VOLUMES, Volumes

SMALL = {name: 60 for name in DEFAULT_VOLUMES} | {
    "calendar_fiscal_period_v": 24, "division_text": 20, "division_text_dim_v": 20, "atscale_geo_security": 80,
    "general_ledger_fact": {"rows": 3000, "partitions": 3, "shuffle_partitions": 4},
    "cis_fact": 500, "consolidated_balance_sheet_fact": 500,
    "segment_profit_center_hierarchy": 24, "segment_cost_center_hierarchy_dim_v": 30}


def test_full_dataset_is_sound(spark, tmp_path):
    place = Location(path=str(tmp_path / "star"))
    written = build_dataset(spark, place, SMALL, tables=table_names())
    assert sorted(written) == sorted(table_names())
    report = verify_dataset(spark, place, sample_rows=1000)
    checks.require_ok(report)
    assert report.where("status like 'sampled 1/%'").count() == 14
    assert report.where("family = 'natural_key'").count() == 8
    assert report.where("family = 'foreign_key'").count() == 14
    assert report.where("family = 'key'").count() == 30
    sampled = report.where("table_name = 'general_ledger_fact' and family = 'foreign_key'").first()
    assert 800 < sampled.row_count < 1200


def test_verify_skips_absent_tables_and_checks_every_row(spark, tmp_path):
    place = Location(path=str(tmp_path / "part"))
    build_dataset(spark, place, SMALL, tables=["general_ledger_fact", "profit_center"])
    report = verify_dataset(spark, place)
    assert {(r.column_name, r.row_count) for r in
            report.where("family = 'foreign_key' and status <> 'skipped'").collect()} == {("profit_center_id", 3000)}
    with pytest.raises(checks.IntegrityError, match="skipped"):
        checks.require_ok(report)
    checks.require_ok(report, skipped_ok=True)
    build_dataset(spark, place, SMALL, tables=["profit_center"], overrides={"profit_center": {"rows": 30}})
    with pytest.raises(checks.IntegrityError, match="profit_center_id"):
        checks.require_ok(verify_dataset(spark, place), skipped_ok=True)


def test_rebuild_gives_the_same_rows_for_other_partitions(spark, tmp_path):
    one, two = Location(path=str(tmp_path / "a")), Location(path=str(tmp_path / "b"))
    build_dataset(spark, one, SMALL, tables=["general_ledger_fact"])
    build_dataset(spark, two, SMALL, tables=["general_ledger_fact"],
                  overrides={"general_ledger_fact": {"partitions": 11}})
    left, right = one.read(spark, "general_ledger_fact"), two.read(spark, "general_ledger_fact")
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_dependencies_come_along_when_asked(spark, tmp_path):
    volumes = Volumes(SMALL)
    alone = [step.table for step in plan(spark, volumes, ["general_ledger_fact"])]
    full = [step.table for step in plan(spark, volumes, ["general_ledger_fact"], with_dependencies=True)]
    assert alone == ["general_ledger_fact"]
    assert full[-1] == "general_ledger_fact" and len(full) == 17
    assert [step.table for step in plan(spark, volumes)] == list(CURRENT_TABLES)


def test_overrides_hold_for_one_run_and_unknown_names_raise(spark):
    volumes = Volumes(SMALL)
    changed = volumes.with_overrides({"company_code": {"rows": 7}}, table_names())
    assert changed.rows("company_code") == 7 and volumes.rows("company_code") == 60
    with pytest.raises(KeyError):
        volumes.with_overrides({"nothing": {"rows": 1}}, table_names())
    with pytest.raises(ValueError):
        volumes.with_overrides({"company_code": {"row": 1}}, table_names())
    with pytest.raises(ValueError):
        Volumes({"company_code": {"size": 1}})


def test_sizes_that_a_table_cannot_hold_raise(spark, tmp_path):
    place = Location(path=str(tmp_path / "x"))
    for name in ("calendar_fiscal_period_v", "division_text"):
        with pytest.raises(ValueError):
            build_dataset(spark, place, {name: 500}, tables=[name])
    build_dataset(spark, place, {"calendar_fiscal_period_v": 500}, tables=["calendar_fiscal_period_v"],
                  options=Options(start_year=1990, years=50))
    periods = place.read(spark, "calendar_fiscal_period_v")
    assert periods.count() == 500 and periods.agg({"fiscal_year_period_nbr": "min"}).first()[0] == 199001


def test_volume_defaults():
    volumes = Volumes({"calendar_fiscal_period_v": 384, "division_text": 500, "general_ledger_fact": 2_000_000_000})
    assert volumes.domain_sizes() == {"calendar_fiscal_period_v": 384, "division_text": 500,
                                      "general_ledger_fact": 2_000_000_000}
    assert Volumes({}).domain_sizes() == {} and Volumes({}).with_overrides({}, []).domain_sizes() == {}
    assert Volumes().rows("general_ledger_fact") == 2_000_000_000
    assert volumes.partitions("general_ledger_fact") is None
    assert Volumes({"company_code": {"rows": 5, "partitions": 3}}).partitions("company_code") == 3
    assert volumes.rows("company_code") == 1000 and volumes.shuffle_partitions() == 400
    assert not volumes.declares("company_code")


def test_partitioned_append_and_skip_existing(spark, tmp_path):
    place = Location(path=str(tmp_path / "p"))
    by_period = {"general_ledger_fact": ["fiscal_year_period_nbr"]}
    build_dataset(spark, place, SMALL, ["general_ledger_fact"], partition_by=by_period)
    folders = list((tmp_path / "p" / "general_ledger_fact").glob("fiscal_year_period_nbr=*"))
    assert len(folders) == 24
    assert build_dataset(spark, place, SMALL, ["general_ledger_fact", "company_code"], skip_existing=True) == ["company_code"]
    build_dataset(spark, place, SMALL, ["company_code"], mode="append")
    assert place.read(spark, "company_code").count() == 120
    with pytest.raises(ValueError):
        write_table(spark.range(1), place, "x", mode="replace")


def test_partitioned_write_keeps_a_hot_value_whole_and_in_few_files(spark, tmp_path):
    place = Location(path=str(tmp_path / "hot"))
    df = spark.range(60_000).selectExpr("id", "if(id % 3 = 0, 0, id % 20) as part")
    with session_settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}):
        write_table(df, place, "t", partition_by=["part"])
    assert place.read(spark, "t").groupBy("part").count().where("part = 0").first()["count"] == df.where("part = 0").count()


def test_catalog_schema_location(spark):
    place = Location(schema="finloom_test")
    build_dataset(spark, place, SMALL, ["company_code"])
    assert place.exists(spark, "company_code") and not place.exists(spark, "profit_center")
    assert place.read(spark, "company_code").count() == 60
    build_dataset(spark, place, SMALL, ["company_code"], overrides={"company_code": {"rows": 9}})
    assert place.read(spark, "company_code").count() == 9
    spark.sql("DROP SCHEMA finloom_test CASCADE")


def test_location_is_either_path_or_schema():
    with pytest.raises(ValueError):
        Location()
    with pytest.raises(ValueError):
        Location(path="a", schema="b")


def session_like(master, **settings):
    return SimpleNamespace(conf=SimpleNamespace(get=settings.get), sparkContext=SimpleNamespace(master=master))


def test_shared_folder_follows_the_session():
    cluster = session_like("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://shared/"})
    place = shared_folder(cluster, "x")
    assert place.path.startswith("hdfs://shared/finloom-x-") and place.path != shared_folder(cluster, "x").path
    assert shared_folder(session_like("local[2]"), "x").path.startswith("/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session_like("spark://host:7077"), "x")


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session_settings(spark, {"spark.sql.shuffle.partitions": "3"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    tune_session(spark, 8)


def test_domains_and_volumes_from_files(spark, tmp_path):
    path = tmp_path / "domains.json"
    path.write_text(json.dumps({"domains": {"currency_cd": {"values": ["AAA"]}, "qty": {"min": 0, "max": 1}}}))
    domains = read_domains(str(path))
    assert domains["currency_cd"].values == ("AAA",) and domains["qty"].high == 1
    place = Location(path=str(tmp_path / "d"))
    build_dataset(spark, place, SMALL, ["company_code"], domains=str(path))
    assert {r.currency_cd for r in place.read(spark, "company_code").select("currency_cd").distinct().collect()} == {"AAA"}
    volumes = tmp_path / "volumes.json"
    volumes.write_text(json.dumps({"environment": {"schema": "x"}, "company_code": {"rows": 5}}))
    assert Volumes(str(volumes)).rows("company_code") == 5
    with pytest.raises(ValueError):
        read_domains({"broken": {"min": 1}})


@pytest.mark.parametrize("declared,wanted", [
    ("bigint", T.LongType()), ("LONG ", T.LongType()), ("int", T.IntegerType()), ("decimal", T.DecimalType(18, 5)),
    ("decimal(28)", T.DecimalType(28, 5)), ("decimal(38,18)", T.DecimalType(38, 18)), ("varchar(255)", T.StringType()),
    ("timestamp", T.StringType()), ("date", T.DateType()), ("boolean", T.BooleanType()), ("float", T.FloatType())])
def test_declared_types(declared, wanted):
    assert spark_type(declared) == wanted


def test_contract_file(tmp_path):
    path = tmp_path / "contract.yaml"
    path.write_text("""
tables:
  - name: fact
    columns:
      - {name: id, data_type: bigint, constraints: [primary_key, not_null]}
      - {name: cc, data_type: varchar(255)}
    relationships:
      - {column: cc, references: {table: dim, column: cc_nbr}}
""")
    contract = read_contracts(str(path))["fact"]
    assert isinstance(contract, Contract) and contract.key == ("id",)
    assert contract.foreign_keys == {"cc": ("dim", "cc_nbr")}
    assert contract.schema().fields[0].nullable is False
    assert base_type("varchar(255)") == "string" and base_type("decimal(1,1)") == "decimal"
    with pytest.raises(KeyError):
        contract.column("nope")
