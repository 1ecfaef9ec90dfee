"""The catalogue against the declared shapes, and the plans it produces."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from finloom.plans.dataset import (
    CURRENT_TABLES, RETIRED_TABLES, contract_of, dependencies, plan, referenced_column,
)
from finloom.plans.specs import Options
from finloom.plans.tables import TABLES, build_table, find, table_names
from finloom.sources.volumes import Volumes

SIZES = {name: 40 for name in table_names()} | {"division_text": 20, "division_text_dim_v": 20,
                                                "calendar_fiscal_period_v": 24}

# Columns per table by type.
SHAPES = {
    "calendar_fiscal_period_v": {"int": 16, "string": 15, "date": 8},
    "company_code": {"string": 6, "bigint": 1},
    "segment_cost_center_hierarchy_dim_v": {"string": 63, "bigint": 1},
    "segment_profit_center_hierarchy": {"string": 20, "bigint": 1},
    "version_forecast_mapping": {"string": 3, "bigint": 1},
    "copa_attribution_dim": {"string": 27, "bigint": 1},
    "cost_center_dim_v": {"string": 50, "date": 6, "bigint": 1},
    "dischannel_cost_center_hierarchy_dim_v": {"string": 63, "bigint": 1},
    "dischannel_profit_center_hierarchy": {"string": 21, "bigint": 1},
    "division_text_dim_v": {"string": 3, "bigint": 1},
    "finance_customer_dim_v": {"string": 16, "bigint": 1},
    "finance_foreign_currency_exchange_rate": {"string": 7, "bigint": 1, "decimal(38,18)": 1},
    "finance_product_dim_v": {"string": 31, "bigint": 1},
    "general_ledger_fact": {"bigint": 17, "string": 12, "decimal(28,5)": 5, "int": 2},
    "geo_marketplace_channel_dim": {"string": 5, "bigint": 1},
    "geo_wholesale_value_business_dim": {"string": 4, "bigint": 1},
    "gl_account_dim": {"string": 5, "date": 2, "bigint": 1},
    "gl_account_zfsm_measures_hierarchy_dim": {"string": 32, "date": 2, "bigint": 1},
    "profit_center": {"string": 9, "date": 2, "bigint": 1, "int": 1},
    "accounting_document_type": {"string": 5, "bigint": 1},
    "atscale_geo_security": {"string": 2},
    "cis_fact": {"string": 28, "int": 8, "decimal(18,5)": 8, "bigint": 3},
    "consolidated_balance_sheet_fact": {"string": 23, "int": 5, "decimal(18,5)": 5, "bigint": 1, "date": 1},
    "consolidation_functional_area_hierarchy": {"string": 23, "date": 3, "bigint": 1, "int": 1},
    "consolidation_segment_hierarchy_dim": {"string": 40, "int": 2, "bigint": 1},
    "division_text": {"string": 11, "date": 3, "bigint": 1},
    "functional_area": {"string": 3, "bigint": 1},
    "gl_account_hierarchy": {"string": 94, "int": 4, "date": 3, "bigint": 2},
    "management_gl_account_hierarchy": {"string": 95, "int": 4, "bigint": 1},
    "partdischannel_profit_center_hierarchy": {"string": 21, "bigint": 1},
    # Ten store columns are dates here though declared as text elsewhere.
    "retail_global_store_profile_v": {"string": 112, "int": 10, "float": 3, "date": 11},
}


def rows_for(name):
    return SIZES[name]


def test_catalogue_holds_all_tables():
    assert sorted(table_names()) == sorted(SHAPES)
    assert len(CURRENT_TABLES) + len(RETIRED_TABLES) == 31


@pytest.mark.parametrize("name", sorted(SHAPES))
def test_table_shape_plan_and_key(spark, name):
    frame = build_table(spark, name, rows_for(name), 2, SIZES)
    assert Counter(f.dataType.simpleString() for f in frame.schema.fields) == SHAPES[name]
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    contract = contract_of(name, spark)
    assert [(f.name, f.dataType.simpleString()) for f in frame.schema.fields] == [
        (c.name, c.type) for c in contract.columns]
    if contract.key:
        assert frame.select(*contract.key).distinct().count() == rows_for(name)


def test_ledger_relations_resolve(spark):
    fact = build_table(spark, "general_ledger_fact", 3000, 4, SIZES)
    relations = contract_of("general_ledger_fact").relations
    assert len(relations) == 14
    for relation in relations:
        parent = build_table(spark, relation.ref_table, rows_for(relation.ref_table), 1, SIZES)
        assert fact.join(parent, fact[relation.column] == parent[relation.ref_column], "left_anti").isEmpty()


def test_codes_on_the_fact_join_their_dimension(spark):
    fact = build_table(spark, "general_ledger_fact", 2000, 4, SIZES)
    company = build_table(spark, "company_code", 40, 1, SIZES)
    joined = fact.join(company, "company_cd")
    assert joined.count() == 2000 and joined.where(fact.company_id != company.company_id).isEmpty()
    document = build_table(spark, "accounting_document_type", 40, 1, SIZES)
    joined = fact.join(document, "accounting_document_type_id")
    assert joined.where(fact.accounting_document_type_cd != document.accounting_document_type_cd).isEmpty()


def test_linked_codes_become_references(spark):
    parents = build_table(spark, "profit_center", 40, 1, SIZES)
    linked = build_table(spark, "cost_center_dim_v", 40, 1, SIZES, options=Options(link_codes=True))
    free = build_table(spark, "cost_center_dim_v", 40, 1, SIZES)
    assert linked.join(parents, "profit_center_nbr", "left_anti").isEmpty()
    assert free.join(parents, "profit_center_nbr", "left_anti").count() > 30


def test_seed_tables_refuse_more_rows(spark):
    for name, most in (("division_text", 20), ("division_text_dim_v", 20), ("atscale_geo_security", 80)):
        assert build_table(spark, name, most, 1).distinct().count() == most
        with pytest.raises(ValueError):
            build_table(spark, name, most + 1, 1)


def test_unknown_table_raises(spark):
    with pytest.raises(KeyError):
        build_table(spark, "nothing", 1)
    with pytest.raises(KeyError):
        plan(spark, Volumes(), ["nothing"])


def test_partial_hierarchy_keys_are_a_prefix_of_the_dimension(spark):
    sizes = SIZES | {"cost_center_dim_v": 2_000_000}
    part = build_table(spark, "segment_cost_center_hierarchy_dim_v", 30, 1, sizes, columns=["cost_center_nbr"])
    assert part.first().cost_center_nbr == "CC_0000001"


def test_referenced_column_and_dependencies():
    assert referenced_column("cost_center_nbr", "cost_center_dim_v") == "cost_center_nbr"
    assert referenced_column("customer_id", "finance_customer_dim_v") == "finance_customer_id"
    assert "calendar_fiscal_period_v" in dependencies("general_ledger_fact")
    assert dependencies("calendar_fiscal_period_v") == []
    assert find("CIS_fact") is TABLES["cis_fact"]


@pytest.mark.parametrize("name", ["no_such_column", "company_code.no_such_column", "no_such_table.company_cd"])
def test_domains_for_columns_that_no_table_has_are_refused(spark, name):
    with pytest.raises(KeyError, match=name):
        build_table(spark, "company_code", 5, domains={name: {"values": ["x"]}})


def test_one_set_of_domains_serves_several_tables(spark):
    domains = {"currency_cd": {"values": ["USD"]}, "general_ledger_fact.sales_qty": {"min": 1, "max": 2}}
    assert build_table(spark, "company_code", 5, domains=domains).count() == 5


def test_given_ids_are_dealt_by_the_cells_they_become(spark):
    from finloom.sources.rows import dealt, partitions_for

    ids = spark.range(1, 60_001).coalesce(1).withColumnRenamed("id", "__row_id")
    cores = spark.sparkContext.defaultParallelism
    assert partitions_for(60_000, 136, cores) == min(cores, 9)
    wide = dealt(ids, 60_000, 136)
    sizes = [r["count"] for r in wide.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == min(cores, 9) and sum(sizes) == 60_000 and max(sizes) < 2 * min(sizes)
    assert dealt(ids, 60_000, 10) is ids and wide.distinct().count() == 60_000
