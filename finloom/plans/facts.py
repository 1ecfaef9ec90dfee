"""Fact tables as column specs. Names, shapes, ranges and weights are fixed values of the data model.

Every reference is a bounded draw into the parent's dense key, so a fact of any
size is a single narrow stage: no join, broadcast or shuffle keeps it sound.
"""

from __future__ import annotations

from finloom.plans.dimensions import source_code
from finloom.plans.specs import (
    Amount, CodeOf, Day, DenseKey, NumberOf, PaddedId, Period, Pick, Ref, TableSpec, Template, TextRef, Whole,
    YearOf, audit_users, words,
)
from finloom.sources import values as v

MONEY = (-2_000_000, 5_000_000)


def ledger_amount(name: str, low: int = MONEY[0], high: int = MONEY[1]) -> Amount:
    return Amount(name, low, high)


def statement_amount(name: str, low: int = -1_000_000, high: int = 5_000_000) -> Amount:
    return Amount(name, low, high, 18, 5)


def functional_area_code(draws_as: str | None = None, declared: bool = True) -> TextRef:
    return TextRef("functional_area_cd", "functional_area", "FA", 4, draws_as=draws_as, declared=declared)


def profit_center_number(name: str = "profit_center_nbr", draws_as: str | None = None,
                         declared: bool = True) -> TextRef:
    return TextRef(name, "profit_center", "PC", 6, draws_as=draws_as, declared=declared)


GENERAL_LEDGER = TableSpec("general_ledger_fact", ("general_ledger_fact_id",), (
    DenseKey("general_ledger_fact_id"),
    Period("fiscal_year_period_nbr"),
    Ref("profit_center_id", "profit_center"),
    Ref("division_id", "division_text"),
    Ref("version_forecast_mapping_id", "version_forecast_mapping"),
    Ref("functional_area_id", "functional_area"),
    Ref("accounting_document_type_id", "accounting_document_type"),
    Ref("product_id", "finance_product_dim_v"),
    Ref("customer_id", "finance_customer_dim_v"),
    Ref("company_id", "company_code"),
    Ref("copa_attribution_id", "copa_attribution_dim"),
    TextRef("cost_center_nbr", "cost_center_dim_v", "CC", 6, counter="__cost_center_nbr_fk_id"),
    Ref("geo_wholesale_value_business_id", "geo_wholesale_value_business_dim"),
    Ref("geo_marketplace_channel_id", "geo_marketplace_channel_dim"),
    TextRef("gl_account_nbr", "gl_account_dim", "GL", 6, counter="__gl_account_nbr_fk_id"),
    Ref("zfsm_measure_id", "gl_account_zfsm_measures_hierarchy_dim", declared=False),
    Ref("etm_foreign_currency_exchange_rate_id", "finance_foreign_currency_exchange_rate", declared=False),
    Ref("gaap_foreign_currency_exchange_rate_id", "finance_foreign_currency_exchange_rate", declared=False),
    ledger_amount("company_currency_amt"),
    ledger_amount("transaction_currency_amt"),
    ledger_amount("performance_management_currency_amt"),
    Pick("etm_ind", (0, 1), (85, 15), type="int"),
    ledger_amount("sales_qty", 0, 100_000),
    ledger_amount("returns_qty", 0, 10_000),
    Pick("general_ledger_fact_ind", v.YES_NO, (90, 10)),
    Pick("cis_delta_ind", v.YES_NO_BLANK, (10, 5, 85)),
    Pick("general_ledger_ocogs_allocation_fact_ind", v.YES_NO_BLANK, (15, 5, 80)),
    Pick("anaplan_corporate_ind", v.YES_NO_BLANK, (20, 10, 70)),
    Pick("company_currency_cd", v.CURRENCIES[:8], (35, 20, 10, 8, 10, 5, 7, 5)),
    Pick("transaction_currency_cd", v.CURRENCIES[:10], (30, 18, 8, 7, 8, 4, 6, 5, 7, 7)),
    functional_area_code(draws_as="functional_area_id", declared=False),
    CodeOf("accounting_document_type_cd", tuple(v.DOCUMENT_TYPES), "accounting_document_type_id",
           "accounting_document_type"),
    profit_center_number(draws_as="profit_center_id", declared=False),
    PaddedId("company_cd", "company_code", 4, key="company_id"),
))

INCOME_STATEMENT = TableSpec("cis_fact", ("gl_account_id",), (
    DenseKey("gl_account_id"),
    profit_center_number(draws_as="profit_center_id"),
    Period("fiscal_year_period_nbr"),
    YearOf("fiscal_yr", "fiscal_year_period_nbr"),
    statement_amount("transaction_currency_amt"),
    functional_area_code(),
    Ref("profit_center_id", "profit_center"),
    NumberOf("division_nbr", "division_text"),
    Pick("segment_nbr", v.SEGMENT_NUMBERS[:6], type="int"),
    Pick("partner_segment_nbr", v.SEGMENT_NUMBERS[:6], type="int", null_rate=0.3),
    Template("document_type_cd", "rr"),
    Whole("original_company_cd", 1000, 9999),
    statement_amount("sign_adjusted_group_currency_amt"),
    statement_amount("sign_adjusted_local_currency_amt"),
    statement_amount("sign_adjusted_transaction_currency_amt"),
    statement_amount("group_currency_amt"),
    statement_amount("local_currency_amt"),
    statement_amount("qty", 0, 50_000),
    Ref("consolidated_income_statement_fact_id", "cis_fact", declared=False),
    Template("financial_statement_item_cd", "rrrrddd"),
    Pick("local_currency_cd", v.CURRENCIES[:7], (35, 20, 10, 8, 10, 7, 10)),
    Pick("transaction_currency_cd", v.CURRENCIES[:5], (35, 25, 15, 13, 12)),
    Pick("version_nbr", v.FACT_VERSIONS, (20, 20, 20, 20, 20)),
    profit_center_number("partner_profit_center_nbr"),
    Template("partner_unit_cd", "rrd", null_rate=0.4),
    Whole("consolidation_unit_cd", 1000, 9999),
    Pick("ledger_cd", v.LEDGERS, (35, 25, 20, 10, 10)),
    Template("dimension_cd", "rrd"),
    Pick("record_type_cd", v.RECORD_TYPE_CODES, (50, 25, 15, 10)),
    Template("consolidation_group_cd", "rrrrd"),
    Whole("consolidation_of_investment_activity_nbr", 0, 9),
    Pick("chart_of_accounts_cd", v.CHARTS_OF_ACCOUNTS, (40, 20, 25, 15)),
    Whole("trading_partner_nbr", 1000, 9999, null_rate=0.5),
    Template("region_summary_product_group_cd", "rrd"),
    Pick("version_group_nm", v.VERSION_GROUPS[:4], (40, 20, 25, 15)),
    words("consolidated_segment_nm", 7, 6),
    statement_amount("sign_adjusted_qty", -50_000, 50_000),
    Template("user_nm", "rrrrrrrr.rrrrrrr"),
    words("additional_operation_information_nm", 10, 6, null_rate=0.5),
    *audit_users(),
    source_code(),
    Template("cis_store_cd", "dddddd", null_rate=0.5),
    Pick("posting_level_cd", v.POSTING_LEVELS, (50, 25, 15, 10)),
    Template("base_unit_of_measure_cd", "rrr"),
    Pick("foreign_exchange_type_cd", v.EXCHANGE_RATE_TYPES, (30, 20, 20, 15, 15)),
    Pick("consolidated_channel_nm", v.CONSOLIDATED_CHANNELS, (30, 30, 25, 15)),
))

BALANCE_SHEET = TableSpec("consolidated_balance_sheet_fact", ("consolidated_balance_sheet_fact_id",), (
    DenseKey("consolidated_balance_sheet_fact_id"),
    Template("financial_statement_item_cd", "rrrrddd"),
    profit_center_number(),
    functional_area_code(),
    Pick("local_currency_cd", v.CURRENCIES[:5], (35, 25, 15, 13, 12)),
    Pick("transaction_currency_cd", v.CURRENCIES[:5], (35, 25, 15, 13, 12)),
    Pick("version_nbr", v.FACT_VERSIONS, (20, 20, 20, 20, 20)),
    NumberOf("division_nbr", "division_text"),
    Period("fiscal_year_period_nbr"),
    Template("partner_unit_cd", "rrd", null_rate=0.4),
    Pick("posting_level_cd", v.POSTING_LEVELS, (50, 25, 15, 10)),
    Template("document_type_cd", "rr"),
    Whole("consolidation_unit_cd", 1000, 9999),
    profit_center_number("partner_profit_center_nbr"),
    Whole("trading_partner_nbr", 1000, 9999, null_rate=0.5),
    Template("region_summary_product_group_cd", "rrd"),
    statement_amount("transaction_currency_amt"),
    statement_amount("local_currency_amt"),
    statement_amount("group_currency_amt"),
    Pick("partner_segment_nbr", v.SEGMENT_NUMBERS[:5], type="int", null_rate=0.3),
    Template("segment_nbr", "dddd"),
    statement_amount("qty", 0, 50_000),
    words("consolidated_segment_nm", 7, 6),
    Pick("consolidated_channel_nm", v.CONSOLIDATED_CHANNELS, (30, 30, 25, 15)),
    YearOf("fiscal_yr", "fiscal_year_period_nbr"),
    Pick("version_group_nm", v.VERSION_GROUPS[:4], (40, 20, 25, 15)),
    Template("user_nm", "rrrrrrrr.rrrrrrr"),
    words("additional_operation_information_nm", 10, 6, null_rate=0.5),
    *audit_users(),
    source_code(),
    Day("_acdocu_latest_load_timestamp", "2023-01-01", "2025-12-31"),
    Pick("group_currency_cd", v.CURRENCIES[:2], (80, 20)),
    statement_amount("ending_balance_amt"),
    Pick("foreign_exchange_type_cd", v.EXCHANGE_RATE_TYPES, (30, 20, 20, 15, 15)),
))

FACTS = (GENERAL_LEDGER, INCOME_STATEMENT, BALANCE_SHEET)
