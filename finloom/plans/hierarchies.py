"""Hierarchy, security, rate and store tables as column specs (fixed values of the data model).

Partial hierarchies hold a prefix of their dimension's keys: having fewer rows
than the dimension is what makes the downstream inner joins filter.
"""

from __future__ import annotations

from finloom.plans.dimensions import controlling_area, source_code
from finloom.plans.specs import (
    Amount, Cycle, Day, DenseKey, FreeCode, Pick, Real, Ref, TableSpec, Template, TextKey, Whole,
    audit_users, flag, level_family, words,
)
from finloom.sources import values as v

CODE = "rrddd"
NAME = "rrrrrrr rrrrrr"
ACCOUNT_CODE = "dddddd"
ACCOUNT_NAME = "rrrrrrrrrr rrrrrrrr"


def record_days() -> tuple[Day, Day]:
    return Day("record_created_tmst_utc"), Day("record_update_tmst_utc")


def profit_center_levels():
    return level_family("profit_center_level", 9, 3, 0.15, cd=CODE, nm=NAME)


def cost_center_hierarchy(table: str) -> TableSpec:
    return TableSpec(table, ("cost_center_hierarchy_hist_id",), (
        DenseKey("cost_center_hierarchy_hist_id"),
        TextKey("cost_center_nbr", "CC", 6, domain="cost_center_dim_v"),
        Pick("cost_center_hierarchy_nm", v.COST_HIERARCHIES, (15, 20, 20, 15, 15, 10, 5)),
        *level_family("cost_center_level", 30, 5, 0.08, cd=CODE, nm=NAME),
        controlling_area(),
    ))


def hierarchy_name(prefix: str) -> Pick:
    return Pick("profit_center_hierarchy_nm", [f"{prefix} {area}" for area in ("NA", "EMEA", "GC", "APLA")],
                (30, 25, 25, 20))


def profit_center_hierarchy(table: str, key: str = "profit_center_hierarchy_id",
                            number: str = "profit_center_nbr", extra: tuple = ()) -> TableSpec:
    """Nine-level hierarchy over free-standing profit centre codes, with caller-supplied columns."""
    return TableSpec(table, (key,), (
        DenseKey(key),
        *extra,
        FreeCode(number, "PC", 6, "profit_center"),
        controlling_area(),
        Pick("profit_center_hierarchy_nm", ("Corporate", "EMEA PC", "NA PC", "APLA PC", "GC PC"),
             (20, 25, 25, 15, 15)),
        *profit_center_levels(),
    ))


def account_hierarchy(table: str, extra: tuple = ()) -> TableSpec:
    optional_codes = ("hierarchy_liabilty_cd", "hierarchy_net_loss_cd", "hierarchy_net_profit_cd",
                      "hierarchy_profit_loss_cd", "hierarchy_not_assignable_asset_cd", "hierarchy_notes_cd")
    transmission_flags = (
        "item_list_complete_transmission_ind", "hierarchy_name_list_complete_transmission_ind",
        "node_name_list_complete_transmission_ind", "sign_reversed_ind",
        "functional_area_list_complete_transmission_ind", "gl_account_list_complete_transmission_ind",
        "relationship_list_complete_transmission_ind", "totals_visible_ind", "credit_balance_ind",
        "debit_balance_ind")
    return TableSpec(table, ("gl_account_hierarchy_id",), (
        DenseKey("gl_account_hierarchy_id"),
        FreeCode("gl_account_nbr", "GL", 6, "gl_account_dim"),
        Pick("hierarchy_chart_of_accounts_cd", v.CHARTS_OF_ACCOUNTS, (40, 20, 25, 15)),
        Pick("hierarchy_nm", v.ACCOUNT_HIERARCHIES, (25, 20, 25, 20, 10)),
        *(Template(name, CODE, null_rate=0.5) for name in optional_codes),
        Template("hierarchy_cd", CODE),
        Template("parent_cd", CODE, null_rate=0.1),
        Template("node_nm", NAME),
        Template("node_cd", CODE),
        Whole("node_gl_account_nbr", 100_000, 999_999),
        Whole("node_gl_account_to_nbr", 100_000, 999_999, null_rate=0.3),
        flag("functional_area_assignment_allowed_ind", 70),
        flag("consolidation_chart_of_accounts_used_ind", 60),
        Whole("depth_of_leaf_nbr", 1, 30),
        Whole("depth_of_tree_nbr", 1, 30),
        *level_family("gl_account_level", 30, 8, 0.06, cd=ACCOUNT_CODE, nm=ACCOUNT_NAME),
        Pick("hierarchy_language_cd", v.LANGUAGES[:3], (60, 25, 15)),
        Template("hierarchy_action_cd", "rrd"),
        Template("hierarchy_category_cd", "rrd"),
        Template("top_level_assets_financial_reporting_structure_item_cd", CODE),
        Template("recipient_business_system_id", "rrrr_ddd"),
        Template("sender_business_system_id", "rrrr_ddd"),
        *(flag(name, 70) for name in transmission_flags),
        *audit_users(),
        source_code(),
        *extra,
    ))


SEGMENT_COST_CENTER_HIERARCHY = cost_center_hierarchy("segment_cost_center_hierarchy_dim_v")
DISCHANNEL_COST_CENTER_HIERARCHY = cost_center_hierarchy("dischannel_cost_center_hierarchy_dim_v")

SEGMENT_PROFIT_CENTER_HIERARCHY = TableSpec("segment_profit_center_hierarchy", ("profit_center_nbr",), (
    TextKey("profit_center_nbr", "PC", 6, counter="__segment_profit_center_nbr_id", domain="profit_center"),
    hierarchy_name("Segment"),
    *profit_center_levels(),
))

DISCHANNEL_PROFIT_CENTER_HIERARCHY = TableSpec(
    "dischannel_profit_center_hierarchy", ("profit_center_hierarchy_id",), (
        DenseKey("profit_center_hierarchy_id"),
        TextKey("distrchnl_profit_center_nbr", "PC", 6, domain="profit_center"),
        controlling_area(),
        hierarchy_name("DisChannel"),
        *profit_center_levels(),
    ))

PARTDISCHANNEL_PROFIT_CENTER_HIERARCHY = TableSpec(
    "partdischannel_profit_center_hierarchy", ("profit_center_hierarchy_id",), (
        DenseKey("profit_center_hierarchy_id"),
        controlling_area(),
        hierarchy_name("PartDisCh"),
        *profit_center_levels(),
        FreeCode("prtrdistrchnl_profit_center_nbr", "PC", 6, "profit_center"),
    ))

GEO_SECURITY = TableSpec("atscale_geo_security", ("region", "role"), (
    Cycle("region", v.REGIONS),
    Cycle("role", v.ROLES, every=len(v.REGIONS)),
), max_rows=len(v.REGIONS) * len(v.ROLES))

CONSOLIDATION_FUNCTIONAL_AREA_HIERARCHY = TableSpec(
    "consolidation_functional_area_hierarchy", ("consolidation_functional_area_hierarchy_id",), (
        DenseKey("consolidation_functional_area_hierarchy_id"),
        flag(),
        FreeCode("functional_area_cd", "FA", 4, "functional_area"),
        Template("consolidation_functional_area_hierarchy_parent_cd", CODE),
        Whole("functional_area_level_nbr", 1, 7),
        words("functional_area_type_nm", 9, 4),
        Template("consolidation_functional_area_hierarchy_cd", CODE),
        words("consolidation_functional_area_hierarchy_desc", 9, 8),
        *level_family("consolidation_functional_area", 7, 3, 0.2, cd=CODE, nm=NAME),
        *audit_users(),
        source_code(),
        *record_days(),
        Day("_consolidation_functional_area_hierarchy_raw_latest_load_tmst", "2023-01-01", "2025-12-31"),
    ))

CONSOLIDATION_SEGMENT_HIERARCHY = TableSpec(
    "consolidation_segment_hierarchy_dim", ("consolidation_segment_hierarchy_id",), (
        DenseKey("consolidation_segment_hierarchy_id"),
        Pick("segment_nbr", v.SEGMENT_NUMBERS, type="int"),
        words("segment_desc", 7, 8),
        Template("consolidation_segment_hierarchy_parent_cd", CODE),
        Pick("segment_type_nm", v.SEGMENT_KINDS, (30, 30, 25, 15)),
        Whole("segment_level_nbr", 1, 10),
        Template("consolidation_segment_hierarchy_cd", CODE),
        words("consolidation_segment_hierarchy_desc", 9, 8),
        Template("consolidation_segment_hierarchy_cd_desc", "rrddd rrrrrrrrr"),
        *level_family("consolidation_segment", 10, 4, 0.15, cd=CODE, nm=NAME, cd_nm="rrddd rrrrrrr"),
        *audit_users(),
        source_code(),
        flag(),
    ))

GL_ACCOUNT_HIERARCHY = account_hierarchy("gl_account_hierarchy", (
    Ref("gl_account_hierarchy_hist_id", "gl_account_hierarchy", declared=False),
    *record_days(),
    Day("_gl_account_hierarchy_cleansed_latest_load_timestamp", "2023-01-01", "2025-12-31"),
))
MANAGEMENT_GL_ACCOUNT_HIERARCHY = account_hierarchy("management_gl_account_hierarchy", (
    Template("hierarchy_cd_nm", "rrddd rrrrrrr"),
))

ZFSM_MEASURES_HIERARCHY = TableSpec("gl_account_zfsm_measures_hierarchy_dim", ("zfsm_measure_id",), (
    DenseKey("zfsm_measure_id"),
    *audit_users(),
    source_code(),
    flag(),
    Template("zfsm_measure_cd", "ZFSM_rrd"),
    words("zfsm_measure_desc", 9, 8, 4),
    *level_family("gl_account_level", 13, 5, 0.1, cd=ACCOUNT_CODE, nm=ACCOUNT_NAME),
    *record_days(),
))

EXCHANGE_RATE = TableSpec(
    "finance_foreign_currency_exchange_rate", ("finance_foreign_currency_exchange_rate_id",), (
        DenseKey("finance_foreign_currency_exchange_rate_id"),
        Pick("from_currency_cd", v.CURRENCIES),
        Pick("exchange_rate_cd", v.EXCHANGE_RATE_TYPES, (30, 20, 20, 15, 15)),
        Pick("exchange_rate_nm", v.EXCHANGE_RATE_NAMES, (30, 20, 20, 15, 15), draws_as="exchange_rate_cd"),
        Amount("exchange_rate", "0.0001", "200", 38, 18),
        Pick("from_currency_nm", tuple(v.CURRENCY_NAMES.values()), draws_as="from_currency_cd"),
        Pick("to_currency_cd", v.CURRENCIES[:2], (80, 20)),
        Pick("to_currency_nm", tuple(v.CURRENCY_NAMES.values())[:2], (80, 20), draws_as="to_currency_cd"),
        flag(),
    ))

STORE_COUNTRY_WEIGHTS = (30, 8, 7, 7, 10, 5, 3, 3, 5, 4, 4)

RETAIL_STORE_PROFILE = TableSpec("retail_global_store_profile_v", (), (
    words("address_match_type_name", 9),
    Template("store_uuid", "-".join("d" * n for n in (8, 4, 4, 4, 12))),
    words("application_reason_desc", 9, 6, null_rate=0.4),
    Pick("brand_cd", v.BRAND_CODES, (65, 20, 10, 5)),
    Pick("brand_desc", v.BRANDS[:4], (65, 20, 10, 5), draws_as="brand_cd"),
    Whole("building_floor_nbr", 1, 5, null_rate=0.3),
    Day("change_timestamp"),
    Template("china_store_sub_channel_cd", "rrd", null_rate=0.7),
    words("china_store_sub_channel_desc", 9, 4, null_rate=0.7),
    words("city_name", 9),
    Template("connect_global_store_key_cd", "d" * 10),
    Pick("country_cd", v.COUNTRIES, STORE_COUNTRY_WEIGHTS),
    Pick("country_name", tuple(v.COUNTRY_NAMES.values()), STORE_COUNTRY_WEIGHTS, draws_as="country_cd"),
    Day("create_dt"),
    words("customer_city_local_name", 9, null_rate=0.6),
    Template("customer_id", "d" * 11),
    words("customer_local_province_state_name", 9, null_rate=0.6),
    Template("customer_nbr", "d" * 8),
    words("customer_ship_to_name", 8, 7),
    Template("dma_cd", "ddddd", null_rate=0.5),
    words("dma_desc", 9, 6, null_rate=0.5),
    words("fixture_type_name", 9, null_rate=0.4),
    words("fixture_program_name", 10, 4, null_rate=0.4),
    Pick("geography_region_name", v.GEOGRAPHIES[:5], (30, 25, 15, 15, 15)),
    Template("global_store_channel_class_cd", "rrd"),
    words("global_store_channel_class_desc", 10, 4),
    words("greater_china_sub_territory_name", 8, null_rate=0.8),
    Template("id", "d" * 17),
    words("global_key_city_name", 9, null_rate=0.5),
    words("landlord", 8, 11, null_rate=0.3),
    Day("change_dt"),
    Day("lease_expiration_dt", "2023-01-01", "2035-12-31"),
    Template("lease_status_cd", "rrd"),
    words("lease_status_desc", 9),
    Template("local_language_store_street_address1", "ddd rrrrrrr rrrrrr", null_rate=0.4),
    Template("local_language_store_street_address2", "rrrrrrr rrd", null_rate=0.7),
    words("location_name", 10, 7),
    Pick("mall_grade", v.MALL_GRADES, (25, 20, 25, 20, 10)),
    words("ncx_concept", 8, null_rate=0.5),
    Real("brand_selling_space_size_quantity", 500, 50_000),
    Whole("original_pos_id", 100_000, 999_999),
    words("planned_retail_concept", 8, null_rate=0.4),
    Whole("pos_id", 100_000, 999_999),
    Whole("pos_retailer_location_id", 100_000, 999_999, null_rate=0.2),
    Template("postal_cd", "ddddd"),
    words("province_state_name", 10),
    Template("real_estate_category_cd", "rrd"),
    words("real_estate_category_desc", 9, 5),
    Pick("record_type", v.STORE_RECORD_TYPES, (50, 20, 20, 10)),
    Day("retail_concept_actual_dt", null_rate=0.3),
    Template("retail_concept_cd", "rrd"),
    words("retail_concept_desc", 9, 4),
    Pick("retail_concept_size", v.CONCEPT_SIZES, (5, 10, 25, 30, 20, 10)),
    Day("retail_concept_target_dt", null_rate=0.3),
    Pick("retail_concept_volume", v.CONCEPT_VOLUMES, (15, 35, 35, 15)),
    Template("ship_to_customer_nbr", "d" * 8),
    Pick("space_uom", v.SPACE_UNITS, (60, 40)),
    Whole("store_city_tier_nbr", 1, 5),
    Day("store_close_dt", "2020-01-01", "2025-12-31", null_rate=0.8),
    words("store_closure_reason_desc", 9, 6, null_rate=0.8),
    Template("store_cd", "dddddd"),
    Template("store_distribution_type_cd", "rrd"),
    words("store_distribution_type_desc", 9, 4),
    words("store_district_name", 9, 4),
    Template("store_environment_cd", "rrd"),
    words("store_environment_desc", 9),
    words("store_front_name_english", 10, 6),
    words("store_front_name_local", 10, 6, null_rate=0.5),
    Template("store_hotspot_id", CODE, null_rate=0.5),
    words("store_hotspot_name_english", 9, 4, null_rate=0.5),
    words("store_hotspot_name_local", 9, 4, null_rate=0.5),
    words("store_hotspot_tier_desc", 10, null_rate=0.5),
    Whole("store_id_kona", 10_000, 99_999),
    Day("store_last_open_dt", "2000-01-01", "2025-12-31"),
    Day("store_last_renovation_dt", "2010-01-01", "2025-12-31", null_rate=0.5),
    Template("store_last_renovation_type_cd", "rrd", null_rate=0.5),
    words("store_last_renovation_type_desc", 9, null_rate=0.5),
    Template("store_lead_category_cd", "rrd"),
    words("store_lead_category_name", 10, 5),
    Whole("store_level", 1, 5),
    words("store_name_english", 10, 6),
    words("store_name_local", 10, 6, null_rate=0.4),
    Day("store_open_dt", "2000-01-01", "2023-12-31"),
    Pick("store_priority", v.STORE_PRIORITIES, (20, 30, 30, 20)),
    Real("store_selling_space_size_quantity", 300, 30_000),
    Pick("store_status_cd", tuple(v.STORE_STATUSES), (75, 10, 5, 10)),
    Pick("store_status_desc", tuple(v.STORE_STATUSES.values()), (75, 10, 5, 10), draws_as="store_status_cd"),
    Template("store_street_address1", "ddd rrrrrrr rrrrrr"),
    Template("store_street_address2", "rrrrrrr rrd", null_rate=0.6),
    Template("store_sub_type_cd", "rrd"),
    words("store_sub_type_desc", 9),
    Pick("store_tier_desc", v.STORE_TIERS, (20, 30, 30, 20)),
    Whole("store_tier_id", 1, 4),
    Real("store_total_space_size", 500, 60_000),
    Template("telephone_nbr", "+d (ddd) ddd-dddd"),
    words("territory_name", 9),
    Whole("total_stories", 1, 5),
    Template("vendor_pos_key", "rrddddddd"),
    Pick("iso_country_cd", v.COUNTRIES[:9], (30, 8, 7, 7, 10, 5, 3, 3, 7)),
    Pick("default_transaction_iso_currency_cd", ("USD", "EUR", "GBP", "JPY", "CNY", "CAD", "AUD"),
         (35, 20, 8, 8, 10, 10, 9)),
    words("store_short_name_english", 10),
    Template("store_master_id", "rrd-dddddddddddd"),
    Template("geography_abbrv", "rrr"),
    Day("stream_change_timestamp"),
    Pick("space_uom_cd", v.SPACE_UNITS, (60, 40), draws_as="space_uom"),
    Template("store_district_cd", CODE),
    Template("region_cd", "rrd"),
    Pick("climate_cd", v.CLIMATES, (20, 30, 25, 15, 10)),
    words("climate_name", 10),
    Pick("comparable_status", v.COMPARABLE, (60, 25, 15)),
    Template("real_estate_type_cd", "rrd"),
    words("real_estate_type_name", 9, 4),
    Template("retail_sales_area_cd", CODE),
    words("retail_sales_area_name", 9, 6),
    Template("retail_sales_district_cd", CODE),
    words("retail_sales_district_name", 9, 6),
    Template("retail_sub_concept_cd", "rrd"),
    words("retail_sub_concept_name", 9),
    Template("sales_organization_cd", CODE),
    words("sales_organization_name", 10, 10),
    Pick("record_type_cd", v.RECORD_TYPE_CODES, (50, 25, 15, 10)),
    Template("territory_cd", CODE),
    Template("retail_sales_territory_cd", CODE),
    words("retail_sales_territory_name", 9, 6),
    Template("retail_store_district_cd", CODE),
    words("retail_store_district_name", 9, 6),
    words("banner_division_text", 10),
    Template("marketplace_store_tier_cd", "rrd"),
    words("marketplace_store_tier_name", 9),
    Whole("store_score", 1, 100),
    Template("partner_store_positioning_cd", "rrd"),
    words("partner_store_positioning_name", 9, 4),
    Template("geo_key_city_cd", CODE),
    words("geo_key_city_name", 9),
    Template("key_trade_zone_cd", CODE),
    words("key_trade_zone_name", 9, 6),
))

HIERARCHIES = (
    GEO_SECURITY, CONSOLIDATION_FUNCTIONAL_AREA_HIERARCHY, CONSOLIDATION_SEGMENT_HIERARCHY,
    SEGMENT_COST_CENTER_HIERARCHY, SEGMENT_PROFIT_CENTER_HIERARCHY, DISCHANNEL_COST_CENTER_HIERARCHY,
    DISCHANNEL_PROFIT_CENTER_HIERARCHY, PARTDISCHANNEL_PROFIT_CENTER_HIERARCHY, GL_ACCOUNT_HIERARCHY,
    MANAGEMENT_GL_ACCOUNT_HIERARCHY, ZFSM_MEASURES_HIERARCHY, EXCHANGE_RATE, RETAIL_STORE_PROFILE,
)
