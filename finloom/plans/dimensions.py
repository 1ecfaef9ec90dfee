"""Dimension tables as column specs. Names, shapes, ranges and weights are fixed values of the data model."""

from __future__ import annotations

from finloom.plans.specs import (
    CodeOf, Constant, Cycle, Day, DenseKey, FreeCode, Label, PaddedId, Pick, TableSpec, Template, TextKey,
    Whole, audit_users, flag, user_id, words,
)
from finloom.sources import values as v


def source_code() -> Pick:
    return Pick("physical_source_cd", v.SOURCE_SYSTEMS, v.SOURCE_SYSTEM_WEIGHTS)


def controlling_area() -> Pick:
    return Pick("controlling_area_cd", v.CONTROLLING_AREAS, (30, 25, 15, 10, 10, 10))


ACCOUNTING_DOCUMENT_TYPE = TableSpec("accounting_document_type", ("accounting_document_type_id",), (
    DenseKey("accounting_document_type_id"),
    CodeOf("accounting_document_type_cd", tuple(v.DOCUMENT_TYPES), "accounting_document_type_id"),
    CodeOf("accounting_document_type_nm", tuple(v.DOCUMENT_TYPES.values()), "accounting_document_type_id"),
    flag(),
    Pick("language_cd", v.LANGUAGES, (50, 15, 10, 8, 10, 7)),
    Label("accounting_document_type_cd_nm", "{accounting_document_type_cd} - {accounting_document_type_nm}"),
))

PROFIT_CENTER = TableSpec("profit_center", ("profit_center_id",), (
    DenseKey("profit_center_id"),
    TextKey("profit_center_nbr", "PC", 6),
    Label("profit_center_nm", "Profit Center {profit_center_nbr}"),
    Pick("segment_id", v.SEGMENT_IDS),
    Pick("geography_nm", v.GEOGRAPHIES, (30, 25, 15, 10, 12, 8)),
    Pick("profit_center_channel_nm", v.PROFIT_CENTER_CHANNELS, (30, 25, 20, 15, 10)),
    Pick("territory_nm", v.TERRITORIES),
    Pick("sub_territory_nm", v.COMPASS),
    Day("begin_effective_dt", "2010-01-01", "2020-12-31"),
    Day("end_effective_dt", "2025-01-01", "2030-12-31"),
    flag(),
    Whole("geography_sort", 1, 6),
    Pick("operating_segment_nm", v.OPERATING_SEGMENTS),
))

DIVISION_TEXT = TableSpec("division_text", ("division_id",), (
    DenseKey("division_id"),
    PaddedId("division_nbr", "division_text", 2),
    Cycle("division_nm", [name for name, _, _ in v.DIVISIONS]),
    Cycle("division_group", [group for _, group, _ in v.DIVISIONS]),
    Constant("last_row_ind", "Y"),
    Label("common_data_service_view_nm", "view_{division_nbr}"),
    Constant("source_system_nm", v.DIVISION_CONSTANTS["source_system_nm"]),
    Constant("raw_tmst", v.DIVISION_CONSTANTS["created"], type="date"),
    Constant("record_created_tmst_utc", v.DIVISION_CONSTANTS["created"], type="date"),
    Constant("record_update_tmst_utc", v.DIVISION_CONSTANTS["updated"], type="date"),
    Constant("created_by_user_id", v.DIVISION_CONSTANTS["user"]),
    Constant("updated_by_user_id", v.DIVISION_CONSTANTS["user"]),
    Constant("physical_source_cd", v.DIVISION_CONSTANTS["source_system_nm"]),
    Constant("language_cd", v.DIVISION_CONSTANTS["language_cd"]),
    Cycle("active_ind", [active for _, _, active in v.DIVISIONS]),
), max_rows=v.DIVISION_ROWS)

DIVISION_TEXT_DIM_V = TableSpec("division_text_dim_v", ("division_nbr",), (
    PaddedId("division_nbr", "division_text_dim_v", 2),
    Cycle("division_nm", [name for name, _, _ in v.DIVISIONS]),
    DenseKey("division_id"),
    Cycle("division_group", [group for _, group, _ in v.DIVISIONS]),
), max_rows=v.DIVISION_ROWS)

VERSION_FORECAST_MAPPING = TableSpec("version_forecast_mapping", ("version_forecast_mapping_id",), (
    DenseKey("version_forecast_mapping_id"),
    Pick("version_nbr", v.VERSIONS),
    Pick("version_group_nm", v.VERSION_GROUPS, (40, 20, 20, 10, 7, 3)),
    flag(),
))

FUNCTIONAL_AREA = TableSpec("functional_area", ("functional_area_id",), (
    DenseKey("functional_area_id"),
    Pick("language_cd", v.LANGUAGES[:5], (50, 15, 10, 10, 15)),
    TextKey("functional_area_cd", "FA", 4),
    Pick("functional_area_nm", v.FUNCTIONS),
))

FINANCE_PRODUCT = TableSpec("finance_product_dim_v", ("product_id",), (
    DenseKey("product_id"),
    Pick("primary_platform_desc", v.PLATFORMS, (40, 35, 10, 8, 7)),
    Template("style_nm", "rrrr dddd"),
    Pick("franchise_nm", v.FRANCHISES, (22, 18, 14, 11, 9, 8, 6, 5, 4, 3)),
    Pick("gender_desc", v.GENDERS, (35, 30, 15, 10, 7, 3)),
    Pick("global_category_core_focus_desc", v.CORE_FOCUS, (25, 20, 15, 12, 12, 5, 4, 4, 3)),
    Template("product_cd", "rrr-ddddd-ddd"),
    Pick("team_nm", v.TEAMS, (70, 6, 6, 5, 5, 4, 4)),
    Pick("league_desc", v.LEAGUES, (51, 9, 8, 8, 7, 7, 6, 4)),
    words("athlete_full_nm", 4, 7, null_rate=0.7),
    Pick("product_company_nm", v.BRANDS[:4], (48, 27, 16, 9)),
    Pick("age_desc", v.AGES, (55, 20, 8, 8, 9)),
    words("consumer_construct_dimension_nm", 9),
    words("fields_of_play_nm", 7, 5),
    Pick("merchandising_classification_desc", v.MERCHANDISING, (40, 20, 20, 15, 5)),
    Pick("consumer_construct_segment_nm", v.CONSUMER_SEGMENTS, (24, 22, 18, 14, 12, 10)),
    Pick("brand_nm", v.BRANDS, (40, 24, 14, 10, 7, 5)),
    Pick("sub_category_desc", v.SUB_CATEGORIES, (35, 20, 15, 10, 8, 7, 5)),
    flag("blank_usage_ind", 5),
    Pick("silhouette_desc", v.SILHOUETTES, (40, 25, 15, 8, 5, 4, 3)),
    Pick("silhouette_type_desc", v.CLOSURES, (60, 20, 15, 5)),
    Template("style_nbr", "rr-dddddd-ddd"),
    words("consumer_construct_global_consumer_offense_nm", 9, 4),
    flag(),
    *audit_users(),
    source_code(),
    Pick("global_sport_focus_derived_desc", v.SPORTS, (25, 20, 20, 20, 15)),
    Pick("global_sport_focus_desc", v.SPORTS, (25, 20, 20, 20, 15)),
    words("global_sport_sub_focus_desc", 9),
    Pick("sub_brand_desc", v.SUB_BRANDS, (26, 21, 18, 14, 12, 9)),
    Template("sub_brand_cd", "rrd"),
))

FINANCE_CUSTOMER = TableSpec("finance_customer_dim_v", ("finance_customer_id",), (
    DenseKey("finance_customer_id"),
    Template("customer_nbr", "d" * 8),
    Pick("channel_desc", v.CUSTOMER_CHANNELS, (30, 25, 20, 10, 10, 5)),
    words("customer_nm", 8, 7),
    words("customer_owner_group_nm", 7, 6),
    Pick("marketplace_channel_nm", v.MARKET_CHANNELS, (28, 24, 16, 13, 9, 6, 4)),
    Pick("geo_marketplace_unit_nm", v.GEOGRAPHIES[:5], (30, 25, 15, 15, 15)),
    words("integrated_business_planning_level_1_desc", 6, 6),
    words("integrated_business_planning_level_2_desc", 6, 6, 4),
    words("integrated_business_planning_level_3_desc", 6, 5, 6),
    words("integrated_business_planning_mpu_desc", 6, 4),
    words("sub_territory_nm", 8),
    Pick("customer_business_type_nm", v.BUSINESS_TYPES, (20, 20, 15, 15, 15, 15)),
    Pick("customer_subtype_nm", v.CUSTOMER_SUBTYPES, (25, 25, 20, 20, 10)),
    Pick("partner_channel", v.PARTNER_CHANNELS, (35, 30, 25, 10)),
    words("partner_sub_channel", 8),
    Pick("partner_account_classification", v.ACCOUNT_CLASSES, (20, 25, 25, 20, 10)),
))

COMPANY_CODE = TableSpec("company_code", ("company_id",), (
    DenseKey("company_id"),
    PaddedId("company_cd", "company_code", 4),
    words("company_nm", 8, 11),
    Pick("currency_cd", v.CURRENCIES[:8], (35, 20, 10, 8, 8, 5, 7, 7)),
    *audit_users(),
    source_code(),
))

COPA_ATTRIBUTION = TableSpec("copa_attribution_dim", ("copa_attribution_id",), (
    DenseKey("copa_attribution_id"),
    Template("responsive_business_model_cd", "rrd"),
    words("responsive_business_model_desc", 9, 10),
    Template("demand_stream_cd", "ddd"),
    words("demand_stream_desc", 7, 6),
    Pick("business_type_cd", v.BUSINESS_TYPE_CODES, (25, 25, 20, 15, 15)),
    words("business_type_desc", 10, 6),
    Template("marketing_type_cd", "rrd"),
    words("marketing_type_desc", 8, 4),
    Pick("gender_age_cd", tuple(v.GENDER_AGE_NAMES), (30, 25, 15, 12, 10, 8)),
    Pick("gender_age_desc", tuple(v.GENDER_AGE_NAMES.values()), (30, 25, 15, 12, 10, 8),
         draws_as="gender_age_cd"),
    Template("direct_business_model_cd", "rrd"),
    words("direct_business_model_desc", 9, 4),
    Pick("product_lifecycle_cd", v.LIFECYCLE_CODES, (20, 30, 35, 15)),
    words("product_lifecycle_desc", 11),
    Pick("quality_cd", v.QUALITY_CODES, (30, 50, 20)),
    words("quality_desc", 10),
    Template("region_summary_product_group_cd", "rrd"),
    words("region_summary_product_group_desc", 6, 7),
    words("sales_order_reason_desc", 9, 6),
    Pick("sales_order_type_cd", v.SALES_ORDER_TYPES, (30, 20, 10, 10, 8, 12, 10)),
    words("sales_order_type_desc", 8, 5, 4),
    words("sales_order_type_group_desc", 10, 4),
    words("sales_order_item_category_cd", 4),
    words("sales_order_item_category_desc", 9, 6, 5),
    Pick("distribution_method_cd", v.DISTRIBUTION_METHODS, (25, 20, 20, 15, 10, 10)),
    words("distribution_method_desc", 12, 7),
    Template("sales_order_reason_cd", "rrd"),
))

POSTING_FLAGS = (
    "posting_allowed_ind", "planning_allowed_ind", "secondary_costs_posting_allowed_ind",
    "revenue_posting_allowed_ind", "commitment_update_allowed_ind", "secondary_costs_planning_allowed_ind",
    "revenue_planning_allowed_ind", "quantity_required_ind",
)
CONTACT_NUMBERS = ("telebox_nbr", "fax_nbr", "teletex_nbr", "telex_nbr", "data_communication_line_nbr")

COST_CENTER = TableSpec("cost_center_dim_v", ("cost_center_nbr",), (
    TextKey("cost_center_nbr", "CC", 6),
    controlling_area(),
    Day("valid_to_dt", "2025-01-01", "2035-12-31"),
    Day("valid_from_dt", "2000-01-01", "2020-12-31"),
    Pick("iso_language_cd", v.LANGUAGES[:5], (50, 15, 10, 10, 15)),
    Label("cost_center_nm", "Cost Center {cost_center_nbr}"),
    Label("cost_center_desc", "Description for {cost_center_nm}"),
    Template("cost_center_category_hierarchy_1_cd", "rrd"),
    Template("cost_center_category_hierarchy_2_cd", "rrd"),
    Template("company_cd", "dddd"),
    Pick("source_system", v.SOURCE_SYSTEMS[:3], (40, 40, 20)),
    Pick("cost_center_type_cd", v.COST_CENTER_TYPES, (50, 20, 15, 10, 5)),
    words("cost_center_category_short_desc", 9),
    Template("business_area_cd", "dddd"),
    Template("tax_jurisdiction_cd", "rr-ddd-ddd"),
    FreeCode("functional_area_cd", "FA", 4, "functional_area"),
    Pick("currency_cd", v.CURRENCIES[:7], (35, 20, 10, 8, 10, 7, 10)),
    *(flag(name, 80) for name in POSTING_FLAGS),
    words("department_nm", 8, 11),
    Template("cost_center_report_printer_destination_cd", "rrrrd"),
    Template("company_legal_entity_id", "rrd_dddddd"),
    FreeCode("profit_center_nbr", "PC", 6, "profit_center"),
    words("responsible_user_nm", 8, 7),
    user_id("responsible_user_id"),
    words("responsible_user_title", 9),
    *(words(f"line_{n}_nm", 10, 6, null_rate=0.5) for n in range(1, 5)),
    Pick("country_cd", v.COUNTRIES[:9], (30, 10, 8, 8, 10, 5, 3, 3, 5)),
    Template("region_cd", "rrd"),
    words("city_nm", 9),
    words("district_nm", 7, 6, null_rate=0.3),
    Template("postal_cd", "ddddd"),
    Template("street_address_txt", "ddd rrrrrrr rrrrrr"),
    Template("po_box_postal_cd", "ddddd", null_rate=0.6),
    Template("po_box_nbr", "ddddd", null_rate=0.6),
    Pick("correspondence_language_cd", v.LANGUAGES[:5], (50, 15, 10, 10, 15)),
    Template("first_telephone_nbr", "+d (ddd) ddd-dddd"),
    Template("second_telephone_nbr", "+d (ddd) ddd-dddd", null_rate=0.7),
    *(Template(name, "d" * 9, null_rate=0.9) for name in CONTACT_NUMBERS),
    Day("msg_header_tmst", null_rate=0.3),
    Day("begin_effective_dt", "2000-01-01", "2020-12-31"),
    Day("end_effective_dt", "2025-01-01", "2035-12-31"),
    DenseKey("cost_center_id"),
    Day("_cost_center_cleansed_latest_load_timestamp", "2023-01-01", "2025-12-31"),
))

GEO_WHOLESALE_VALUE_BUSINESS = TableSpec(
    "geo_wholesale_value_business_dim", ("geo_wholesale_value_business_id",), (
        DenseKey("geo_wholesale_value_business_id"),
        words("geo_wholesale_value_business_desc", 9, 8, 4),
        *audit_users(),
        source_code(),
    ))

GEO_MARKETPLACE_CHANNEL = TableSpec("geo_marketplace_channel_dim", ("geo_marketplace_channel_id",), (
    DenseKey("geo_marketplace_channel_id"),
    Pick("geo_marketplace_channel_nm", v.GEO_CHANNELS),
    *audit_users(),
    source_code(),
    flag(),
))

GL_ACCOUNT = TableSpec("gl_account_dim", ("gl_account_nbr",), (
    TextKey("gl_account_nbr", "GL", 6),
    Label("gl_account_short_desc", "GL Account {gl_account_nbr}"),
    Label("gl_account_long_desc", "General Ledger Account: {gl_account_short_desc}"),
    Day("begin_effective_dt", "2000-01-01", "2018-12-31"),
    Day("end_effective_dt", "2025-01-01", "2035-12-31"),
    flag(),
    DenseKey("gl_accnt_id"),
    Pick("cost_component_calc", v.YES_NO_BLANK, (30, 30, 40)),
))

DIMENSIONS = (
    ACCOUNTING_DOCUMENT_TYPE, PROFIT_CENTER, DIVISION_TEXT, VERSION_FORECAST_MAPPING, FUNCTIONAL_AREA,
    FINANCE_PRODUCT, FINANCE_CUSTOMER, COMPANY_CODE, COPA_ATTRIBUTION, COST_CENTER,
    GEO_WHOLESALE_VALUE_BUSINESS, GEO_MARKETPLACE_CHANNEL, GL_ACCOUNT, DIVISION_TEXT_DIM_V,
)
