"""The downstream aggregate over a built ledger star: fact, four partial hierarchies, product and calendar."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.operators.star import BROADCAST_BYTES, Branch, star_aggregate, survival_estimate, surviving_rows

FACT_GROUPS = (
    "fiscal_year_period_nbr", "general_ledger_fact_ind", "cis_delta_ind",
    "general_ledger_ocogs_allocation_fact_ind", "anaplan_corporate_ind", "etm_ind", "company_currency_cd",
    "transaction_currency_cd", "accounting_document_type_cd", "functional_area_cd", "company_cd",
)
DIMENSION_GROUPS = (
    "fiscal_year_quarter_cd", "global_sport_focus_desc", "segment_hierarchy_nm", "dischannel_hierarchy_nm",
    "segment_cost_hierarchy_nm", "dischannel_cost_hierarchy_nm",
)
SUMS = ("company_currency_amt", "transaction_currency_amt", "performance_management_currency_amt", "sales_qty",
        "returns_qty")

# Each hierarchy with its key and the fact key it filters, most selective first.
HIERARCHY_KEYS = (
    ("segment_profit_center_hierarchy", "profit_center_nbr", "profit_center_nbr"),
    ("dischannel_profit_center_hierarchy", "distrchnl_profit_center_nbr", "profit_center_nbr"),
    ("segment_cost_center_hierarchy_dim_v", "cost_center_nbr", "cost_center_nbr"),
    ("dischannel_cost_center_hierarchy_dim_v", "cost_center_nbr", "cost_center_nbr"),
)
HIERARCHY_NAMES = {
    "segment_profit_center_hierarchy": ("profit_center_hierarchy_nm", "segment_hierarchy_nm"),
    "dischannel_profit_center_hierarchy": ("profit_center_hierarchy_nm", "dischannel_hierarchy_nm"),
    "segment_cost_center_hierarchy_dim_v": ("cost_center_hierarchy_nm", "segment_cost_hierarchy_nm"),
    "dischannel_cost_center_hierarchy_dim_v": ("cost_center_hierarchy_nm", "dischannel_cost_hierarchy_nm"),
}
SURVIVAL_FILTERS = (("segment_profit_center_hierarchy", "profit_center"),
                    ("segment_cost_center_hierarchy_dim_v", "cost_center_dim_v"))


def hierarchy_branches(tables: Mapping[str, DataFrame], sizes: Mapping[str, int]) -> list[Branch]:
    """The four hierarchies with a name each, under keys that cannot clash with the fact's."""
    branches = []
    for name, key, fact_key in HIERARCHY_KEYS:
        column, label = HIERARCHY_NAMES[name]
        side = tables[name].select(F.col(key).alias(f"__{name}"), F.col(column).alias(label))
        branches.append(Branch(side, fact_key, f"__{name}", sizes.get(name), partial=True))
    return branches


def ledger_aggregate(tables: Mapping[str, DataFrame], sizes: Mapping[str, int] | None = None,
                     group_by: Sequence[str] = FACT_GROUPS + DIMENSION_GROUPS,
                     sums: Sequence[str] = SUMS, broadcast_limit: int = BROADCAST_BYTES) -> DataFrame:
    """Sums of the ledger amounts for the rows that every hierarchy covers.

    ``sizes`` holds known row counts; they bound what may be broadcast. The
    hierarchies come first, so four fifths of a default fact are gone before the
    product and the calendar are met.
    """
    sizes = sizes or {}
    product = tables["finance_product_dim_v"].select(
        F.col("product_id").alias("__product_id"), "global_sport_focus_desc")
    calendar = tables["calendar_fiscal_period_v"].select(
        F.col("fiscal_year_period_nbr").alias("__period"), "fiscal_year_quarter_cd")
    branches = [
        *hierarchy_branches(tables, sizes),
        Branch(product, "product_id", "__product_id", sizes.get("finance_product_dim_v")),
        Branch(calendar, "fiscal_year_period_nbr", "__period", sizes.get("calendar_fiscal_period_v")),
    ]
    measures = {"row_count": F.count(F.lit(1))}
    measures |= {name: F.sum(name).cast("decimal(38,5)") for name in sums}
    return star_aggregate(tables["general_ledger_fact"], branches, list(group_by), measures, broadcast_limit)


def ledger_survivors(tables: Mapping[str, DataFrame], sizes: Mapping[str, int] | None = None,
                     broadcast_limit: int = BROADCAST_BYTES) -> DataFrame:
    """The fact rows that every hierarchy covers."""
    return surviving_rows(tables["general_ledger_fact"], hierarchy_branches(tables, sizes or {}), broadcast_limit)


def expected_aggregate_rows(sizes: Mapping[str, int]) -> int:
    """Fact rows times expected survival: nearly every survivor is a group of its own."""
    return round(sizes["general_ledger_fact"] * survival_estimate(sizes, SURVIVAL_FILTERS))
