"""Rows and partitions per table, and the key-domain sizes that follow from them."""

from __future__ import annotations

from collections.abc import Mapping

from finloom.sources.domains import load_mapping
from finloom.sources.location import Location
from finloom.sources.values import DIVISION_ROWS

# Settings of a table that declares nothing.
DEFAULT_ROWS = 1000
DEFAULT_SHUFFLE_PARTITIONS = 400

# Default row counts. Partial hierarchies keep 40 % and 50 % of their dimension.
DEFAULT_VOLUMES = {
    "calendar_fiscal_period_v": 192,
    "profit_center": 500_000,
    "version_forecast_mapping": 30_000,
    "functional_area": 1_000,
    "accounting_document_type": 20,
    "division_text": DIVISION_ROWS,
    "division_text_dim_v": DIVISION_ROWS,
    "finance_product_dim_v": 50_000,
    "finance_customer_dim_v": 100_000,
    "company_code": 50_000,
    "copa_attribution_dim": 500_000,
    "cost_center_dim_v": 500_000,
    "geo_wholesale_value_business_dim": 200_000,
    "geo_marketplace_channel_dim": 100_000,
    "gl_account_dim": 200_000,
    "gl_account_zfsm_measures_hierarchy_dim": 100_000,
    "finance_foreign_currency_exchange_rate": 200_000,
    "general_ledger_fact": 2_000_000_000,
    "cis_fact": 1_000_000_000,
    "consolidated_balance_sheet_fact": 500_000_000,
    "segment_cost_center_hierarchy_dim_v": 250_000,
    "segment_profit_center_hierarchy": 200_000,
    "dischannel_cost_center_hierarchy_dim_v": 250_000,
    "dischannel_profit_center_hierarchy": 200_000,
    "partdischannel_profit_center_hierarchy": 200_000,
    "atscale_geo_security": 80,
    "consolidation_functional_area_hierarchy": 5_000,
    "consolidation_segment_hierarchy_dim": 3_000,
    "gl_account_hierarchy": 5_000,
    "management_gl_account_hierarchy": 5_000,
    "retail_global_store_profile_v": 5_000,
}

SETTINGS = ("rows", "partitions", "shuffle_partitions")
ENVIRONMENT = ("catalog", "schema", "path", "write_mode", "use_delta", "delta_optimize")  # the last two say nothing here


class Volumes:
    """Declared sizes, and where and how a job writes.

    A value is a row count or ``{rows, partitions, shuffle_partitions}``; the block ``environment`` names the place
    (``catalog`` and ``schema``, or ``path``) and the ``write_mode``.
    """

    def __init__(self, declared: Mapping | str | None = None):
        source = load_mapping(declared) if isinstance(declared, str) else declared
        source = DEFAULT_VOLUMES if source is None else source
        self._declared, self.environment = {}, dict(source.get("environment") or {})
        unknown = set(self.environment) - set(ENVIRONMENT)
        if unknown:
            raise ValueError(f"environment: unknown settings {sorted(unknown)}")
        for name, entry in source.items():
            if name == "environment":
                continue
            self._declared[name.lower()] = dict(entry) if isinstance(entry, Mapping) else {"rows": int(entry)}
            self._check(name)

    def _check(self, name: str) -> None:
        unknown = set(self._declared[name.lower()]) - set(SETTINGS)
        if unknown:
            raise ValueError(f"{name}: unknown settings {sorted(unknown)}")

    def with_overrides(self, overrides: Mapping[str, Mapping] | None, known: list[str]) -> Volumes:
        """A copy for one run; a name that is no table raises."""
        changed = Volumes({name: dict(entry) for name, entry in self._declared.items()} | {"environment": self.environment})
        for name, entry in (overrides or {}).items():
            if name.lower() not in known:
                raise KeyError(f"override for unknown table {name}")
            values = dict(entry) if isinstance(entry, Mapping) else {"rows": int(entry)}
            changed._declared.setdefault(name.lower(), {}).update(values)
            changed._check(name)
        return changed

    def place(self) -> Location | None:
        """Where the environment says that tables live, or None where it doesn't."""
        catalog, schema, path = (self.environment.get(name) for name in ("catalog", "schema", "path"))
        if path and (schema or catalog) or catalog and not schema:
            raise ValueError("environment: give a path, a schema, or a catalog and a schema")
        if path:
            return Location(path=path)
        return Location(schema=".".join(filter(None, (catalog, schema)))) if schema else None

    def write_mode(self) -> str:
        return self.environment.get("write_mode", "overwrite")

    def declares(self, table: str) -> bool:
        return "rows" in self._declared.get(table.lower(), {})

    def rows(self, table: str) -> int:
        return int(self._declared.get(table.lower(), {}).get("rows", DEFAULT_ROWS))

    def partitions(self, table: str) -> int | None:
        """Declared partitions; None leaves them to the size of the table."""
        declared = self._declared.get(table.lower(), {}).get("partitions")
        return int(declared) if declared else None

    def shuffle_partitions(self, table: str = "general_ledger_fact") -> int:
        return int(self._declared.get(table.lower(), {}).get("shuffle_partitions", DEFAULT_SHUFFLE_PARTITIONS))

    def domain_sizes(self) -> dict[str, int]:
        """Rows of every table that declares a size. A table that can't hold so many raises when it is built."""
        return {name: self.rows(name) for name in self._declared if self.declares(name)}
