"""All registered queries: name -> (Spark callable, DuckDB SQL or a callable that makes it)."""

from __future__ import annotations

from functools import cache

from driver.check_queries import check_queries
from driver.contract_queries import contract_queries
from driver.dataset_queries import dataset_queries
from driver.generated import generated_queries
from driver.star_queries import star_queries


@cache
def registry() -> dict:
    return star_queries() | check_queries() | generated_queries() | dataset_queries() | contract_queries()
