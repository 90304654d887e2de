"""Every registered query of the library, beside the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audit, crawl, design, documents, ledger, policy, registry

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (ledger, audit, policy, documents, crawl, registry, design)


def queries() -> dict[str, Query]:
    return {name: f for module in _MODULES for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
