"""Name -> (query, check SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.bindings import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def add(name: str, query: Callable[[SparkSession, str], DataFrame], check: str | None = None):
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")
    QUERIES[name] = query
    if check is not None:
        CHECKS[name] = check


def checks() -> dict[str, str]:
    """Check SQL with the views each one needs in front."""
    return {name: sql(text) for name, text in CHECKS.items()}
