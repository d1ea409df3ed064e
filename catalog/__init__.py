"""Registered queries: each operator run over the given tables, with its check SQL."""

from catalog.registry import QUERIES, checks  # noqa: F401
from catalog import correlation, kpis, rollups, series, shapes, streams  # noqa: F401,E402
