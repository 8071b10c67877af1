"""Importing this module registers every query."""

from shopgrain.plans import (  # noqa: F401
    queries_catalogue,
    queries_demand,
    queries_reports,
    queries_search,
    queries_sources,
    queries_sql,
    queries_streams,
    queries_text,
)
from shopgrain.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
