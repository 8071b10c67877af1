"""Names, Spark queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from shopgrain.plans import ctes
from shopgrain.plans.views import Views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, needs: Sequence[str] = ()):
    """Register ``f(views) -> DataFrame`` under a name, with its SQL if it has one."""

    def register(f: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = ctes.with_views(needs, sql)
        return f

    return register


__all__ = ["ORACLE", "QUERIES", "query"]
