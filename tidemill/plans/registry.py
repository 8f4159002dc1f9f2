"""The list of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.plans.views import with_views

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str | Callable[[], str]] = {}


def query(name: str, sql: str | Callable[[], str] | None = None, views: str = "") -> Callable[[Query], Query]:
    """Registers a query. ``views`` names the derived tables its SQL twin starts from."""

    def add(fn: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = fn
        if sql is not None:
            _oracles[name] = (lambda: with_views(views, sql())) if callable(sql) else with_views(views, sql)
        return fn

    return add


def registered() -> dict[str, Query]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return {n: s() if callable(s) else s for n, s in _oracles.items()}
