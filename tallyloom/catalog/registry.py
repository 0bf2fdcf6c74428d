from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.catalog.views import with_views
from tallyloom.fixtures import Tables

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under a key, with its SQL over the views of ``views.py``."""

    def register(f: Callable[[Tables], DataFrame]):
        _queries[key] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            _oracles[key] = with_views(sql)
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)
