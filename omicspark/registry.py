"""The queries by name, each with the SQL that gives its rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans.bindings import Tables, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str):
    """Register a function of ``Tables`` under ``name``, with the SQL that gives its rows."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = with_views(sql, *views) if views else sql
        return f

    return add
