"""Queries by key, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from framelake.plans.fixtures import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Registers f(tables) under key."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[key] = with_views(sql)
        return f

    return add
