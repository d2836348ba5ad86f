"""The registered queries: a Spark function each, most with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Frames

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Frames`` under ``name`` with the SQL it must equal."""

    def register(build: Callable[[Frames], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Frames(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return build

    return register
