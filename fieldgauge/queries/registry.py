"""Name -> (Spark query, SQL statement of the same result)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldgauge.queries.bindings import SQL_VIEWS, Tables, finish

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables`.  ``sql`` may use the binding views; extra
    views start with a comma, as in ``, extra AS (...) SELECT ...``."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in SPARK:
            raise ValueError(f"query {name} exists")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return finish(build(Tables(spark, folder)))

        run.__name__ = name
        SPARK[name] = run
        if sql is not None:
            SQL[name] = SQL_VIEWS + sql
        return build

    return add
