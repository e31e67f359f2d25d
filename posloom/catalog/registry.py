"""Where a query and its SQL twin get their common name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from posloom.catalog.portable import portable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWIN_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(query(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            TWIN_SQL[name] = sql
        return query

    return add
