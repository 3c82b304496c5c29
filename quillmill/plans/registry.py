"""Where queries and the SQL they are checked against are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmill.session import ship_package, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(*tables: str, sql: str | None = None):
    def deco(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return f(*[table(spark, sf_dir, n) for n in tables])

        if f.__name__ in QUERIES:
            raise ValueError(f"two queries {f.__name__}")
        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return deco
