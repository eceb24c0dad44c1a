"""Named queries and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function ``(t) -> DataFrame``; ``t(name)`` reads a table."""

    def wrap(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return wrap
