"""Where the checks register their Spark query and, where one exists, the same query in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def check(key: str, sql: str | None = None):
    def register(fn):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn
    return register


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A bundled table. Its footer is read once per session, its rows by each query."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _TABLES[key]
