"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables, read lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        setattr(self, name, table)
        return table


def query(sql: str | None = None, name: str | None = None):
    """Register a function over ``Tables`` under its own name."""

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        QUERIES[key] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            SQL[key] = sql
        return fn

    return register
