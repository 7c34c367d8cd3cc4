"""Collects the queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomstar.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables by name: ``t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(tune(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
