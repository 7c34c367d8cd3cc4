"""Constraints as checks: each returns the offending rows, none when the constraint holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count. A key with a null is not compared, as in SQL."""
    known = df.dropna(subset=list(keys))
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def foreign_key_violations(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows whose key is set but absent from the dimension."""
    known = dim.select(F.col(dim_key or key).alias(key))
    return df.where(F.col(key).isNotNull()).join(known, key, "left_anti")


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated keys, and keys with a null part, with their row count."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.where((F.col("row_count") > 1) | has_null)
