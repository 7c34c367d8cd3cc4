"""Counts, order, samples and column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loomstar.functions.keys import FIELD_SEP


def filtered_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Several ``count(*) where ...`` in one pass."""
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])


def distinct_count(df: DataFrame, column: str, out: str = "distinct_count") -> DataFrame:
    return df.agg(F.countDistinct(column).alias(out))


def group_min(df: DataFrame, key: str, column: str, only=None) -> DataFrame:
    """Least value per key; ``only`` keeps one key, as HAVING on the key does, and is pushed to the scan."""
    lowest = df.groupBy(key).agg(F.min(column).alias(f"min_{column}"))
    return lowest if only is None else lowest.where(F.col(key) == F.lit(only))


def table_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias(f"max_{column}"))


def sort_rows(df: DataFrame, *order: Column | str) -> DataFrame:
    """Distributed sort; give tie-breaking columns for a fixed order."""
    return df.orderBy(*order)


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows in ``order``: every task keeps its best ``n``."""
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int, seed: int = 0, by: Sequence[str] = ()) -> DataFrame:
    """``n`` random rows. With ``by`` (a unique key) the draw depends on the data only, not on its layout."""
    if by:
        text = F.concat_ws(FIELD_SEP, F.lit(str(seed)), *[F.col(c).cast("string") for c in by])
        return df.orderBy(F.md5(text), *by).limit(n)
    return df.orderBy(F.rand(seed)).limit(n)


def list_columns(df: DataFrame, sep: str = ",") -> DataFrame:
    """(column_name, has_list): which columns hold the separator anywhere, all in one pass."""
    found = [F.coalesce(F.bool_or(F.col(f"`{c}`").cast("string").contains(sep)), F.lit(False)).alias(c) for c in df.columns]
    return df.agg(*found).unpivot([], [F.col(f"`{c}`") for c in df.columns], "column_name", "has_list")


def shape(df: DataFrame) -> DataFrame:
    """(row_count, column_count)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.lit(len(df.columns)).cast("bigint"))


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    """Columns and their types, by name."""
    return sorted(df.dtypes)
