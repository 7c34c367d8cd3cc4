"""Column selection and batch filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loomstar.functions import clean


def subset(df: DataFrame, columns: Sequence[str], names: Mapping[str, str] | None = None) -> DataFrame:
    """Column subset, renamed on the way."""
    names = names or {}
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in columns])


def all_except(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def stamp(df: DataFrame, batch_date: str | Column, column: str = "created_date") -> DataFrame:
    """Add the batch date; the date is an argument so that a re-run gives the same rows."""
    value = F.lit(batch_date).cast("date") if isinstance(batch_date, str) else batch_date
    return df.withColumn(column, value)


def measure(df: DataFrame, out: str, left: str, right: str) -> DataFrame:
    return df.withColumn(out, F.col(left) * F.col(right))


def mask_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: clean.masked() for c in columns})


def modified_on(df: DataFrame, batch_date: str, days_back: int = 1, column: str = "modified_date") -> DataFrame:
    """Rows modified exactly ``days_back`` days before the batch date.

    On a date column the comparison is against the bare column, so it reaches the scan. On a timestamp
    it is a half-open range for the same reason.
    """
    day = clean.days_before(batch_date, days_back)
    kind = df.schema[column].dataType.typeName()
    if kind == "date":
        return df.where(F.col(column) == day)
    if kind in ("timestamp", "timestamp_ntz"):
        low, high = day.cast(kind), F.date_add(day, 1).cast(kind)
        return df.where((F.col(column) >= low) & (F.col(column) < high))
    return df.where(clean.to_day(column) == day)


def batch_of(df: DataFrame, batch_date: str, column: str = "created_date") -> DataFrame:
    """One day of staging: prunes partitions when staging is partitioned by ``column``."""
    return df.where(F.col(column) == F.lit(batch_date).cast("date"))


def newest_batch(df: DataFrame, column: str = "modified_date") -> DataFrame:
    """All rows of the newest date, by a scalar subquery on the column's maximum."""
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def equal_to(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def in_stock(df: DataFrame, product_key, quantity: int) -> DataFrame:
    return df.where((F.col("product_key") == F.lit(product_key)) & (F.col("stock") >= F.lit(quantity)))


def never_updated(df: DataFrame, column: str = "last_updated_date") -> DataFrame:
    return df.where(F.col(column).isNull())
