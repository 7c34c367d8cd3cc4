"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loomstar.functions.keys import hash_key
from loomstar.operators.ordering import numbered
from loomstar.operators.skew import null_safe_join


def with_hash_key(df: DataFrame, key: str, namespace: str, business_key: Sequence[str]) -> DataFrame:
    return df.withColumn(key, hash_key(namespace, *business_key))


def with_dense_key(
    members: DataFrame, key: str, business_key: Sequence[str], existing: DataFrame | None = None
) -> DataFrame:
    """Dense integer keys for the members not yet in ``existing``, in business-key order after its highest key.

    ``members`` must be unique on the business key. Keys already given never change, so a re-run over
    the same ``existing`` gives the same keys. Returns the new members only.
    """
    if existing is None:
        return numbered(members, list(business_key), key)
    fresh = null_safe_join(members, existing.select(*business_key), business_key, "left_anti")
    return numbered(fresh, list(business_key), key, after=highest_key(existing, key))


def highest_key(existing: DataFrame, key: str) -> Column:
    return F.coalesce(existing.agg(F.max(key).cast("bigint")).scalar(), F.lit(0).cast("bigint"))


def with_serial(df: DataFrame, key: str, existing: DataFrame | None = None) -> DataFrame:
    """Serial key of a fact table: 1, 2, 3, ... after the highest existing key, in no particular order.

    Rows are numbered where they lie: no shuffle, and repeated rows are no burden.
    """
    after = None if existing is None else highest_key(existing, key)
    return numbered(df, [], key, after=after).select(key, *[F.col(f"`{c}`") for c in df.columns])
