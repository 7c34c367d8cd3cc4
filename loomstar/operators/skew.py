"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

# Defaults of ``hot_rows`` and ``hot_share``: a key is hot when it has at least so many rows and at least such a share of all
# rows. The share bounds the number of hot keys at 1 / hot_share however large the table, so they can be broadcast. Both only
# choose how rows travel; the result is the same.
HOT_ROWS = 1_000_000
HOT_SHARE = 1e-5


def hot_among(counts: DataFrame, keys: Sequence[str], rows: str = "_n", hot_rows: int = HOT_ROWS, hot_share: float = HOT_SHARE) -> DataFrame:
    """The hot keys of a table of row counts per key."""
    least = F.greatest(F.lit(float(hot_rows)), counts.agg(F.sum(rows)).scalar() * hot_share)
    return counts.where(F.col(rows) >= least).select(*keys)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, hot_share: float = HOT_SHARE) -> DataFrame:
    """The hot keys of a table, counted with map-side combine."""
    return hot_among(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, hot_rows=hot_rows, hot_share=hot_share)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on same-named keys in which null equals null; the left side's keys are kept."""
    theirs = {k: f"_right_{k}" for k in keys}
    right = right.withColumnsRenamed(theirs)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in theirs.items()])
    return left.join(right, same, how).drop(*theirs.values())


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, hot: DataFrame) -> DataFrame:
    """Null-safe join for ``how`` in inner, left, left_semi, left_anti; ``right`` unique on ``keys``.

    Rows of hot keys meet the few right-hand rows they need in a map-side join and are never shuffled;
    all others go through the ordinary join. AQE drops the hot branch at run time when ``hot`` is
    empty. Meant for a right side that is itself an aggregate on ``keys``: there AQE may find no
    shuffle of its own to split.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join {how!r}")
    few = F.broadcast(hot.select(*keys))
    hot_right = F.broadcast(null_safe_join(right, few, keys, "left_semi"))
    hot_rows = null_safe_join(null_safe_join(left, few, keys, "left_semi"), hot_right, keys, how)
    cold_rows = null_safe_join(null_safe_join(left, few, keys, "left_anti"), right, keys, how)
    return cold_rows.unionByName(hot_rows)
