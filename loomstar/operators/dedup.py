"""Duplicates, first and latest rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomstar.operators.skew import HOT_ROWS, HOT_SHARE, hot_among, split_join
from loomstar.session import stored


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``; null keys count as equal.

    ``row_number() = 1`` lets Spark keep one row per key in every map task before the shuffle
    (WindowGroupLimit), so a key with a third of all rows costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def _repeated(df: DataFrame, values: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_hash``, a hash of ``values``, and the hashes that occur more than once (one column).

    Equal values have equal hashes, so a row of another hash has no equal; a hash may also be met by chance. Only the
    hashes are shuffled, and the few that occur more than once are stored; Spark broadcasts them when their size allows.
    ``df`` is read again after that and must give the same rows each time.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*values, *[v.isNull() for v in values]))
    counts = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return hashed, stored(counts.select("_hash"), "repeated")


def split_repeats(df: DataFrame, values: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that are alone with their ``values``, rows that may not be). The second part costs nothing if no hash occurs twice."""
    hashed, repeated = _repeated(df, values)
    return tuple(hashed.join(repeated, "_hash", how).drop("_hash") for how in ("left_anti", "left_semi"))


def explode_distinct(wide: DataFrame, kept: Sequence[Column], varied: Column, explode: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``explode(wide).distinct()``, for a narrow ``explode`` that leaves ``kept`` as they are; it moves only rows that may have an equal.

    ``varied`` tells wide rows whose own items are all different. Where such a row is alone with its ``kept`` values, so is
    each of its items, which then need no comparison; all other rows are exploded and compared.
    """
    hashed, repeated = _repeated(wide, kept)
    told = hashed.join(repeated.withColumn("_repeats", F.lit(True)), "_hash", "left").drop("_hash")
    alone = F.col("_repeats").isNull() & F.coalesce(varied, F.lit(False))
    return explode(told.where(alone).drop("_repeats")).unionByName(explode(told.where(~alone).drop("_repeats")).distinct())


def keep_first_sparse(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """``keep_first`` for keys of which most have one row: such rows are neither sorted nor shuffled."""
    alone, repeated = split_repeats(df, [F.col(f"`{k}`") for k in keys])
    return alone.unionByName(keep_first(repeated, keys, order))


def _flip(c: Column | str) -> Column:
    return F.col(c).desc() if isinstance(c, str) else c.desc()


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order``."""
    return keep_first(df, keys, [_flip(c) for c in order])


def latest_row(df: DataFrame, keys: Sequence[str], by: str, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key with the greatest ``by``."""
    return keep_first(df, keys, [F.col(by).desc(), *tie_break])


def latest_ties(df: DataFrame, keys: Sequence[str], by: str, hot_rows: int = HOT_ROWS, hot_share: float = HOT_SHARE) -> DataFrame:
    """All rows per key that share the greatest ``by``, as ``rank() = 1`` would give.

    The greatest values are an aggregate over the two columns alone. Rows below their task's own greatest value are cut by
    a window over (key, salt), whose group limit stands in front of its shuffle, so only tied rows travel; the salt spreads
    a key with many ties. What is left is joined with the greatest values, hot keys map-side. Null keys form a group.
    """
    salted = df.withColumn("_salt", F.spark_partition_id())
    near = salted.withColumn("_rank", F.rank().over(Window.partitionBy(*keys, "_salt").orderBy(F.col(by).desc_nulls_last()))).where("_rank = 1").drop("_rank", "_salt")
    summary = df.groupBy(*keys).agg(F.max(by).alias("_top"), F.count(F.lit(1)).alias("_n"))
    hot = hot_among(summary, keys, hot_rows=hot_rows, hot_share=hot_share)
    joined = split_join(near, summary.drop("_n"), keys, "inner", hot)
    return joined.where(F.col(by).eqNullSafe(F.col("_top"))).drop("_top")


def duplicates(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, hot_share: float = HOT_SHARE) -> DataFrame:
    """Every row whose key occurs more than once; null keys count as equal."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    hot = hot_among(counts, keys, hot_rows=hot_rows, hot_share=hot_share)
    return split_join(df, counts.drop("_n"), keys, "left_semi", hot)
