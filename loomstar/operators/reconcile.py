"""Whether two tables hold the same rows, and where they do not: fingerprints that do not depend on order, then the keys that differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from loomstar.operators.audit import FAIL, PASS
from loomstar.session import stored

#: Key ranges that are compared first. A row of each side's table of ranges is one range, so a list of them may be broadcast.
RANGES = 1 << 14

_SUMS = ("_rows", "_a", "_b", "_c", "_d")


def _plain(df: DataFrame, name: str) -> Column:
    """A column as it can be hashed: nested values as text, because their inner nulls do not enter a hash."""
    nested = isinstance(df.schema[name].dataType, (ArrayType, MapType, StructType))
    return F.to_json(F.struct(F.col(f"`{name}`").alias("v")), {"ignoreNullFields": "false"}) if nested else F.col(f"`{name}`")


def _sums(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Row count and the sums of four 32-bit parts of two 64-bit row hashes: equal for equal multisets, in any order, and sums do not cancel repeated rows as a parity would."""
    whole = F.struct(*[_plain(df, c) for c in columns])
    # nulls do not enter a hash, so which columns are null does
    nulls = F.array(*[F.col(f"`{c}`").isNull() for c in columns])
    halves = []
    for seed in (0, 1):
        h = F.xxhash64(F.lit(seed), whole, nulls)
        halves += [h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)]
    return [F.count(F.lit(1)).alias("_rows"), *[F.sum(h).alias(n) for h, n in zip(halves, _SUMS[1:])]]


def _range(keys: Sequence[str], ranges: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), *[F.col(f"`{k}`") for k in keys], *[F.col(f"`{k}`").isNull() for k in keys]), F.lit(ranges))


def fingerprint(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, ranges: int = RANGES) -> DataFrame:
    """One row per key range that has rows: _range, _rows and four sums. Adding up in tasks comes first, so only ranges are shuffled.

    A fingerprint can be stored beside a table and compared later without reading the table again.
    """
    return df.groupBy(_range(keys, ranges).alias("_range")).agg(*_sums(df, list(columns or df.columns)))


def _unequal(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Groups whose sums differ, or that one side lacks, with both row counts; nulls in ``on`` are equal."""
    right = right.withColumnsRenamed({c: f"r{c}" for c in (*on, *_SUMS)})
    same = F.lit(True)
    for c in on:
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`r{c}`"))
    both = left.join(right, same, "full")
    there = [F.col(f"r{n}") for n in _SUMS]
    differ = F.lit(False)
    for mine, theirs in zip(_SUMS, there):
        differ = differ | ~F.col(mine).eqNullSafe(theirs)
    # a count tells a missing side from a null key
    named = [F.when(F.col("_rows").isNotNull(), F.col(f"`{c}`")).otherwise(F.col(f"`r{c}`")).alias(c) for c in on]
    return both.where(differ).select(*named, F.coalesce("_rows", F.lit(0)).alias("left_rows"), F.coalesce("r_rows", F.lit(0)).alias("right_rows"))


def differing_ranges(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, ranges: int = RANGES) -> DataFrame:
    """Key ranges in which the tables differ: one pass over the compared columns of each side."""
    columns = list(columns or left.columns)
    return _unequal(fingerprint(left, keys, columns, ranges), fingerprint(right, keys, columns, ranges), ["_range"])


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, ranges: int = RANGES) -> DataFrame:
    """Keys whose rows are not the same multiset on both sides: the keys, left_rows, right_rows, kind.

    ``kind`` is ``missing`` (no row on the right), ``extra`` (none on the left), ``count`` (more rows on one side), or
    ``changed``. ``columns`` (all, unless given) are compared and must hold the keys' names on both sides. First whole ranges of
    keys are compared; only rows of ranges that differ are then grouped by key. Where nothing differs no row is moved.
    """
    columns = list(columns or left.columns)
    found = stored(differing_ranges(left, right, keys, columns, ranges).select("_range"), "ranges")
    # at most `ranges` numbers
    wanted = F.broadcast(found.withColumnRenamed("_range", "_wanted"))

    def by_key(df: DataFrame) -> DataFrame:
        within = df.select(*columns, _range(keys, ranges).alias("_range")).join(wanted, F.col("_range") == F.col("_wanted"), "left_semi")
        return within.groupBy(*keys).agg(*_sums(within, columns))

    unequal = _unequal(by_key(left), by_key(right), list(keys))
    mine, theirs = F.col("left_rows"), F.col("right_rows")
    kind = F.when(theirs == 0, "missing").when(mine == 0, "extra").when(mine != theirs, "count").otherwise("changed")
    return unequal.withColumn("kind", kind)


def content_audit(left: DataFrame, right: DataFrame, keys: Sequence[str], table_name: str, columns: Sequence[str] | None = None, ranges: int = RANGES) -> DataFrame:
    """One row: table_name, left_rows, right_rows, different_keys, status. It passes only if the contents agree, not the counts alone."""
    columns = list(columns or left.columns)
    totals = [F.coalesce(df.agg(F.count(F.lit(1)).alias("n")).scalar(), F.lit(0)) for df in (left, right)]
    found = differences(left, right, keys, columns, ranges).agg(F.count(F.lit(1)).alias("different_keys"))
    return found.select(
        F.lit(table_name).alias("table_name"), totals[0].alias("left_rows"), totals[1].alias("right_rows"), "different_keys",
        F.when(F.col("different_keys") == 0, PASS).otherwise(FAIL).alias("status"),
    )
