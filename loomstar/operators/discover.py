"""What a table's columns have to do with each other: minimal unique column sets, and list columns of equal length."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from loomstar.functions import clean

#: Standard error of the distinct-count sketches, and how many of them an estimate must lie below the row count to rule a set out.
ERROR, MARGIN = 0.02, 6
#: One hash value in so many is looked at, over all rows, before a set is grouped in full.
SLICES = 64


def _named(columns: Sequence[str]) -> Column:
    """Two 64-bit hashes of a combination of values; nulls are values of their own."""
    parts = [F.col(f"`{c}`") for c in columns] + [F.col(f"`{c}`").isNull() for c in columns]
    return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("key"), *parts).alias("h2"))


def unique_sets(df: DataFrame, columns: Sequence[str] | None = None, most: int = 3) -> list[tuple[str, ...]]:
    """Minimal sets of up to ``most`` columns on which no two rows agree, smaller ones first, in the order of the columns.

    Level by level: a set is looked at only if none of its subsets is unique. One pass of sketches over all sets of a level
    rules out those with far fewer distinct values than rows; one pass over a slice of the hashes rules out those that occur
    twice there, as most that are not unique do; one exact pass, grouping hashes of what is left, decides. Nulls are equal to
    each other. A table of at most one row has the single columns.
    """
    columns = list(columns or df.columns)
    rows = df.select(*[F.col(f"`{c}`") for c in columns])
    total, found = rows.count(), []
    for size in range(1, most + 1):
        sets = [s for s in combinations(columns, size) if not any(set(u) <= set(s) for u in found)]
        if not sets:
            break
        sketched = rows.agg(*[F.approx_count_distinct(_named(s), ERROR).alias(str(i)) for i, s in enumerate(sets)]).first()
        likely = [s for i, s in enumerate(sets) if sketched[i] >= total * (1 - MARGIN * ERROR)]
        if not likely:
            continue
        twice = _refuted(rows, likely, SLICES)
        likely = [s for s in likely if s not in twice]
        refuted = _refuted(rows, likely) if likely else set()
        found += [s for s in likely if s not in refuted]
    return found


def _refuted(rows: DataFrame, sets: Sequence[tuple[str, ...]], slices: int = 1) -> set[tuple[str, ...]]:
    """Those of ``sets`` with a value that occurs twice, among the hashes of one slice of ``slices``."""
    told = rows.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _named(s).alias("v")) for i, s in enumerate(sets)])).alias("s"))
    told = told.select("s.i", "s.v.h1", "s.v.h2")
    if slices > 1:
        told = told.where(F.pmod("h1", F.lit(slices)) == 0)
    else:  # nearly all values differ: to group them ahead of the shuffle as well would only fill memory
        told = told.repartition("i", "h1", "h2")
    twice = told.groupBy("i", "h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("i").distinct()
    return {sets[r["i"]] for r in twice.collect()}  # numbers of sets, not rows


def _length(column: str, sep: str | None) -> Column:
    items = F.col(f"`{column}`") if sep is None else clean.pieces(F.col(f"`{column}`"), sep)
    return F.greatest(F.coalesce(F.size(items), F.lit(1)), F.lit(1))


def length_differences(df: DataFrame, lists: Sequence[str], sep: str | None = ",") -> DataFrame:
    """One row per pair of list columns: left, right, least and greatest difference of their lengths over all rows.

    One pass and one aggregate, of two numbers per pair. ``sep`` parts packed lists (None: arrays). A null or empty list counts
    as one null item, as it does when lists are exploded. No rows give nulls.
    """
    pairs = list(combinations(lists, 2))
    sizes = df.select(*[_length(c, sep).alias(f"n{i}") for i, c in enumerate(lists)])
    at = {c: f"n{i}" for i, c in enumerate(lists)}
    gap = {p: F.col(at[p[0]]) - F.col(at[p[1]]) for p in pairs}
    found = sizes.agg(*[F.struct(F.min(gap[p]).alias("least"), F.max(gap[p]).alias("greatest")).alias(f"p{k}") for k, p in enumerate(pairs)])
    told = F.array(*[F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"p{k}.least").alias("least"), F.col(f"p{k}.greatest").alias("greatest")) for k, (a, b) in enumerate(pairs)])
    return found.select(F.inline(told))


def list_groups(df: DataFrame, lists: Sequence[str], sep: str | None = ",") -> list[list[str]]:
    """``lists`` in groups whose lengths agree in every row, each fit for ``reshape.explode_parallel``; a column that agrees with none is a group of its own."""
    if len(lists) < 2:
        return [[c] for c in lists]
    # to agree always is transitive, so the first member of a group speaks for it
    same = {(r["left"], r["right"]) for r in length_differences(df, lists, sep).collect() if r["least"] in (0, None) and r["greatest"] in (0, None)}
    groups: list[list[str]] = []
    for c in lists:
        home = next((g for g in groups if (g[0], c) in same), None)
        if home is None:
            groups.append([c])
        else:
            home.append(c)
    return groups
