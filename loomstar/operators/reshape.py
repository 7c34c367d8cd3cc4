"""Multi-valued and nested columns to plain rows. Everything here is narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from loomstar.functions import clean


def split_columns(df: DataFrame, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Delimited text columns to arrays."""
    return df.withColumns({c: clean.pieces(c, sep) for c in columns})


def _at_least_one(column: str) -> Column:
    """A null or empty list counts as one null element, so the row survives the explode."""
    c = F.col(column)
    return F.when(F.size(c) > 0, c).otherwise(F.array(F.lit(None)))


def _lengths_agree(columns: Sequence[str]) -> Column:
    sizes = [F.size(_at_least_one(c)) for c in columns]
    agree = F.lit(True)
    for size in sizes[1:]:
        agree = agree & (size == sizes[0])
    return agree


def explode_parallel(df: DataFrame, columns: Sequence[str], mode: str = "strict", distinct: bool = False) -> DataFrame:
    """Explode several list columns side by side.

    ``strict`` fails on a row whose lists differ in length; ``pad`` fills the short ones with null.
    ``split_ragged`` takes such rows out beforehand. With ``distinct`` items of one row that are equal side by side come out once.
    """
    if mode not in ("strict", "pad"):
        raise ValueError(f"unknown mode {mode!r}")
    zipped = F.arrays_zip(*[_at_least_one(c).alias(c) for c in columns])
    if mode == "strict":
        lengths = F.concat_ws(", ", *[F.size(_at_least_one(c)).cast("string") for c in columns])
        problem = F.concat(F.lit(f"list lengths differ in {', '.join(columns)}: "), lengths)
        zipped = F.when(_lengths_agree(columns), zipped).otherwise(F.raise_error(problem))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    fields = [f"_item_{i}" for i in range(len(columns))]
    rows = df
    if distinct:
        # where the items of one list all differ there is nothing to compare; the items of other rows are sorted, and equal ones stand together
        rows = rows.withColumn("_varied", _varied(columns)).withColumn("_sorted", F.when(~F.col("_varied"), F.array_sort(zipped)))
        once = F.filter("_sorted", lambda x, i: (i == 0) | ~x.eqNullSafe(F.get("_sorted", i - 1)))
        rows = rows.withColumn("_once", F.when(~F.col("_varied"), once))
        zipped = F.when(F.col("_varied"), zipped).otherwise(F.col("_once"))
    rows = rows.select(*kept, F.inline(zipped).alias(*fields))
    where = dict(zip(columns, fields))
    return rows.select(*[F.col(where[c]).alias(c) if c in where else F.col(f"`{c}`") for c in df.columns])


def _varied(columns: Sequence[str]) -> Column:
    """Whether lists are of one length and the items of one of them all differ; false for a null list."""
    differ = reduce(lambda x, y: x | y, [F.coalesce(all_differ(F.col(f"`{c}`")), F.lit(False)) for c in columns])
    alike = reduce(lambda x, y: x & y, [F.size(f"`{c}`") == F.size(f"`{columns[0]}`") for c in columns])
    return F.coalesce(differ & alike, F.lit(False))


def all_differ(items: Column) -> Column:
    """Whether no item of an array occurs twice; null for a null array."""
    return F.size(F.array_distinct(items)) == F.size(items)


def split_ragged(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose lists agree in length, rows whose lists do not)."""
    agree = _lengths_agree(columns)
    return df.where(agree), df.where(~agree)


def explode_trim(df: DataFrame, column: str, sep: str = ",") -> DataFrame:
    """One row per item of a delimited text, blanks around items removed; null text keeps its row."""
    item = F.explode_outer(clean.pieces(column, sep, trim=True)).alias(column)
    return df.select(*[item if c == column else F.col(f"`{c}`") for c in df.columns])


def _leaves(kind: T.StructType, path: Column, name: str, sep: str) -> list[Column]:
    out: list[Column] = []
    for field in kind.fields:
        child, label = path.getField(field.name), f"{name}{field.name}"
        if isinstance(field.dataType, T.StructType):
            out += _leaves(field.dataType, child, f"{label}{sep}", sep)
        else:
            out.append(child.alias(label))
    return out


def flatten_struct(df: DataFrame, column: str, sep: str = ".") -> DataFrame:
    """Replace a struct column by its leaves, at any depth. Leaves are named from inside the struct,

    inner levels joined by ``sep``: ``address.geolocation.lat`` becomes ``geolocation.lat``.
    """
    kind = df.schema[column].dataType
    kept = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*kept, *_leaves(kind, F.col(f"`{column}`"), "", sep))


def explode_structs(df: DataFrame, column: str) -> DataFrame:
    """One row per struct of an array, fields as columns; a row with no elements is kept with nulls."""
    kept = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*kept, F.inline_outer(F.col(f"`{column}`")))


def melt(df: DataFrame, values: Mapping[str, str] | Sequence[str], var: str, val: str, ids: Sequence[str] | None = None) -> DataFrame:
    """Repeated columns to rows; null values keep their row. ``ids`` defaults to all other columns."""
    values = list(values)
    ids = list(ids) if ids is not None else [c for c in df.columns if c not in values]
    return df.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in values], var, val)
