"""Schema-driven coercion, default fills, and reports on what did not fit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from loomstar.functions import clean

# Defaults by type group.
NUMBER_DEFAULT = 0
TEXT_DEFAULT = "NA"
FLAG_DEFAULT = False

_COERCE = {
    "string": lambda c: F.col(c).cast("string"),
    "bigint": clean.to_whole,
    "double": clean.to_number,
    "date": lambda c: clean.to_day(c, strict=False),
    "timestamp": lambda c: F.col(c).try_cast("timestamp"),
}


def coerced(column: str, kind: str) -> Column:
    """``column`` as ``kind``, null where it does not fit."""
    return _COERCE[kind](column)


def coerce(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: coerced(c, kind) for c, kind in schema.items()})


def misfits(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """(column_name, misfit_count): values present in the raw data that the coercion turns to null.

    All columns are counted in one pass.
    """
    counts = df.agg(*[F.count_if(F.col(c).isNotNull() & coerced(c, k).isNull()).alias(c) for c, k in schema.items()])
    return counts.unpivot([], [F.col(f"`{c}`") for c in schema], "column_name", "misfit_count")


def fill_by_type(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls (and NaN) to 0, 'NA' or False according to each column's type; of all columns or those named."""
    for default in (NUMBER_DEFAULT, TEXT_DEFAULT, FLAG_DEFAULT):
        df = df.na.fill(default, None if columns is None else list(columns))
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: clean.nan_to_null(c) for c in floats})


def date_rules(
    df: DataFrame, dates: Mapping[str, tuple[str, str]], ordered: Mapping[str, tuple[str, str]] | None = None
) -> DataFrame:
    """(rule, violations) for date columns, in one pass.

    ``dates`` maps a column to the first and last day allowed; a value that is no date (2025-02-30)
    breaks its ``valid`` rule. ``ordered`` maps a rule name to a (start, end) pair with end >= start.
    """
    rules: dict[str, Column] = {}
    day = {c: clean.to_day(c, strict=False) for c in dates}
    for c, (low, high) in dates.items():
        rules[f"{c}_valid"] = F.col(c).isNotNull() & day[c].isNull()
        rules[f"{c}_in_range"] = ~day[c].between(F.lit(low).cast("date"), F.lit(high).cast("date"))
    for name, (start, end) in (ordered or {}).items():
        rules[name] = clean.to_day(end, strict=False) < clean.to_day(start, strict=False)
    counts = df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return counts.unpivot([], [F.col(f"`{r}`") for r in rules], "rule", "violations")
