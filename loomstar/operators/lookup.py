"""Keys from dimensions to staging, from staging to sub-dimensions, and into bridges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from loomstar.operators.dedup import keep_first
from loomstar.operators.skew import hot_keys, split_join

On = Mapping[str, str] | Sequence[str]


def _pairs(on: On) -> dict[str, str]:
    return dict(on) if isinstance(on, Mapping) else {c: c for c in on}


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def combine(sales: DataFrame, products: DataFrame, users: DataFrame, product_id: str, user_id: str) -> DataFrame:
    """Sales joined to their product and user; ``id`` and columns already in sales are not repeated."""

    def side(df: DataFrame, name: str) -> DataFrame:
        fresh = [F.col(f"`{c}`") for c in df.columns if c != "id" and c not in sales.columns]
        return df.select(F.col("id").alias(name), *fresh)

    return sales.join(side(products, product_id), product_id).join(side(users, user_id), user_id)


def lookup_key(staging: DataFrame, dim: DataFrame, key: str, on: On, hot_rows: int | None = None) -> DataFrame:
    """Add ``key`` to staging by the business key (``{staging column: dimension column}``), null if unmatched.

    ``dim`` is unique on the business key. Spark broadcasts it when its size allows. When it does not,
    both sides have their own shuffle, so AQE splits a hot key on the staging side. ``hot_rows`` asks
    for the explicit split instead.
    """
    pairs = _pairs(on)
    theirs = dim.select(*[F.col(f"`{d}`").alias(f"_bk{i}") for i, d in enumerate(pairs.values())], F.col(key))
    names = [f"_bk{i}" for i in range(len(pairs))]
    kept = [F.col(f"`{c}`") for c in staging.columns if c != key]
    if hot_rows is None:
        same = _all([F.col(f"`{s}`") == F.col(n) for s, n in zip(pairs, names)])
        return staging.select(*kept).join(theirs, same, "left").drop(*names)
    mine = staging.select(*kept, *[F.col(f"`{s}`").alias(n) for s, n in zip(pairs, names)])
    joined = split_join(mine, theirs.dropna(subset=names), names, "left", hot_keys(mine, names, hot_rows))
    return joined.drop(*names)


def push_key(
    dim: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    on: On,
    order: Sequence[Column | str],
    strict: bool = False,
) -> DataFrame:
    """Set one or more keys in a dimension from a source with any number of rows per member (``{dim column: source column}``).

    The first source row in ``order`` wins. With ``strict`` a matched member whose source rows carry
    different keys fails the job. Members without a source row keep what they have.
    """
    keys = [key] if isinstance(key, str) else list(key)
    pairs = _pairs(on)
    names = [f"_bk{i}" for i in range(len(pairs))]
    values = source.select(*[F.col(f"`{s}`").alias(n) for s, n in zip(pairs.values(), names)], "*")
    first = keep_first(values, names, order).select(*names, *[F.col(k).alias(f"_new_{k}") for k in keys])
    checks = []
    if strict:
        ends = [f(k).alias(f"_{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]
        first = first.join(values.groupBy(*names).agg(*ends), names, "left")
        checks = [c for k in keys for c in (f"_min_{k}", f"_max_{k}")]
    same = _all([F.col(f"`{d}`") == F.col(n) for d, n in zip(pairs, names)])
    joined = dim.join(first.withColumn("_hit", F.lit(True)), same, "left")
    for k in keys if strict else ():
        clash = F.concat(F.lit(f"several {k} values for "), F.concat_ws(", ", *[F.col(n).cast("string") for n in names]))
        # as a filter the check runs whichever columns are asked for
        joined = joined.where(F.when(F.col(f"_min_{k}") != F.col(f"_max_{k}"), F.raise_error(clash).cast("boolean")).otherwise(True))

    def value(k: str) -> Column:
        old = F.col(k) if k in dim.columns else F.lit(None)
        return F.when(F.col("_hit"), F.col(f"_new_{k}")).otherwise(old)

    return joined.withColumns({k: value(k) for k in keys}).drop("_hit", *[f"_new_{k}" for k in keys], *checks, *names)


def push_key_through(
    dim: DataFrame,
    staging: DataFrame,
    parent: DataFrame,
    key: str,
    on: On,
    parent_on: On,
    order: Sequence[Column | str],
) -> DataFrame:
    """``push_key`` where the key sits in a parent dimension that staging reaches by ``parent_on``."""
    keyed = lookup_key(staging, parent, key, parent_on).where(F.col(key).isNotNull())
    return push_key(dim, keyed, key, on, order)


def bridge(staging: DataFrame, *keys: str) -> DataFrame:
    """Distinct key combinations; a combination with a null key cannot be part of a primary key and is left out."""
    return staging.select(*keys).dropna().distinct()


def bridge_null_rows(staging: DataFrame, *keys: str) -> DataFrame:
    """(null_rows): staging rows ``bridge`` leaves out."""
    complete = _all([F.col(k).isNotNull() for k in keys])
    return staging.agg(F.count_if(~complete).alias("null_rows"))


def bridge_through(staging: DataFrame, dims: Sequence[tuple[DataFrame, str, On]], *staging_keys: str) -> DataFrame:
    """Bridge of keys that are not in staging: each (dimension, key, business key) is joined in first.

    Only the business-key combinations, made distinct, take part in the joins.
    """
    columns = list(dict.fromkeys([*staging_keys, *[s for _, _, on in dims for s in _pairs(on)]]))
    rows = staging.select(*[F.col(f"`{c}`") for c in columns]).distinct()
    for dim, key, on in dims:
        rows = lookup_key(rows, dim, key, on)
    return bridge(rows, *[key for _, key, _ in dims], *staging_keys)


def missing_rows(source: DataFrame, target: DataFrame, on: On) -> DataFrame:
    """Source rows with no partner in the target: what an insert that skips existing rows adds."""
    return source.join(_partners(target, on), _same(on), "left_anti")


def existing_rows(source: DataFrame, target: DataFrame, on: On) -> DataFrame:
    """Source rows with a partner in the target."""
    return source.join(_partners(target, on), _same(on), "left_semi")


def _partners(target: DataFrame, on: On) -> DataFrame:
    return target.select(*[F.col(f"`{t}`").alias(f"_t{i}") for i, t in enumerate(_pairs(on).values())])


def _same(on: On) -> Column:
    return _all([F.col(f"`{s}`") == F.col(f"_t{i}") for i, s in enumerate(_pairs(on))])
