"""Building blocks shared by the stars."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from loomstar.functions import clean
from loomstar.functions.keys import hash_key
from loomstar.operators import conform, dedup, project, reshape
from loomstar.operators.keys import with_dense_key, with_hash_key, with_serial
from loomstar.operators.lookup import lookup_key
from loomstar.operators.skew import null_safe_join


class Star(Mapping[str, DataFrame]):
    """Tables of a star by name. A table is built when it is first asked for, along with those it needs and no others."""

    def __init__(self, **makers: Callable[[Star], DataFrame]):
        self._makers = makers
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name](self)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return (name for name in self._makers if not name.startswith("_"))

    def __len__(self) -> int:
        return sum(1 for _ in self)


def stage(
    extract: DataFrame,
    lists: Sequence[str] = (),
    money: Sequence[str] = (),
    fills: Mapping[str, object] | None = None,
    batch_date: str | Column | None = None,
    strict_lists: bool = True,
    strict_money: bool = True,
) -> DataFrame:
    """Wide, list-packed extract to clean staging: split, explode side by side, fill, parse, dedup, stamp.

    Filling and parsing come before the explode: they act on the wide row once instead of once per item. Duplicates are looked
    for among wide rows, and only those that may have some are shuffled.
    """
    rows = extract
    if fills:
        rows = rows.withColumns({c: clean.fill(c, v) for c, v in fills.items()})
    if money:
        rows = rows.withColumns({c: clean.currency(c, strict=strict_money) for c in money})
    if lists:
        mode = "strict" if strict_lists else "pad"
        # lists are split after the search for equal rows, which then does not repeat it
        alone, repeated = dedup.split_repeats(rows, [F.col(f"`{c}`") for c in rows.columns if c not in lists])
        alone = reshape.explode_parallel(reshape.split_columns(alone, lists), lists, mode, distinct=True)
        rows = alone.unionByName(reshape.explode_parallel(reshape.split_columns(repeated, lists), lists, mode).distinct())
    else:
        rows = rows.distinct()
    return rows if batch_date is None else project.stamp(rows, batch_date)


def build_dim(
    staging: DataFrame,
    columns: Mapping[str, str] | Sequence[str],
    business_key: Sequence[str],
    key: str,
    order: Sequence[Column | str] = (),
    existing: DataFrame | None = None,
    hash_namespace: str | None = None,
    first: Callable[..., DataFrame] = dedup.keep_first,
) -> DataFrame:
    """Dimension members: chosen columns, renamed, first row per business key, surrogate key in front.

    ``columns`` maps staging names to dimension names. With ``order`` empty the whole row is the order.
    ``hash_namespace`` asks for string keys by hash, otherwise keys are dense integers. ``existing`` holds the members of
    earlier loads: they come out as they are, in front of the new ones, whose integer keys go on from theirs. ``first`` finds
    the first rows: ``dedup.keep_first_sparse`` moves less where most keys have one row.
    """
    names = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    if set(business_key) == set(names.values()):
        members = project.subset(staging, list(names), names).distinct()
    else:
        needed = [*names, *[c for c in order if isinstance(c, str) and c not in names]]
        source_key = [c for c, n in names.items() if n in business_key]
        rows = project.subset(staging, needed)
        # equal rows are one row to an order by the whole row; put together in the map tasks, they need no sorting
        rows = first(rows if order else rows.distinct(), source_key, list(order) or list(names))
        members = project.subset(rows, list(names), names)
    if hash_namespace is not None:
        if existing is not None:
            members = null_safe_join(members, existing.select(*business_key), list(business_key), "left_anti")
        keyed = with_hash_key(members, key, hash_namespace, business_key)
    else:
        keyed = with_dense_key(members, key, business_key, existing)
    return _after(existing, keyed.select(key, *[F.col(f"`{c}`") for c in members.columns]))


def _after(existing: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """Earlier members, then new ones."""
    return fresh if existing is None else existing.select(*[F.col(f"`{c}`") for c in fresh.columns]).unionByName(fresh)


def date_dim(staging: DataFrame, date_column: str, key: str = "date_key", existing: DataFrame | None = None) -> DataFrame:
    """One member per calendar day, with month and year."""
    days = staging.select(clean.to_day(date_column).alias("sale_date")).distinct()
    parts = days.withColumn("month", clean.month_of("sale_date")).withColumn("year", clean.year_of("sale_date"))
    keyed = with_dense_key(parts, key, ["sale_date"], existing).select(key, "sale_date", "month", "year")
    return _after(existing, keyed)


def load_keys(staging: DataFrame, dims: Sequence[tuple[DataFrame, str, Mapping[str, str]]]) -> DataFrame:
    """Surrogate keys of several dimensions into staging: (dimension, key, {staging column: dimension column})."""
    for dim, key, on in dims:
        staging = lookup_key(staging, dim, key, on)
    return staging


def hashed_keys(staging: DataFrame, dims: Sequence[tuple[str, str, Sequence[str]]]) -> DataFrame:
    """Hash keys of several dimensions into staging by expression, with no join: (namespace, key, staging columns of the business key).

    A null in the business key gives a null key, as a lookup would.
    """

    def key(namespace: str, columns: Sequence[str]) -> Column:
        full = reduce(lambda x, y: x & y, [F.col(f"`{c}`").isNotNull() for c in columns])
        return F.when(full, hash_key(namespace, *columns))

    return staging.withColumns({name: key(namespace, columns) for namespace, name, columns in dims})


def build_fact(
    staging: DataFrame,
    measures: Mapping[str, Column],
    keys: Sequence[str],
    grain: str | Sequence[str] = "rows",
    order: Sequence[Column | str] = (),
    serial: str | None = None,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Fact rows from keyed staging.

    ``grain`` is ``rows`` (every staging row), ``distinct`` (every distinct tuple) or the columns of
    which one row each is kept, the first in ``order``. ``serial`` names the fact's own integer key, which goes on after
    those in ``existing``; numbering rows stores them once.
    """
    chosen = [m.alias(name) for name, m in measures.items()] + [F.col(k) for k in keys]
    if grain == "rows":
        fact = staging.select(*chosen)
    elif grain == "distinct":
        fact = staging.select(*chosen).distinct()
    else:
        fact = dedup.keep_first(staging, list(grain), list(order) or staging.columns).select(*chosen)
    return fact if serial is None else with_serial(fact, serial, existing)


def stage_movies(movies: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Movie table to staging: one row per genre and actor, typed, filled, without duplicates.

    All casts happen on the movie row, ahead of the two explodes. Duplicates are looked for among movie rows, and only those
    that may have some are shuffled.
    """
    stars = ["Star1", "Star2", "Star3", "Star4"]
    typed = movies.withColumn("Gross", clean.strip_thousands("Gross"))
    typed = conform.coerce(typed, {c: t for c, t in types.items() if c != "Genre"})
    kept = [c for c in typed.columns if c not in (*stars, "Genre")]
    typed = conform.fill_by_type(typed, kept)
    genres = F.coalesce(reshape.all_differ(clean.pieces("Genre", trim=True)), F.lit(True))
    # stars that are not text are filled otherwise: all of their rows are compared
    text = all(typed.schema[s].dataType.typeName() == "string" for s in stars)
    actors = reshape.all_differ(F.array(*[F.coalesce(s, F.lit(conform.TEXT_DEFAULT)) for s in stars])) if text else F.lit(False)

    def unpacked(rows: DataFrame) -> DataFrame:
        melted = reshape.melt(reshape.explode_trim(rows, "Genre"), stars, "Actor", "Actor_Name").drop("Actor")
        return conform.fill_by_type(melted)

    return dedup.explode_distinct(typed, [F.col(f"`{c}`") for c in kept], genres & actors, unpacked)
