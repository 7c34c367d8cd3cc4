"""Upsert and merge as joins that yield the next snapshot of the target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomstar.operators.lookup import missing_rows
from loomstar.session import stored

CREATED, UPDATED = "created_date", "last_updated_date"


def _lacks_key(keys: Sequence[str]) -> Column:
    absent = F.lit(False)
    for k in keys:
        absent = absent | F.col(k).isNull()
    return absent


def _last_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order``, and ``_n``, the number of rows it stands for.

    One aggregate with map-side combine; a null key conflicts with nothing, so its rows all stay. Stored,
    because the update and the search for new rows both read it.
    """
    payload = F.struct(*[F.col(f"`{c}`") for c in batch.columns])
    keyed = batch.dropna(subset=list(keys))
    ordered = F.struct(*[F.col(c) for c in order]) if order else F.lit(0)
    grouped = keyed.groupBy(*keys).agg(F.max_by(payload, ordered).alias("_row"), F.count(F.lit(1)).alias("_n"))
    unkeyed = batch.where(_lacks_key(keys)).withColumn("_n", F.lit(1).cast("bigint"))
    return stored(grouped.select("_row.*", "_n").unionByName(unkeyed), "batch")


def _apply(
    target: DataFrame,
    updates: DataFrame,
    inserts: DataFrame,
    keys: Sequence[str],
    set_columns: Sequence[str],
    on_update: Mapping[str, Column],
    on_insert: Mapping[str, Column],
    guard: Column | None = None,
    met: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Matched target rows take ``set_columns`` and ``on_update``; ``inserts`` without a match are added.

    The target is on the preserved side of a left join and only its keys are read to find new rows, so
    a batch small enough to broadcast moves none of the target. The keys that both have are stored: where they are few Spark
    broadcasts them, and a large batch of new rows is not moved. ``met`` says that the batch has all keys of the target, ``parts``
    into how many partitions the target is dealt by its keys. Expressions in ``on_update`` and ``on_insert`` name source columns
    with the prefix ``s_`` and target columns bare.
    """
    here = target.select(*keys)
    touched = stored(here if met else here.join(updates.select(*keys), list(keys), "left_semi"), "touched")
    shared = updates.join(touched, list(keys), "left_semi")
    shared = shared if parts is None else shared.repartition(parts, *keys)
    source = shared.withColumnsRenamed({c: f"s_{c}" for c in updates.columns}).withColumn("_hit", F.lit(True))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"s_{k}"))
    hit = F.col("_hit").isNotNull()

    def updated(c: str) -> Column:
        if c in on_update:
            return F.when(hit, on_update[c]).otherwise(F.col(c)).alias(c)
        if c in set_columns:
            return F.when(hit, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c)
        return F.col(c)

    matched = target.join(source, same, "left")
    # as a filter the check runs whichever columns are asked for
    kept = (matched if guard is None else matched.where(~hit | guard)).select(*[updated(c) for c in target.columns])
    fresh = missing_rows(inserts, touched, keys)
    fresh = fresh.withColumnsRenamed({c: f"s_{c}" for c in inserts.columns})

    def inserted(field) -> Column:
        c = field.name
        if c in on_insert:
            value = on_insert[c]
        elif c in inserts.columns:
            value = F.col(f"s_{c}")
        else:
            value = F.lit(None)
        return value.cast(field.dataType).alias(c)

    return kept.unionByName(fresh.select(*[inserted(f) for f in target.schema.fields]))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    set_columns: Sequence[str],
    batch_date: str,
    order: Sequence[str] = (),
    unique: bool = False,
    met: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Insert-or-update of a batch sent row by row in ``order``: the last row of a key wins.

    A matched row is stamped ``last_updated_date``. A new row is stamped ``created_date``, and
    ``last_updated_date`` as well if the batch holds its key more than once, because the later row
    then updates the earlier. ``unique`` says that the batch is a table that holds no key twice and
    saves reducing it; ``met`` says that the batch has the keys of all target rows and saves the search for them;
    ``parts`` is the number of buckets of a target in buckets of the keys, which then stays where it is.
    """
    day = F.lit(batch_date).cast("date")
    source = batch.withColumn("_n", F.lit(1)) if unique else _last_per_key(batch, keys, order)
    stamps = {UPDATED: day}
    new = {CREATED: day, UPDATED: F.when(F.col("s__n") > 1, day)}
    present = [c for c in (CREATED, UPDATED) if c in target.columns]
    return _apply(
        target,
        source,
        source,
        keys,
        set_columns,
        {c: stamps[c] for c in present if c in stamps},
        {c: new[c] for c in present},
        met=met,
        parts=parts,
    )


def merge(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    set_columns: Sequence[str],
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
    strict: bool = True,
    order: Sequence[str] = (),
) -> DataFrame:
    """MERGE: update the matched, insert the rest.

    Under ``strict`` two source rows for one matched target row fail the job, and unmatched source rows
    are all inserted. Otherwise the source is first reduced to the last row per key in ``order``.
    ``on_update`` and ``on_insert`` set further columns, with source columns named ``s_<name>``.
    """
    source = _last_per_key(batch, keys, order)
    guard = None
    if strict:
        where = F.concat(F.lit("several source rows for target row "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
        guard = F.when(F.col("s__n") > 1, F.raise_error(where)).otherwise(F.lit(True)).cast("boolean")
    inserts = batch if strict else source
    return _apply(target, source, inserts, keys, set_columns, on_update or {}, on_insert or {}, guard)


def stamp_today(batch_date: str) -> tuple[dict[str, Column], dict[str, Column]]:
    """(on_update, on_insert) for a merge that stamps the batch date."""
    day = F.lit(batch_date).cast("date")
    return {UPDATED: day}, {CREATED: day}


def stamp_from_source() -> tuple[dict[str, Column], dict[str, Column]]:
    """(on_update, on_insert) for a merge that carries the source row's own ``created_date``."""
    theirs = F.col(f"s_{CREATED}")
    return {CREATED: theirs, UPDATED: theirs}, {CREATED: theirs}


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Insert that leaves existing rows alone; the first row of a new key in ``order`` is added.

    A null in a key conflicts with nothing, so all such rows are added.
    """
    order = list(order) or list(batch.columns)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    full = batch.dropna(subset=list(keys))
    first = full.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    unkeyed = batch.where(_lacks_key(keys))
    return target.unionByName(missing_rows(first, target, keys), allowMissingColumns=True).unionByName(unkeyed, allowMissingColumns=True)
