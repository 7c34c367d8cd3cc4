"""Global order without a global window: dense numbers and running totals over range partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomstar.operators.skew import null_safe_join
from loomstar.session import stored

# monotonically_increasing_id() keeps the partition number above this bit and the row number below it.
_PART_BITS = 33


def _chunk() -> Column:
    return F.shiftright("_row", _PART_BITS)


def in_chunks(df: DataFrame, *order: Column | str) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with ``_row`` rising in that order.

    Stored with ``_row``, because the offsets below are computed in a second pass and must see the same
    partition boundaries. Without ``order`` the rows stay where they are.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    return stored(placed.withColumn("_row", F.monotonically_increasing_id()), "chunks")


def numbered(df: DataFrame, order: Sequence[Column | str], out: str, after: Column | None = None) -> DataFrame:
    """``row_number() over (order by ...)``, starting after ``after``, with every task numbering its own range.

    Only one count per partition goes through a single task and back out by broadcast. With an empty
    ``order`` rows are numbered as they lie, without a shuffle.
    """
    rows = in_chunks(df, *order).withColumn("_chunk", _chunk())
    sizes = rows.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_chunk", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    position = F.col("_row").bitwiseAND((1 << _PART_BITS) - 1)
    start = after if after is not None else F.lit(0).cast("bigint")
    return (
        rows.join(F.broadcast(offsets), "_chunk")
        .withColumn(out, start + F.col("_offset") + position + 1)
        .drop("_row", "_chunk", "_offset")
    )


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, unique_order: bool = True
) -> DataFrame:
    """``sum(value) over (partition by keys order by order rows unbounded preceding)``, hot keys included.

    A hot key is cut into range chunks. Each chunk is summed on its own, then raised by the total of
    the key's earlier chunks. Each boundary between chunks continues at most one key, so there are
    fewer such raises than partitions and they can be broadcast. Pass ``unique_order=False`` when
    ``keys`` and ``order`` do not identify a row: rows then get a stored tie-break, so that many
    equal rows can be cut apart too.
    """
    if not unique_order:
        df = stored(df.withColumn("_tie", F.monotonically_increasing_id()), "ties")
        order = [*order, "_tie"]
    rows = in_chunks(df, *keys, *order).withColumn("_chunk", _chunk())
    sums = rows.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    raises = sums.withColumn("_raise", F.sum("_sum").over(earlier)).where(F.col("_raise").isNotNull()).drop("_sum")
    within = Window.partitionBy(*keys, "_chunk").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    raised = null_safe_join(rows, F.broadcast(raises), [*keys, "_chunk"], "left")
    total = F.sum(value).over(within) + F.coalesce(F.col("_raise"), F.lit(0))
    return raised.withColumn(out, total).drop("_row", "_chunk", "_raise", "_tie")
