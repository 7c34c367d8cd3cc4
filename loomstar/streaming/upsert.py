"""A dimension kept up to date by a stream: state holds each member's newest row, and only changes are written."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from loomstar.plans.warehouse import Warehouse
from loomstar.session import stored

_STATE = "spark.sql.streaming.stateStore"
#: State lies on disk, uploads changes only, and shares one cache per executor.
STATE_SETTINGS = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.allowFAllocate": "false",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def newest_rows(rows: DataFrame, member: str, order: Sequence[str]) -> DataFrame:
    """The newest row of each member by ``order``, then by the row itself, so arrival does not matter. For a stream or a table; rows without a member are left out."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    by = F.struct(*[F.col(f"`{c}`") for c in order], *[F.col(f"`{c}`") for c in rows.columns if c not in order])
    return rows.where(F.col(f"`{member}`").isNotNull()).groupBy(member).agg(F.max_by(whole, by).alias("_row")).select("_row.*")


def upsert_stream(arrivals: DataFrame, warehouse: Warehouse, name: str, schema: StructType, order: Sequence[str], checkpoint: str) -> None:
    """Take up what has arrived in ``arrivals`` (a stream with the columns of ``schema`` and ``order``), then stop.

    The member is the second column of ``schema``. State without expiry keeps the newest row of each, on disk. A micro-batch
    writes, as the delta of its number, the members whose row differs from what the dimension has; a batch repeated after a
    failure writes the same delta again in its place, so each change is there once. Rows that arrive again, late or
    repeated, change nothing. A later call with the same ``checkpoint`` goes on with new files.
    """
    spark, member, columns = arrivals.sparkSession, schema.names[1], schema.names

    def write(batch: DataFrame, number: int) -> None:
        label = f"{number:09d}"
        cast = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
        rows = stored(cast, "batch")  # read more than once, and reading it anew would run the state again
        known = warehouse.snapshot(name, schema, before=label, only=rows.select(f"`{member}`"))
        old = known.select(F.col(f"`{member}`").alias("_member"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_old"))
        both = rows.join(old, F.col(f"`{member}`") == F.col("_member"), "left")
        changed = both.where(~F.struct(*[F.col(f"`{c}`") for c in columns]).eqNullSafe(F.col("_old"))).select(*[F.col(f"`{c}`") for c in columns])
        warehouse.publish(name, changed, label)

    with _settings(spark, STATE_SETTINGS):
        newest = newest_rows(arrivals, member, order)
        query = newest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
