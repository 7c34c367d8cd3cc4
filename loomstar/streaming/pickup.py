"""Take in the lake objects that arrived since the last run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def pick_up(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    fmt: str = "csv",
    files_per_batch: int | None = None,
    **options,
) -> int:
    """Feed each new file under ``source`` to ``handle(rows, batch_id)`` once, then stop.

    The checkpoint remembers the files taken. A batch that failed part-way is offered again under the
    same id, so ``handle`` should replace what it wrote under that id. A record that does not fit fails the
    batch, unless ``mode`` says otherwise. Returns the number of batches run.
    """
    strict = {"mode": "FAILFAST"} if fmt in ("csv", "json") else {}
    if fmt == "csv":
        strict |= {"escape": '"', "enforceSchema": False, "columnPruning": False}
    reader = spark.readStream.schema(schema).format(fmt).options(**strict | options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    ran: list[int] = []

    def run(rows: DataFrame, batch_id: int) -> None:
        handle(rows, batch_id)
        ran.append(batch_id)

    query = (
        reader.load(source)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(run)
        .start()
    )
    query.awaitTermination()
    return len(ran)


def append_to_raw(path: str) -> Callable[[DataFrame, int], None]:
    """A handler that adds each batch to raw staging as its own ``batch_id`` partition."""

    def handle(rows: DataFrame, batch_id: int) -> None:
        stamped = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(path)

    return handle
