"""Exact deduplication by a stream over digests with keyed state that never expires.

Arrivals (identifier, digest, locator of the content) are streamed into state kept on disk by RocksDB, one entry per digest:
the smallest identifier, where its content lies and how many rows arrived. What has arrived more than once is then compared
byte for byte, so equal digests of different texts do not drop a document.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loomstar.llm.tables import column, located, sized
from loomstar.session import scratch_path, stored

_STATE = "spark.sql.streaming.stateStore"
#: State on disk. There is a store for each partition, so none sets disk aside ahead of need, and a batch uploads its changes only.
STATE_SETTINGS = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.allowFAllocate": "false",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",  # one cache for all stores of an executor
    f"{_STATE}.rocksdb.maxMemoryUsageMB": "128",
}
#: Files of arrivals per micro-batch; state lives on from one to the next.
FILES_PER_BATCH = 4096


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def sha256(body: Column) -> Column:
    return F.unhex(F.sha2(body.cast("binary"), 256))


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def arrivals(placed: DataFrame, file: str, at: str, doc_id: str, text: str, digest=sha256) -> DataFrame:
    return placed.select(column(doc_id).cast("long").alias("id"), digest(normalised(column(text))).alias("digest"), column(file).alias("file"), column(at).alias("at"))


def keyed_state(stream: DataFrame) -> DataFrame:
    """Per digest: the first row (null ids last, then smallest id, then content) and how many arrived. For a stream or a table."""
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "file", "at")
    return stream.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows"))


def run_state(spark: SparkSession, folder: str, schema, checkpoint: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Stream the arrivals in ``folder`` into the state under ``checkpoint`` and return the state as a table.

    A later call with the same ``checkpoint`` takes up new files only and meets all earlier digests.
    """
    entries = f"{checkpoint}/entries"

    def keep(batch: DataFrame, number: int) -> None:
        batch.select(F.lit(number).alias("batch"), "*").write.mode("overwrite").parquet(f"{entries}/batch-{number:09d}")

    with _settings(spark, STATE_SETTINGS):
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
        query = (
            keyed_state(source).writeStream.outputMode("update").foreachBatch(keep)
            .option("checkpointLocation", f"{checkpoint}/state").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    found = spark.read.parquet(f"{entries}/batch-*")
    if found.agg(F.max("batch")).first()[0] == 0:
        return found.drop("batch")
    return found.groupBy("digest").agg(F.max_by(F.struct("first", "rows"), "batch").alias("s")).select("digest", "s.first", "s.rows")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest=sha256, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, digest, _file, _at.

    Of rows with equal text (white space runs count as one space, null as empty) the one with the smallest id is kept; a row
    without id only if no other has one, and of rows with one id the first by place. Exactly one row of each text is kept.
    An empty table gives no rows. Other columns do not matter.
    """
    return _decided(*located(docs), doc_id, text, digest, files_per_batch)


def _decided(placed: DataFrame, file: str, at: str, doc_id: str, text: str, digest=sha256, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    spark = placed.sparkSession
    folder = scratch_path(spark, "arrivals")
    came = arrivals(placed, file, at, doc_id, text, digest)
    came.write.parquet(folder)
    rows = spark.read.schema(came.schema).parquet(folder)
    if rows.isEmpty():
        return rows.select("id", F.col("id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(False).alias("kept"), "digest", F.col("file").alias("_file"), F.col("at").alias("_at"))
    state = run_state(spark, folder, came.schema, scratch_path(spark, "dedup"), files_per_batch)

    # full bytes on hits: a digest that came once needs none
    repeated = stored(state.where("rows > 1").select("digest"), "repeated")
    bodies = placed.select(column(file).alias("file"), column(at).alias("at"), column(doc_id).cast("long").alias("id"), normalised(column(text)).alias("body"))
    hits = bodies.withColumn("digest", digest(F.col("body"))).join(sized(repeated), "digest", "left_semi")
    differing = stored(
        hits.groupBy("digest").agg(F.min("body").alias("least"), F.max("body").alias("most")).where("least != most").select("digest"), "differing"
    )
    joined = rows.join(state, "digest").select(
        "digest", "id", "file", "at", F.col("first.id").alias("keep_id"), F.col("rows").alias("group_size"),
        ((F.col("file") == F.col("first.file")) & (F.col("at") == F.col("first.at"))).alias("kept"),
    )
    if not differing.isEmpty():
        joined = joined.join(differing, "digest", "left_anti").unionByName(_by_bytes(hits.join(differing, "digest", "left_semi")))
    return joined.select("id", "keep_id", "group_size", "kept", "digest", F.col("file").alias("_file"), F.col("at").alias("_at"))


def _by_bytes(hits: DataFrame) -> DataFrame:
    """The same decision for rows whose digests agree and whose texts do not: by digest and text."""
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "file", "at")
    first = hits.groupBy("digest", "body").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows"))
    return hits.join(first, ["digest", "body"]).select(
        "digest", "id", "file", "at", F.col("first.id").alias("keep_id"), F.col("rows").alias("group_size"),
        ((F.col("file") == F.col("first.file")) & (F.col("at") == F.col("first.at"))).alias("kept"),
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the copies; all columns as they were, whatever their names.

    One row of each text stays, as ``exact_dedup`` decides, row by row: rows may share an id or have none. White space runs count
    as one space and a null text is empty, so of all null, empty and equal texts one row each stays. Texts of any length are
    compared whole. An empty table gives no rows. Any source will do (see ``tables.located``).
    """
    placed, file, at = located(docs)
    found = _decided(placed, file, at, doc_id, text)
    gone = stored(found.where("NOT kept").select(F.col("_file").alias(file), F.col("_at").alias(at)), "copies")
    return placed.join(sized(gone, 100_000), [file, at], "left_anti").select(*[column(c) for c in docs.columns])
