"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE picks join strategy, coalesces small shuffle partitions and splits the hot ones at run time.
# forceOptimizeSkewedJoin lets the split happen even where the next operator then needs a shuffle:
# that shuffle is cheaper than one task holding a third of the rows.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, app: str = "loomstar", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-JVM session for tests and benchmarks; clusters bring their own session to ``tune``."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``, else the context's checkpoint folder.

    A local session makes one for this run. On a cluster a folder of the driver's machine would lose rows, so it is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not _one_machine(context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="loomstar-"))
    return context.getCheckpointDir()


def _one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/loomstar/{spark.sparkContext.applicationId}"


_open_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, never used twice."""
    path = f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Frees what is stored inside the block when the block ends; nothing read from it may be used later."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            _delete(spark, path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all that this application stored with ``stored``; call it when its results are written."""
    _delete(spark, _application_dir(spark))


def stored(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage and survives the loss of an executor. Later readers scan only the columns they
    need, repeat none of the work behind ``df``, and plan with its true size. ``codec`` compresses it otherwise than Spark's setting.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
