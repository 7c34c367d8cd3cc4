"""Helpers for whole tables: checked broadcasts, bounded samples, ids and texts under names that cannot clash."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loomstar.session import stored

#: Rows of at most three numbers that may be broadcast (about 10 MB); a larger side is joined by a shuffle.
BROADCAST_ROWS = 400_000
#: Rows handed to Python at once, so that a batch of long texts stays small.
BATCH_ROWS = 250


def sized(df: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (narrow and stored) with a broadcast hint if it has few rows; else Spark picks a shuffled join."""
    return F.broadcast(df) if df.count() <= most_rows else df


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted`` names as they can be added to ``df``: a name that is taken, in any case, gets underscores in front until it is free."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def column(name: str) -> Column:
    """The column of this very name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def located(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with two more columns that say where each row lies, file and row number, and their names.

    Rows of a Parquet scan are found as they lie; any other input (another format, a computed table) is stored first.
    """
    try:
        known = docs.select(docs.metadataColumn("_metadata").alias("m")).schema["m"].dataType.names
    except AnalysisException:  # no file scan
        known = []
    if not {"file_path", "row_index"} <= set(known):
        return located(stored(docs, "documents"))
    file, at = free_names(docs, "_file", "_at")
    where = docs.metadataColumn("_metadata")
    return docs.withColumns({file: where["file_path"], at: where["row_index"]}), file, at


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Before Python runs in tasks: give the executors this package, and Arrow batches fewer rows than Spark's 10,000, since a row may be a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="package-")  # on the driver, which hands the archive out
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = f"{folder}/{package.name}_package.zip"
        with zipfile.ZipFile(archive, "w") as made:
            for source in sorted(package.rglob("*.py")):
                made.write(source, source.relative_to(package.parent))
        context.addPyFile(archive)


def in_batches(work: Callable[[pd.DataFrame], Iterator[pd.DataFrame] | pd.DataFrame], rows: int = BATCH_ROWS):
    """For ``mapInPandas``: calls ``work`` with at most ``rows`` rows at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), rows):
                yield work(frame.iloc[at : at + rows])

    return run


def fraction_of(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on ``key`` alone."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the ids that no classifier may learn from; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def balanced_share(rows: DataFrame, label: str, per_class: int) -> dict:
    """{label: share of its rows to take} so that about ``per_class`` rows of each label remain. ``rows`` may be narrow."""
    return {r[label]: min(1.0, per_class / r["n"]) for r in rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def taken(label: Column, key: Column, shares: dict, seed: int) -> Column:
    """Whether a row belongs to the sample with these shares per label."""
    share = F.lit(0.0)
    for value, part in shares.items():
        share = F.when(label == F.lit(value), F.lit(part)).otherwise(share)
    return fraction_of(key, seed) < share
