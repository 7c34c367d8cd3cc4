"""Files that may hold certain keys, told by the bounds and Bloom filters that Parquet keeps for each of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: So many values of the first key are looked for one by one; more than that by their bounds, then by a join.
LISTED = 1000

_THRESHOLD = "spark.sql.parquet.pushdown.inFilterThreshold"
_FILE = "_held_in"


def findable(df: DataFrame, keys: Sequence[str], files: int | None = None) -> tuple[DataFrame, dict[str, str]]:
    """``df`` in ranges of its keys, sorted, and the options to write it with, so that files can be passed over by key.

    Without ``files`` AQE chooses their number by size. The Bloom filter grows with the file, up to Parquet's megabyte.
    """
    ranges = df.repartitionByRange(*([files] if files else []), *[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    return ranges, {f"parquet.bloom.filter.enabled#{keys[0]}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def touched_files(target: DataFrame, keys: DataFrame) -> list[str]:
    """Names of the files of ``target`` (a Parquet scan) that hold a row with one of ``keys`` (stored, distinct, without nulls).

    Exact: bounds and Bloom filters, in the files' footers, keep Spark from reading most of the others, and of those it reads the
    key columns alone. The answer is one short text per file. No keys touch no file.
    """
    spark, first = target.sparkSession, F.col(keys.columns[0])
    bounds = keys.agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("least"), F.max(first).alias("most")).first()
    if not bounds["n"]:
        return []
    if bounds["n"] <= LISTED:
        near = first.isin([r[0] for r in keys.select(first).distinct().collect()])
    else:
        near = first.between(bounds["least"], bounds["most"])
    held = target.select(*keys.columns, target.metadataColumn("_metadata")["file_path"].alias(_FILE)).where(near)
    found = held.join(keys, keys.columns, "left_semi").select(_FILE).distinct()
    before = spark.conf.get(_THRESHOLD)
    spark.conf.set(_THRESHOLD, str(LISTED))  # beyond the threshold Spark asks the footers for bounds alone
    try:
        return [r[0].rpartition("/")[2] for r in found.collect()]
    finally:
        spark.conf.set(_THRESHOLD, before)
