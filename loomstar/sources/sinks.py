"""Writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from loomstar.operators.ordering import numbered
from loomstar.sources.schemas import fit

# Write intents to Spark's modes.
MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def write_table(df: DataFrame, path: str, mode: str = "fail", partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> int:
    """Write Parquet and return the number of rows written, counted by the write itself."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(MODES[mode]).option("partitionOverwriteMode", "static").options(**(options or {}))
    writer.partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def insert(df: DataFrame, path: str, schema: StructType, defaults: Mapping[str, Column] | None = None) -> int:
    """INSERT: rows, or the result of a SELECT, projected to the target's columns and appended."""
    return write_table(fit(df, schema, defaults), path, "append")


def write_partition(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Replace only the partitions present in ``df``, so that a day loaded twice is there once."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def create_table_as(df: DataFrame, name: str, mode: str = "fail", path: str | None = None) -> DataFrame:
    """CREATE TABLE AS SELECT in the session catalog, at ``path`` or in the warehouse; returns the new table."""
    writer = df.write.mode(MODES[mode])
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def land_csv(df: DataFrame, path: str, mode: str = "fail", index: bool = False) -> None:
    """Tabular data as CSV in the lake. ``index`` adds a leading row number without a name."""
    if index:
        rows = numbered(df, [], "_n")
        df = rows.select((F.col("_n") - 1).alias(""), *[F.col(f"`{c}`") for c in df.columns])
    df.write.mode(MODES[mode]).option("header", True).option("escape", '"').csv(path)


def land_ndjson(df: DataFrame, path: str, mode: str = "fail") -> None:
    df.write.mode(MODES[mode]).option("ignoreNullFields", False).json(path)


def land_json_array(df: DataFrame, path: str, page_rows: int = 1000, mode: str = "fail", page_per_file: bool = False) -> None:
    """JSON arrays of at most ``page_rows`` objects, as an API pages them, one array per line of text, or per file."""
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    rows = numbered(df.select(record.alias("_json")), [], "_n")
    page = F.floor((F.col("_n") - 1) / page_rows)
    array = F.concat(F.lit("["), F.array_join(F.collect_list("_json"), ","), F.lit("]"))
    rows.groupBy(page.alias("_page")).agg(array.alias("value")).select("value").write.mode(MODES[mode]).option("maxRecordsPerFile", 1 if page_per_file else 0).text(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
