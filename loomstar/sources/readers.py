"""Scans. A record that does not fit its schema fails the job; ``quarantine`` sets such records apart instead."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loomstar.session import stored

BAD = "_bad_record"


def _csv(spark: SparkSession, multiline: bool) -> DataFrameReader:
    # all columns are parsed, whichever are asked for, so a record of too few or many is bad in every query;
    # values are converted, and can fail, where their column is asked for
    return spark.read.options(header=True, escape='"', enforceSchema=False, columnPruning=False, multiLine=multiline)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, multiline: bool = False) -> DataFrame:
    """CSV with a header, which must name the columns of ``schema`` in order. Types are detected by an extra pass when no schema is given.

    Files stay splittable unless ``multiline`` says that quoted fields may hold line breaks; then one task reads a file.
    """
    reader = _csv(spark, multiline).options(mode="FAILFAST", enforceSchema=schema is None)  # detected types have the header's names
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_indexed_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, multiline: bool = False) -> DataFrame:
    """CSV whose first column is an unnamed row index; the index is dropped. ``schema`` describes the other columns."""
    if schema is None:
        return read_csv(spark, path, multiline=multiline).drop("_c0")
    named = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = StructType([StructField("_c0", StringType()), *named.fields])
    # the header of the index is empty, so it cannot be checked by name
    head = spark.read.options(header=True, escape='"', multiLine=multiline).csv(path).columns[1:]
    if head != named.names:
        raise ValueError(f"the header {head} does not name {named.names}")
    return _csv(spark, multiline).options(mode="FAILFAST", enforceSchema=True).schema(whole).csv(path).drop("_c0")


def read_ndjson(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One JSON object per line: splittable, so any size."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_array(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Files that each hold one JSON array. A file is parsed by one task, so land API pages as many

    files and turn them into NDJSON with ``sinks.land_ndjson`` before heavy use.
    """
    reader = spark.read.options(multiLine=True, mode="FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def quarantine(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json", multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad records as they stand in the file, in column ``_bad_record``) of CSV or JSON files.

    The files are parsed once, with all columns, into a stored table, so both sides agree on what is bad.
    """
    named = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = StructType([*named.fields, StructField(BAD, StringType())])
    reader = _csv(spark, multiline) if fmt == "csv" else spark.read.option("multiLine", multiline)
    parsed = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=BAD).schema(whole).format(fmt).load(path)
    rows = stored(parsed, "parsed")
    return rows.where(F.col(BAD).isNull()).drop(BAD), rows.where(F.col(BAD).isNotNull()).select(BAD)


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    fetch_rows: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC scan: a table, read in ``partitions`` ranges of ``column``, or a query."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = {"url": url, "fetchsize": str(fetch_rows), **extra}
    options["dbtable" if table else "query"] = table or query
    if column is not None:
        if query is not None:
            raise ValueError("a query scan cannot be partitioned; give a table")
        if bounds is None or partitions is None:
            raise ValueError("a partitioned scan needs bounds and partitions")
        low, high = bounds
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, **options) -> DataFrame:
    """Relational table or query scan; filters and column choice are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **options)).load()
