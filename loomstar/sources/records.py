"""Records that span lines, read by many tasks: where a record begins is told by prefix sums over the pieces of a file.

A file is read in pieces, by as many tasks as it has splits. Whether a piece begins inside quotes, and how deep inside brackets,
depends on all pieces before it, but only through a sum: each run of a split's pieces is added up, the sums of the runs are added
up along the file (one row per run), and each run goes on from there. Pieces of one record are then joined and parsed.
A piece that is a record by itself, as most are, is not moved again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loomstar.session import stored
from loomstar.sources.readers import BAD

# Text inside quotes, from outside and up to the first quote that ends it; a quote may be escaped by a backslash.
_QUOTED = r'"(?:[^"\\]|\\.)*+"?'
_REST_OF_QUOTED = r'^(?:[^"\\]|\\.)*+"?'

# Pieces that are added up in one go, as a power of two: a split is cut into such runs. Runs that a task gets, about.
_RUN_BITS, _TASK_RUNS = 14, 32
_PLACE = ["_file", "_split", "_run"]


def _pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """_piece (without the separator behind it), _file, _split, _at (order within a split), _run (rising with it: the next pieces of a split)."""
    text = spark.read.option("lineSep", separator).text(path)
    where = text.metadataColumn("_metadata")
    at = text.select(F.col("value").alias("_piece"), where["file_path"].alias("_file"), where["file_block_start"].alias("_split"), F.monotonically_increasing_id().alias("_at"))
    return at.withColumn("_run", F.shiftright("_at", _RUN_BITS))


def _ahead(pieces: DataFrame, value: Column, name: str, placed: bool = False) -> DataFrame:
    """``pieces`` with the sum of ``value`` over all pieces of the file before each.

    The one window that runs along a whole file has a row per run of a split. A task sorts and adds up some runs, whose number does
    not grow with the split or the file. ``placed`` says that the pieces lie by their runs already.
    """
    sums = stored(pieces.groupBy(*_PLACE).agg(F.sum(value).alias("_sum")), "splits")
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy("_file").orderBy("_split", "_run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sums.select(*_PLACE, before.alias("_base"))
    own = Window.partitionBy(*_PLACE).orderBy("_at")
    if not placed:
        pieces = pieces.repartition(1 + sums.count() // _TASK_RUNS, *_PLACE)
    running = F.coalesce(F.sum(value).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return pieces.withColumn(name, running).join(base, _PLACE).withColumn(name, F.col(name) + F.col("_base")).drop("_base")


def _joined(pieces: DataFrame, starts: Column, separator: str) -> DataFrame:
    """_file, _number (from 0), _record: pieces from each that ``starts`` a record to the next, joined as they stood in the file."""
    marked = _ahead(pieces.withColumn("_starts", starts.cast("int")), F.col("_starts"), "_before", placed=True).withColumn("_number", F.col("_before") + F.col("_starts") - 1)
    follows = F.lead("_starts").over(Window.partitionBy(*_PLACE).orderBy("_at"))
    # the last piece of a run cannot tell what the next one holds
    told = stored(marked.withColumn("_alone", (F.col("_starts") == 1) & (F.coalesce(follows, F.lit(0)) == 1)), "pieces")
    alone = told.where("_alone").select("_file", "_number", F.col("_piece").alias("_record"))
    parts = told.where("NOT _alone AND _number >= 0").groupBy("_file", "_number").agg(F.sort_array(F.collect_list(F.struct("_split", "_at", "_piece"))).alias("_parts"))
    return alone.unionByName(parts.select("_file", "_number", F.array_join(F.transform("_parts", lambda p: p["_piece"]), separator).alias("_record")))


def _typed(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _told_apart(rows: DataFrame, parsed: Column, schema: StructType) -> tuple[DataFrame, DataFrame]:
    held = rows.select("_record", parsed.alias("_row"))
    bad = F.col("_row").isNull() | F.col("_row")[BAD].isNotNull()
    good = held.where(~bad).select(*[F.col("_row")[f.name].alias(f.name) for f in schema.fields])
    return good, held.where(bad).select(F.col("_record").alias(BAD))


def csv_records(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad records in column ``_bad_record``) of CSV files with a header, whose quoted fields may hold line breaks.

    A quote inside a field is doubled, so a line break is inside a field just if an odd number of quotes lies before it. The
    header must name the columns of ``schema`` in order. Blank lines between records are passed over. A field that is never
    closed makes one bad record of the rest of its file. Line breaks inside fields come out as they are in the file.
    """
    schema = _typed(schema)
    lines = _pieces(spark, path, "\n")
    quotes = F.length("_piece") - F.length(F.replace("_piece", F.lit('"'), F.lit("")))
    parity = _ahead(lines, quotes, "_quotes")
    records = _joined(parity, F.col("_quotes") % 2 == 0, "\n")
    records = stored(records.withColumn("_record", F.regexp_replace("_record", "\r$", "")), "records")
    _check_header(records, schema)
    whole = StructType([*schema.fields, StructField(BAD, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "escape": '"', "multiLine": "true"}
    body = records.where((F.col("_number") > 0) & (F.trim("_record") != ""))
    return _told_apart(body, F.from_csv("_record", _ddl(whole), options), schema)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _check_header(records: DataFrame, schema: StructType) -> None:
    head = records.where("_number = 0").select(F.regexp_replace("_record", "^﻿", "").alias("head"))
    names = F.from_csv("head", ", ".join(f"c{i} string" for i in range(len(schema.fields) + 1)), {"escape": '"'})
    wanted = F.array(*[F.lit(n) for n in schema.names], F.lit(None).cast("string"))
    other = head.select("head", F.array(*[names[f"c{i}"] for i in range(len(schema.fields) + 1)]).alias("n")).where(~F.col("n").eqNullSafe(wanted)).first()
    if other is not None:
        raise ValueError(f"the header {other['head']} does not name {schema.names}")


def json_array_records(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad records in column ``_bad_record``) of files that each hold one JSON array of objects, on one line or many.

    Files are cut behind every closing brace. Quotes before a piece tell whether it begins inside a text, brackets outside texts
    how deep it lies; an object of the array ends where a brace leads back to the depth of the array itself.
    """
    schema = _typed(schema)
    pieces = _pieces(spark, path, "}")
    bare = F.regexp_replace("_piece", r"\\.", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    inside = stored(_ahead(pieces, quotes, "_quotes").withColumn("_inside", F.col("_quotes") % 2 == 1), "quoted")
    # what lies outside texts; the piece's own closing brace counts if it is outside as well
    open_text = F.when(F.col("_inside"), F.regexp_replace("_piece", _REST_OF_QUOTED, "")).otherwise(F.col("_piece"))
    outside = F.regexp_replace(open_text, _QUOTED, "")
    ends_inside = (F.col("_quotes") + quotes) % 2 == 1
    depth = F.length(F.regexp_replace(outside, r"[^\[{]", "")) - F.length(F.regexp_replace(outside, r"[^\]}]", "")) - F.when(ends_inside, 0).otherwise(1)
    deep = stored(_ahead(inside.withColumns({"_depth": depth, "_ends": ~ends_inside}), F.col("_depth"), "_above"), "deep")
    closes = F.col("_ends") & (F.col("_above") + F.col("_depth") == 1)
    # a piece starts a record if the one before it ends one: count the ends before
    ended = _ahead(deep.withColumn("_closes", closes.cast("int")), F.col("_closes"), "_number")
    told = stored(ended.withColumn("_alone", (F.col("_closes") == 1) & (F.col("_above") <= 1)), "pieces")
    alone = told.where("_alone").select("_file", "_number", F.concat("_piece", F.lit("}")).alias("_record"), F.lit(True).alias("_whole"))
    parts = told.where("NOT _alone").groupBy("_file", "_number").agg(F.sort_array(F.collect_list(F.struct("_split", "_at", "_piece"))).alias("_parts"), F.max("_closes").alias("_whole"))
    whole = F.col("_whole") == 1
    rest = parts.select("_file", "_number", F.concat(F.array_join(F.transform("_parts", lambda p: p["_piece"]), "}"), F.when(whole, "}").otherwise("")).alias("_record"), whole.alias("_whole"))
    records = alone.unionByName(rest).withColumn("_record", F.regexp_replace("_record", r"^[\s﻿]*+(?:\[|,)?+\s*+", ""))
    # behind the last object only the array's end may stand
    body = stored(records.where(F.col("_whole") | ~F.trim(F.regexp_replace("_record", r"\s+", " ")).isin("", "]")), "records")
    typed = StructType([*schema.fields, StructField(BAD, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "multiLine": "true"}
    return _told_apart(body, F.from_json("_record", typed, options), schema)
