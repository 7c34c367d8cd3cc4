import json

import pytest
from pyspark.sql import functions as F

from loomstar.operators import profile, project
from loomstar.session import drop_scratch, scratch_path, stored
from loomstar.sources import readers, schemas, sinks
from loomstar.streaming.pickup import append_to_raw, pick_up


def test_csv_with_index_and_awkward_text(spark, rows, tmp_path):
    df = spark.createDataFrame([("a, b", 1.5), ('say "hi"', None), ("ünï", 2.0)], "name string, price double")
    sinks.land_csv(df, f"{tmp_path}/i", index=True)
    assert rows(readers.read_indexed_csv(spark, f"{tmp_path}/i")) == rows(df)
    sinks.land_csv(df, f"{tmp_path}/p")
    assert rows(readers.read_csv(spark, f"{tmp_path}/p", "name string, price double")) == rows(df)


def test_json_array_documents(spark, rows, tmp_path):
    data = [{"id": 1, "rating": {"rate": 3.9, "count": 12}}, {"id": 2, "rating": None}]
    for n, indent in enumerate((None, 2)):
        (tmp_path / f"doc{n}.json").write_text(json.dumps(data, indent=indent))
    df = readers.read_json_array(spark, str(tmp_path), "id bigint, rating struct<rate: double, count: bigint>")
    assert df.count() == 4
    sinks.land_ndjson(df, f"{tmp_path}/lines")
    again = readers.read_ndjson(spark, f"{tmp_path}/lines", df.schema)
    assert rows(again, "id", "rating.rate") == [(1, 3.9), (1, 3.9), (2, None), (2, None)]


def test_json_pages_hold_every_row_once(spark, rows, tmp_path):
    df = spark.range(25).select("id", F.concat(F.lit("n"), "id").alias("name"))
    sinks.land_json_array(df, f"{tmp_path}/pages", page_rows=10)
    pages = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/pages").collect()]
    assert sorted(len(p) for p in pages) == [5, 10, 10]
    assert rows(readers.read_ndjson(spark, f"{tmp_path}/pages", "id bigint, name string")) == rows(df)


def test_write_modes_and_row_counts(spark, tmp_path):
    df, path = spark.range(10).toDF("id"), f"{tmp_path}/t"
    assert sinks.write_table(df, path) == 10
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        sinks.write_table(df, path)
    assert sinks.write_table(df, path, "append") == 10
    assert sinks.read_table(spark, path).count() == 20
    sinks.write_table(df, path, "replace")
    assert sinks.read_table(spark, path).count() == 10


def test_table_as_select(spark, tmp_path):
    df = sinks.create_table_as(spark.range(5).toDF("id"), "ctas_test", path=f"{tmp_path}/ctas")
    assert df.count() == 5 and spark.table("ctas_test").count() == 5
    spark.sql("DROP TABLE ctas_test")


def test_partition_is_replaced_not_doubled(spark, tmp_path):
    path = f"{tmp_path}/s"
    day = lambda d, n: spark.range(n).withColumn("created_date", F.lit(d).cast("date"))
    sinks.write_partition(day("2024-01-01", 3), path, ["created_date"])
    sinks.write_partition(day("2024-01-02", 4), path, ["created_date"])
    sinks.write_partition(day("2024-01-02", 5), path, ["created_date"])
    assert sinks.read_table(spark, path).count() == 8


def test_replace_takes_out_all_partitions_whatever_the_session_says(spark, tmp_path):
    path = f"{tmp_path}/s"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for part in (1, 2):
            sinks.write_table(spark.range(3).withColumn("p", F.lit(part)), path, "replace", ["p"])
        assert sinks.read_table(spark, path).select("p").distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_jdbc_options():
    whole = readers.jdbc_options("jdbc:x", table="movies", column="id", bounds=(1, 1000), partitions=8)
    assert whole["dbtable"] == "movies" and whole["numPartitions"] == "8" and whole["upperBound"] == "1000"
    assert readers.jdbc_options("jdbc:x", query="SELECT 1", user="me")["query"] == "SELECT 1"
    for wrong in ({}, {"table": "a", "query": "b"}, {"query": "b", "column": "c"}, {"table": "a", "column": "c"}):
        with pytest.raises(ValueError):
            readers.jdbc_options("jdbc:x", **wrong)


def test_fit_to_target(spark):
    rows = spark.createDataFrame([("7", "Pen")], "product_id string, product_name string")
    fitted = schemas.fit(rows, schemas.target("sales", "dim_product"), {"rating": F.lit(1), "product_key": F.lit(3)})
    assert fitted.schema.names == schemas.target("sales", "dim_product").names
    assert fitted.first().product_id == 7 and fitted.first().rating == 1.0 and fitted.first().category is None
    with pytest.raises(ValueError, match="oops"):
        schemas.fit(rows.withColumn("oops", F.lit(1)), schemas.target("sales", "dim_product"))
    with pytest.raises(ValueError, match="product_key"):
        schemas.fit(rows, schemas.target("sales", "dim_product"))
    assert schemas.add_null_columns(rows, product_key="bigint").dtypes[-1] == ("product_key", "bigint")
    assert all(schemas.target(s, t).fields for s, tables in schemas.TARGETS.items() for t in tables)


def test_insert_selects_into_a_typed_table(spark, rows, tmp_path):
    schema = schemas.target("movies", "dim_genre")
    for n in (1, 2):
        added = sinks.insert(spark.createDataFrame([(f"g{n}",)], "Genre string"), f"{tmp_path}/g", schema, {"genre_key": F.lit(n)})
        assert added == 1
    assert rows(sinks.read_table(spark, f"{tmp_path}/g")) == [(1, "g1"), (2, "g2")]


def test_pick_up_takes_each_file_once(spark, rows, tmp_path):
    lake, raw, seen = f"{tmp_path}/lake", f"{tmp_path}/raw", f"{tmp_path}/seen"
    take = lambda: pick_up(spark, lake, "id bigint", seen, append_to_raw(raw), header=True)
    spark.range(3).write.mode("append").option("header", True).csv(lake)
    assert take() == 1
    assert take() == 0
    spark.range(10, 12).write.mode("append").option("header", True).csv(lake)
    assert take() == 1
    assert rows(spark.read.parquet(raw), "batch_id", "id") == [(0, 0), (0, 1), (0, 2), (1, 10), (1, 11)]


def test_filters_reach_the_scan(spark, plan, tmp_path):
    df = spark.range(10).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("modified_date"), F.lit("x").alias("wide"))
    df.write.parquet(f"{tmp_path}/s")
    read = spark.read.parquet(f"{tmp_path}/s")
    one = project.modified_on(read, "2024-01-05", 1).select("id")
    assert one.first().id == 3
    assert "EqualTo(modified_date,2024-01-04)" in plan(one) and "wide" not in plan(one).split("ReadSchema")[1]
    stamps = read.withColumn("at", F.col("modified_date").cast("timestamp"))
    assert project.modified_on(stamps, "2024-01-05", 0, "at").first().id == 4
    assert project.modified_on(read.withColumn("m", F.col("modified_date").cast("string")), "2024-01-05", 0, "m").first().id == 4
    assert project.newest_batch(read).first().id == 9


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, "a,b", None), (2, "c", None)], "id int, t string, n string")
    assert rows(profile.list_columns(df)) == [("id", False), ("n", False), ("t", True)]
    assert profile.column_types(df) == [("id", "int"), ("n", "string"), ("t", "string")]
    assert profile.shape(df).first() == (2, 3)
    a = profile.sample_rows(spark.range(100).repartition(3), 5, 1, ["id"])
    b = profile.sample_rows(spark.range(100).repartition(7), 5, 1, ["id"])
    assert rows(a) == rows(b) and a.count() == 5


def test_scratch_is_dropped(spark):
    path = scratch_path(spark, "x")
    df = stored(spark.range(3), "gone")
    assert df.count() == 3 and path != scratch_path(spark, "x")
    drop_scratch(spark)
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0]).count()
