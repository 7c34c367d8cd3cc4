"""Sources, sinks, pick-up and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from catalog import inputs
from catalog.registry import Tables, query
from loomstar.functions.keys import hash_key
from loomstar.operators import profile, reshape
from loomstar.plans.warehouse import Warehouse
from loomstar.session import scratch_path
from loomstar.sources import readers, records, schemas, sinks
from loomstar.sources.evolve import GrowingTable
from loomstar.streaming.pickup import append_to_raw, pick_up
from loomstar.streaming.upsert import upsert_stream

PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@query("csv_landing", "SELECT * FROM part")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    sinks.land_csv(t.part, path)
    return readers.read_csv(t.spark, path, PART_SCHEMA)


@query("csv_with_index", "SELECT * FROM part")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    sinks.land_csv(t.part, path, index=True)
    return readers.read_indexed_csv(t.spark, path, PART_SCHEMA)


@query(
    "ndjson_landing",
    """SELECT o_orderkey AS id, o_custkey + i AS "productId", CAST(i AS BIGINT) AS quantity
       FROM (SELECT *, unnest(range(1, 1 + CAST(day(o_orderdate) AS BIGINT) % 4)) AS i FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "ndjson")
    sinks.land_ndjson(inputs.cart_documents(t), path)
    carts = readers.read_ndjson(t.spark, path, schemas.CART_DOCUMENT)
    return reshape.explode_structs(carts.select("id", "products"), "products").where("quantity IS NOT NULL")


@query(
    "json_array_landing",
    """SELECT p_partkey AS id, p_name AS title, p_retailprice AS price, p_brand || ' ' || p_name AS description, p_type AS category,
         'img/' || p_partkey AS image, CAST(p_size / 10.0 AS DOUBLE) AS rate, CAST(p_size AS BIGINT) * 10 AS count FROM part""",
)
def _(t: Tables) -> DataFrame:
    """API pages of JSON arrays, turned into NDJSON, then read."""
    pages, lines = scratch_path(t.spark, "pages"), scratch_path(t.spark, "ndjson")
    sinks.land_json_array(inputs.product_documents(t), pages)
    sinks.land_ndjson(readers.read_ndjson(t.spark, pages, schemas.PRODUCT_DOCUMENT), lines)
    return reshape.flatten_struct(readers.read_ndjson(t.spark, lines, schemas.PRODUCT_DOCUMENT), "rating")


@query(
    "json_array_document",
    """SELECT p_partkey AS id, p_name AS title, p_retailprice AS price, CAST(p_size / 10.0 AS DOUBLE) AS rate FROM part""",
)
def _(t: Tables) -> DataFrame:
    """API pages, one JSON array per file, read as they are."""
    pages = scratch_path(t.spark, "pages")
    sinks.land_json_array(inputs.product_documents(t), pages, page_per_file=True)
    return readers.read_json_array(t.spark, pages, schemas.PRODUCT_DOCUMENT).select("id", "title", "price", F.col("rating.rate").alias("rate"))


def _told_apart(good: DataFrame, bad: DataFrame, key: str) -> DataFrame:
    counted = good.agg(F.lit("good").alias("side"), F.count(F.lit(1)).alias("row_count"), F.sum(key).alias("key_sum"))
    return counted.unionByName(bad.agg(F.lit("bad").alias("side"), F.count(readers.BAD).alias("row_count"), F.lit(None).cast("bigint").alias("key_sum")))


@query(
    "ndjson_quarantine",
    """SELECT 'good' AS side, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders WHERE o_orderkey % 7 <> 0
       UNION ALL SELECT 'bad', count(*), NULL FROM orders WHERE o_orderkey % 7 = 0""",
)
def _(t: Tables) -> DataFrame:
    """Every seventh line is cut short or has a word for a number."""
    path = scratch_path(t.spark, "ndjson")
    line = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total")))
    broken = F.when(F.col("o_orderkey") % 2 == 0, F.substring(line, 1, 12)).otherwise(F.lit('{"id": "many", "total": 1.5}'))
    t.orders.select(F.when(F.col("o_orderkey") % 7 == 0, broken).otherwise(line).alias("value")).write.text(path)
    return _told_apart(*readers.quarantine(t.spark, path, "id bigint, total double"), "id")


@query(
    "csv_quarantine",
    """SELECT 'good' AS side, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders WHERE o_orderkey % 5 <> 0
       UNION ALL SELECT 'bad', count(*), NULL FROM orders WHERE o_orderkey % 5 = 0""",
)
def _(t: Tables) -> DataFrame:
    """Every fifth row has a word for a price."""
    path = scratch_path(t.spark, "csv")
    price = F.when(F.col("o_orderkey") % 5 == 0, F.lit("dear")).otherwise(F.col("o_totalprice").cast("string"))
    sinks.land_csv(t.orders.select("o_orderkey", price.alias("o_totalprice")), path)
    return _told_apart(*readers.quarantine(t.spark, path, "o_orderkey bigint, o_totalprice double", "csv"), "o_orderkey")


@query(
    "csv_records_over_lines",
    """SELECT 'good' AS side, o_orderkey, 'line ' || o_orderkey || chr(10) || '"' || o_orderstatus || '",' || chr(10) || chr(10) || 'end' AS note FROM orders WHERE o_orderkey % 5 <> 0
       UNION ALL SELECT 'bad', NULL, 'dear,"line ' || o_orderkey || chr(10) || '""' || o_orderstatus || '"",' || chr(10) || chr(10) || 'end"' FROM orders WHERE o_orderkey % 5 = 0""",
)
def _(t: Tables) -> DataFrame:
    """Notes of several lines, with quotes and blank lines; every fifth record has a word for its key."""
    path = scratch_path(t.spark, "csv")
    key = F.when(F.col("o_orderkey") % 5 == 0, F.lit("dear")).otherwise(F.col("o_orderkey").cast("string"))
    note = F.concat(F.lit("line "), "o_orderkey", F.lit('\n"'), "o_orderstatus", F.lit('",\n\nend'))
    sinks.land_csv(t.orders.select(key.alias("o_orderkey"), note.alias("note")), path)
    good, bad = records.csv_records(t.spark, path, "o_orderkey bigint, note string")
    return good.select(F.lit("good").alias("side"), "o_orderkey", "note").unionByName(bad.select(F.lit("bad").alias("side"), F.lit(None).cast("bigint").alias("o_orderkey"), F.col(readers.BAD).alias("note")))


@query(
    "json_records_of_arrays",
    """SELECT p_partkey AS id, p_name AS title, p_retailprice AS price, 'a } "{[' || p_brand AS description, CAST(p_size / 10.0 AS DOUBLE) AS rate FROM part""",
)
def _(t: Tables) -> DataFrame:
    """One JSON array per file, each read by as many tasks as it has splits."""
    pages = scratch_path(t.spark, "pages")
    sinks.land_json_array(inputs.product_documents(t).withColumn("description", F.concat(F.lit('a } "{['), F.split("description", " ")[0])), pages, page_per_file=True)
    good, _ = records.json_array_records(t.spark, pages, schemas.PRODUCT_DOCUMENT)
    return good.select("id", "title", "price", "description", F.col("rating.rate").alias("rate"))


@query(
    "insert_select",
    """SELECT c_custkey AS user_key, CAST(c_custkey AS VARCHAR) AS user_id, c_name AS user_name FROM customer
       UNION ALL SELECT s_suppkey, CAST(s_suppkey AS VARCHAR), 'unnamed' FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    """Two inserts into one target: a SELECT, then rows that lack a column with a default."""
    path, schema = scratch_path(t.spark, "dim_user"), schemas.target("reviews", "dim_user")
    sinks.insert(t.customer.selectExpr("c_name AS user_name", "c_custkey AS user_id", "c_custkey AS user_key"), path, schema)
    sinks.insert(t.supplier.selectExpr("s_suppkey AS user_key", "s_suppkey AS user_id"), path, schema, {"user_name": F.lit("unnamed")})
    return t.spark.read.schema(schema).parquet(path)


@query("create_table_as", "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "ctas")
    name = f"ctas_{path.rpartition('-')[2]}"
    return sinks.create_table_as(t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders")), name, path=path)


@query("add_key_columns", "SELECT p_partkey, CAST(NULL AS BIGINT) AS brand_key, CAST(NULL AS VARCHAR) AS note FROM part")
def _(t: Tables) -> DataFrame:
    return schemas.add_null_columns(t.part.select("p_partkey"), brand_key="bigint", note="string")


@query(
    "sorted_types",
    """SELECT unnest(['p_brand', 'p_name', 'p_partkey', 'p_retailprice', 'p_size', 'p_type']) AS column_name,
         unnest(['string', 'string', 'bigint', 'double', 'int', 'string']) AS kind, unnest(range(1, 7)) AS position,
         unnest([count(p_brand), count(p_name), count(p_partkey), count(p_retailprice), count(p_size), count(p_type)]) AS filled FROM part""",
)
def _(t: Tables) -> DataFrame:
    """Columns of a table in order of name, with their types and how many rows fill them."""
    kinds = t.spark.createDataFrame([(c, k, i) for i, (c, k) in enumerate(profile.column_types(t.part), 1)], "column_name string, kind string, position bigint")
    filled = t.part.agg(*[F.count(c).alias(c) for c in t.part.columns]).unpivot([], t.part.columns, "column_name", "filled")
    return kinds.join(filled, "column_name")


@query(
    "partition_append",
    """SELECT o_orderkey AS id, o_totalprice AS amount, DATE '2001-08-01' AS created_date FROM orders
       UNION ALL SELECT c_custkey, c_acctbal, DATE '2001-08-02' FROM customer""",
)
def _(t: Tables) -> DataFrame:
    """History, a later batch appended, and that batch loaded again in place."""
    path = scratch_path(t.spark, "staging")
    history = t.orders.selectExpr("o_orderkey AS id", "o_totalprice AS amount", "date '2001-08-01' AS created_date")
    batch = t.customer.selectExpr("c_custkey AS id", "c_acctbal AS amount", "date '2001-08-02' AS created_date")
    sinks.write_table(history, path, "fail", ["created_date"])
    sinks.write_table(batch, path, "append", ["created_date"])
    sinks.write_partition(batch, path, ["created_date"])
    return sinks.read_table(t.spark, path)


@query("write_row_count", "SELECT count(*) AS rows_written FROM lineitem")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "counted")
    rows = sinks.write_table(t.lineitem, path)
    return t.spark.range(1).select(F.lit(rows).cast("bigint").alias("rows_written"))


@query(
    "fit_target",
    """SELECT p_partkey AS product_key, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
         CAST(NULL AS VARCHAR) AS about_product, CAST(NULL AS VARCHAR) AS img_link, CAST(NULL AS VARCHAR) AS product_link,
         CAST(NULL AS VARCHAR) AS rating, '1' AS rating_count FROM part""",
)
def _(t: Tables) -> DataFrame:
    rows = t.part.selectExpr("p_partkey AS product_key", "p_partkey AS product_id", "p_name AS product_name", "p_type AS category")
    return schemas.fit(rows, schemas.target("reviews", "dim_product"), {"rating_count": F.lit("1")})


@query(
    "stream_pickup",
    """SELECT CASE WHEN year(o_orderdate) < 1998 THEN 0 ELSE 1 END::BIGINT AS batch_id, o_orderkey, o_totalprice FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """Objects landed in two steps; the second run reads only the new ones."""
    base = scratch_path(t.spark, "pickup")
    lake, raw, seen = f"{base}/lake", f"{base}/raw", f"{base}/seen"
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    for arrived in (F.col("y") < 1998, F.col("y") >= 1998):
        rows.where(arrived).drop("y").write.mode("append").option("header", True).csv(lake)
        pick_up(t.spark, lake, "o_orderkey bigint, o_totalprice double", seen, append_to_raw(raw), header=True)
    schema = "o_orderkey bigint, o_totalprice double, batch_id bigint"
    return t.spark.read.schema(schema).parquet(raw).select("batch_id", "o_orderkey", "o_totalprice")


@query(
    "stream_upsert",
    """SELECT sha256('dim_customer' || chr(1) || o_custkey) AS customer_key, o_custkey AS customer_id, max_by(o_orderkey, (CAST(o_orderdate AS DATE), o_orderkey)) AS last_order,
         max_by(o_totalprice, (CAST(o_orderdate AS DATE), o_orderkey)) AS last_price FROM orders GROUP BY o_custkey""",
)
def _(t: Tables) -> DataFrame:
    """Orders landed in three runs, the first of them once more in the last: each customer's newest order, kept by state."""
    base = scratch_path(t.spark, "upsert")
    wh, schema = Warehouse(t.spark, f"{base}/wh"), StructType.fromDDL("customer_key string, customer_id bigint, last_order bigint, last_price double")
    rows = t.orders.select(
        hash_key("dim_customer", "o_custkey").alias("customer_key"), F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("last_order"),
        F.col("o_totalprice").alias("last_price"), F.to_date("o_orderdate").alias("day"),
    )
    for parts in ((0,), (1,), (2, 0)):
        rows.where((F.col("last_order") % 3).isin(*parts)).write.mode("append").parquet(f"{base}/lake")
        upsert_stream(t.spark.readStream.schema(rows.schema).parquet(f"{base}/lake"), wh, "dim_customer", schema, ["day", "last_order"], f"{base}/state")
    return wh.snapshot("dim_customer", schema)


@query(
    "growing_types",
    """SELECT o_orderkey % 100 AS id, CAST(o_orderkey % 100 AS VARCHAR) AS amount, NULL AS note FROM orders WHERE o_orderkey % 3 = 0
       UNION ALL SELECT o_orderkey * 10000000000, CAST(o_orderkey AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders WHERE o_orderkey % 3 = 1
       UNION ALL SELECT o_orderkey, 'about ' || o_orderkey, o_orderpriority FROM orders WHERE o_orderkey % 3 = 2""",
)
def _(t: Tables) -> DataFrame:
    """Three drops of text columns: whole numbers; larger ones and a new column of dates; text in both."""
    table = GrowingTable(t.spark, scratch_path(t.spark, "growing"))
    drops = [
        t.orders.where("o_orderkey % 3 = 0").selectExpr("cast(o_orderkey % 100 AS string) AS id", "cast(o_orderkey % 100 AS string) AS amount"),
        t.orders.where("o_orderkey % 3 = 1").selectExpr("cast(o_orderkey * 10000000000 AS string) AS id", "cast(o_orderkey AS string) AS amount", "cast(cast(o_orderdate AS date) AS string) AS note"),
        t.orders.where("o_orderkey % 3 = 2").selectExpr("o_orderpriority AS note", "concat('about ', o_orderkey) AS amount", "cast(o_orderkey AS string) AS id"),
    ]
    for n, drop in enumerate(drops):
        table.append(drop, f"{n}")
    return table.read()


# --- profiling --------------------------------------------------------------------------------


@query(
    "filtered_counts",
    """SELECT count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_totalprice > 300000) AS large FROM orders""",
)
def _(t: Tables) -> DataFrame:
    return profile.filtered_counts(t.orders, {"finished": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 300000})


@query("distinct_count", "SELECT count(DISTINCT CASE WHEN l_quantity >= 5 THEN l_partkey END) AS distinct_count FROM lineitem")
def _(t: Tables) -> DataFrame:
    return profile.distinct_count(t.lineitem.selectExpr("if(l_quantity < 5, NULL, l_partkey) AS k"), "k")


@query("group_min", "SELECT l_partkey, min(l_quantity) AS min_l_quantity FROM lineitem GROUP BY l_partkey")
def _(t: Tables) -> DataFrame:
    return profile.group_min(t.lineitem, "l_partkey", "l_quantity")


@query("group_min_having", "SELECT l_partkey, min(l_quantity) AS min_l_quantity FROM lineitem GROUP BY l_partkey HAVING l_partkey = 11")
def _(t: Tables) -> DataFrame:
    return profile.group_min(t.lineitem, "l_partkey", "l_quantity", only=11)


@query("table_max", "SELECT CAST(max(o_orderdate) AS DATE) AS max_o_orderdate FROM orders")
def _(t: Tables) -> DataFrame:
    return profile.table_max(t.orders.select(F.to_date("o_orderdate").alias("o_orderdate")), "o_orderdate")


@query("sort_rows", "SELECT p_name, p_partkey FROM part ORDER BY p_name, p_partkey")
def _(t: Tables) -> DataFrame:
    return profile.sort_rows(t.part.select("p_name", "p_partkey"), "p_name", "p_partkey")


@query("first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def _(t: Tables) -> DataFrame:
    return profile.first_rows(t.orders.select("o_orderkey", "o_totalprice"), 5, F.col("o_totalprice").desc(), "o_orderkey")


@query("sample_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('7' || chr(1) || o_orderkey), o_orderkey LIMIT 5")
def _(t: Tables) -> DataFrame:
    return profile.sample_rows(t.orders.select("o_orderkey", "o_custkey"), 5, seed=7, by=["o_orderkey"])


@query("sample_rows_by_layout", "SELECT least(5, count(*)) AS drawn, least(5, count(DISTINCT o_orderkey)) AS different, least(5, count(o_custkey)) AS known FROM orders")
def _(t: Tables) -> DataFrame:
    """A draw that depends on how the rows lie: what must hold for every draw."""
    drawn = profile.sample_rows(t.orders.select("o_orderkey", "o_custkey"), 5, seed=7)
    known = drawn.join(t.orders.selectExpr("o_orderkey AS k", "o_custkey AS c"), (F.col("o_orderkey") == F.col("k")) & (F.col("o_custkey") == F.col("c")), "left")
    return known.agg(F.count(F.lit(1)).alias("drawn"), F.countDistinct("o_orderkey").alias("different"), F.count("k").alias("known"))


@query(
    "list_columns",
    """SELECT 'doc_id' AS column_name, bool_or(contains(CAST(doc_id AS VARCHAR), ',')) AS has_list FROM documents
       UNION ALL SELECT 'text', bool_or(contains(text, ',')) FROM documents
       UNION ALL SELECT 'lang', bool_or(contains(lang, ',')) FROM documents
       UNION ALL SELECT 'source', bool_or(contains(source, ',')) FROM documents
       UNION ALL SELECT 'n_chars', bool_or(contains(CAST(n_chars AS VARCHAR), ',')) FROM documents""",
)
def _(t: Tables) -> DataFrame:
    return profile.list_columns(t.documents)


@query("table_shape", "SELECT count(*) AS row_count, (SELECT count(*) FROM (DESCRIBE lineitem)) AS column_count FROM lineitem")
def _(t: Tables) -> DataFrame:
    return profile.shape(t.lineitem)
