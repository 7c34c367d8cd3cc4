"""Projection, filters, reshaping and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog import inputs
from catalog.registry import Tables, query
from loomstar.functions import clean
from loomstar.operators import conform, project, reshape

# --- projection and filters -------------------------------------------------------------------


@query(
    "column_subset_rename",
    "SELECT c_custkey AS user_id, c_name AS user_name, c_mktsegment AS segment FROM customer",
)
def _(t: Tables) -> DataFrame:
    return project.subset(t.customer, ["c_custkey", "c_name", "c_mktsegment"], {"c_custkey": "user_id", "c_name": "user_name", "c_mktsegment": "segment"})


@query("all_columns_except", "SELECT * EXCLUDE (p_size, p_retailprice) FROM part")
def _(t: Tables) -> DataFrame:
    return project.all_except(t.part, "p_size", "p_retailprice")


@query(
    "batch_stamp",
    """SELECT o_orderkey, DATE '2001-08-02' AS created_date, CAST(CAST(o_orderdate AS DATE) + 1 AS DATE) AS next_day
       FROM orders""",
)
def _(t: Tables) -> DataFrame:
    stamped = project.stamp(t.orders, "2001-08-02")
    return stamped.select("o_orderkey", "created_date", clean.day_after("o_orderdate").alias("next_day"))


@query("total_sale", "SELECT l_orderkey, l_quantity * l_extendedprice AS total_sale FROM lineitem")
def _(t: Tables) -> DataFrame:
    return project.measure(t.lineitem, "total_sale", "l_extendedprice", "l_quantity").select("l_orderkey", "total_sale")


@query("cast_text", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.col("p_size").cast("string").alias("size_text"))


@query(
    "extract_day",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS modified_date, DATE '2000-03-01' AS created_date FROM orders
       WHERE CAST(o_orderdate AS DATE) = DATE '2000-02-29'""",
)
def _(t: Tables) -> DataFrame:
    rows = project.modified_on(t.orders, "2000-03-01", 1, "o_orderdate")
    return project.stamp(rows.select("o_orderkey", F.to_date("o_orderdate").alias("modified_date")), "2000-03-01")


@query(
    "batch_of_day",
    """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS created_date FROM lineitem
       WHERE CAST(l_shipdate AS DATE) = DATE '1999-12-31'""",
)
def _(t: Tables) -> DataFrame:
    staged = t.lineitem.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("created_date"))
    return project.batch_of(staged, "1999-12-31")


@query(
    "newest_batch",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    return project.newest_batch(t.orders, "o_orderdate").select("o_orderkey", "o_custkey")


@query("value_equality", "SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#7'")
def _(t: Tables) -> DataFrame:
    return project.equal_to(t.part, "p_brand", "Brand#7").select("p_partkey", "p_name")


@query(
    "stock_threshold",
    "SELECT l_orderkey, l_partkey AS product_key, l_quantity AS stock FROM lineitem WHERE l_partkey = 7 AND l_quantity >= 20",
)
def _(t: Tables) -> DataFrame:
    fact = t.lineitem.selectExpr("l_orderkey", "l_partkey AS product_key", "l_quantity AS stock")
    return project.in_stock(fact, 7, 20)


@query(
    "never_updated",
    "SELECT o_orderkey FROM orders WHERE CASE WHEN o_orderstatus = 'F' THEN o_orderdate END IS NULL",
)
def _(t: Tables) -> DataFrame:
    stamped = t.orders.selectExpr("o_orderkey", "if(o_orderstatus = 'F', o_orderdate, NULL) AS last_updated_date")
    return project.never_updated(stamped).select("o_orderkey")


# --- reshaping --------------------------------------------------------------------------------


@query(
    "parallel_explode",
    """SELECT 'P' || l_partkey AS product_id, 'U' || (l_suppkey + i) AS user_id, 'User ' || (l_suppkey + i) AS user_name,
         'R' || l_orderkey || '-' || l_partkey || '-' || i AS review_id, 'Title ' || l_returnflag || i AS review_title
       FROM (SELECT *, unnest(range(1, l_linenumber + 1)) AS i FROM lineitem)""",
)
def _(t: Tables) -> DataFrame:
    lists = ["user_id", "user_name", "review_id", "review_title"]
    packed = inputs.review_extract(t).select("product_id", *lists)
    return reshape.explode_parallel(reshape.split_columns(packed, lists), lists)


@query(
    "parallel_explode_padded",
    """WITH w AS (SELECT doc_id, string_split(text, ' ') AS words, string_split(text, chr(10)) AS lines FROM documents),
       n AS (SELECT *, unnest(range(1, greatest(len(words), len(lines)) + 1)) AS i FROM w)
       SELECT doc_id, words[i] AS words, lines[i] AS lines FROM n""",
)
def _(t: Tables) -> DataFrame:
    listed = t.documents.select("doc_id", clean.pieces("text", " ").alias("words"), clean.pieces("text", "\n").alias("lines"))
    return reshape.explode_parallel(listed, ["words", "lines"], mode="pad")


@query(
    "ragged_rows",
    """SELECT doc_id, len(string_split(text, ' ')) = len(string_split(text, chr(10))) AS even FROM documents""",
)
def _(t: Tables) -> DataFrame:
    listed = t.documents.select("doc_id", clean.pieces("text", " ").alias("words"), clean.pieces("text", "\n").alias("lines"))
    even, ragged = reshape.split_ragged(listed, ["words", "lines"])
    return even.select("doc_id", F.lit(True).alias("even")).unionByName(ragged.select("doc_id", F.lit(False).alias("even")))


@query("split_trim", "SELECT p_partkey, trim(unnest(string_split(p_name || ' ,' || p_brand, ','))) AS item FROM part")
def _(t: Tables) -> DataFrame:
    joined = t.part.selectExpr("p_partkey", "concat(p_name, ' ,', p_brand) AS item")
    return reshape.explode_trim(joined, "item")


@query(
    "melt_measures",
    """SELECT l_orderkey, l_linenumber, 'l_discount' AS measure, l_discount AS amount FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return reshape.melt(rows, ["l_discount", "l_tax"], "measure", "amount")


@query("flatten_json", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(t: Tables) -> DataFrame:
    parsed = t.events.select("event_id", "event_type", F.from_json("props", "k bigint").alias("props"))
    return reshape.flatten_struct(parsed, "props")


@query(
    "flatten_nested",
    """SELECT c_custkey AS id, 'city ' || c_nationkey AS city, CAST(c_nationkey AS BIGINT) AS number,
         CAST(c_nationkey AS VARCHAR) AS "geolocation.lat", CAST(-c_nationkey AS VARCHAR) AS "geolocation.long"
       FROM customer""",
)
def _(t: Tables) -> DataFrame:
    users = inputs.user_documents(t).select("id", "address")
    return reshape.flatten_struct(users, "address", ".").drop("street", "zipcode")


@query(
    "explode_structs",
    """SELECT o_orderkey AS id, o_custkey + i AS "productId", i AS quantity
       FROM (SELECT o_orderkey, o_custkey,
               unnest(CASE WHEN day(o_orderdate) % 4 = 0 THEN [NULL::BIGINT] ELSE range(1, 1 + CAST(day(o_orderdate) AS BIGINT) % 4) END) AS i
             FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    return reshape.explode_structs(inputs.cart_documents(t).select("id", "products"), "products")


# --- cleaning ---------------------------------------------------------------------------------


@query("currency_clean", "SELECT c_custkey, c_acctbal AS balance FROM customer")
def _(t: Tables) -> DataFrame:
    text = t.customer.selectExpr("c_custkey", "concat('₹', format_number(c_acctbal, 2)) AS balance")
    return text.select("c_custkey", clean.currency("balance").alias("balance"))


@query("strip_thousands", "SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS gross FROM orders")
def _(t: Tables) -> DataFrame:
    text = t.orders.selectExpr("o_orderkey", "format_number(floor(o_totalprice), 0) AS gross")
    return text.select("o_orderkey", clean.to_whole(clean.strip_thousands("gross")).alias("gross"))


@query(
    "coerce_fill",
    """SELECT o_orderkey, CAST(o_orderpriority[1] AS BIGINT) AS priority, CAST(0 AS BIGINT) AS status,
         CASE WHEN o_orderstatus = 'F' THEN 'NA' ELSE o_orderstatus END AS letter FROM orders""",
)
def _(t: Tables) -> DataFrame:
    raw = t.orders.selectExpr(
        "o_orderkey", "left(o_orderpriority, 1) AS priority", "o_orderstatus AS status", "nullif(o_orderstatus, 'F') AS letter"
    )
    return conform.fill_by_type(conform.coerce(raw, {"priority": "bigint", "status": "bigint", "letter": "string"}))


@query(
    "misfit_counts",
    """SELECT 'priority' AS column_name, count(*) FILTER (o_orderpriority IS NOT NULL AND try_cast(o_orderpriority AS BIGINT) IS NULL) AS misfit_count FROM orders
       UNION ALL SELECT 'price', count(*) FILTER (CAST(o_totalprice AS BIGINT) <> o_totalprice) FROM orders
       UNION ALL SELECT 'placed', CAST(0 AS BIGINT) FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    raw = t.orders.selectExpr("o_orderpriority AS priority", "o_totalprice AS price", "cast(o_orderdate AS string) AS placed")
    return conform.misfits(raw, {"priority": "bigint", "price": "bigint", "placed": "date"})


@query(
    "nan_to_null",
    "SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_tax > 0 THEN l_tax END AS tax FROM lineitem",
)
def _(t: Tables) -> DataFrame:
    raw = t.lineitem.selectExpr("l_orderkey", "l_linenumber", "l_suppkey", "if(l_tax > 0, l_tax, double('NaN')) AS tax")
    return conform.nan_to_null(raw)


@query("fill_column", "SELECT l_orderkey, CASE WHEN l_quantity < 5 THEN 1 ELSE l_quantity END AS rating_count FROM lineitem")
def _(t: Tables) -> DataFrame:
    raw = t.lineitem.selectExpr("l_orderkey", "if(l_quantity < 5, NULL, l_quantity) AS rating_count")
    return raw.withColumn("rating_count", clean.fill("rating_count", 1.0))


@query(
    "capitalize",
    "SELECT c_custkey, upper(c_name[1]) || lower(c_name[2:]) AS name, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS segment FROM customer",
)
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", clean.capitalize("c_name").alias("name"), clean.capitalize("c_mktsegment").alias("segment"))


@query(
    "title_case",
    r"""SELECT doc_id, array_to_string([CASE WHEN r[1] = 'ß' THEN 'Ss' ELSE upper(r[1]) END || lower(r[2:])
          for r in regexp_extract_all(text, '([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)')], '') AS titled FROM documents""",
)
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", clean.title_case("text").alias("titled"))


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS sale_date, CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
)
def _(t: Tables) -> DataFrame:
    carts = inputs.cart_documents(t)
    return carts.select(
        F.col("id").alias("o_orderkey"),
        clean.to_day("date").alias("sale_date"),
        clean.month_of(clean.to_day("date")).alias("month"),
        clean.year_of(clean.to_day("date")).alias("year"),
    )


@query("mask_private", "SELECT c_custkey, '***Masked***' AS c_name, '***Masked***' AS c_acctbal, c_mktsegment FROM customer")
def _(t: Tables) -> DataFrame:
    return project.mask_columns(t.customer, ["c_name", "c_acctbal"]).drop("c_nationkey")


@query("round_to_int", "SELECT p_partkey, CAST(round(CAST(p_size AS DECIMAL(9, 1)) / 4) AS INTEGER) AS rating FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", clean.round_to_int(F.col("p_size") / 4).alias("rating"))


@query(
    "date_rules",
    """SELECT 'placed_valid' AS rule, count(*) FILTER (month(o_orderdate) = 2 AND day(o_orderdate) = 28) AS violations FROM orders
       UNION ALL SELECT 'placed_in_range', count(*) FILTER (NOT (month(o_orderdate) = 2 AND day(o_orderdate) = 28)
         AND NOT (o_orderdate BETWEEN DATE '1996-01-01' AND DATE '2000-12-31')) FROM orders
       UNION ALL SELECT 'shipped_after_placed', count(*) FILTER (NOT (month(o_orderdate) = 2 AND day(o_orderdate) = 28)
         AND o_orderdate > DATE '2001-01-01') FROM orders""",
)
def _(t: Tables) -> DataFrame:
    raw = t.orders.selectExpr(
        "replace(date_format(o_orderdate, 'yyyy-MM-dd'), '-02-28', '-02-30') AS placed", "'2001-01-01' AS shipped"
    )
    return conform.date_rules(raw, {"placed": ("1996-01-01", "2000-12-31")}, {"shipped_after_placed": ("placed", "shipped")})
