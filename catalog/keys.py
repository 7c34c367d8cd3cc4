"""Dedup, surrogate keys, lookups, bridges and integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog import inputs
from catalog.registry import Tables, query
from loomstar.functions.keys import hash_key
from loomstar.operators import dedup, integrity, lookup, project
from loomstar.operators.keys import with_dense_key, with_hash_key
from loomstar.plans import sales, star

LINE_ORDER = ["l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"]

# --- duplicates -------------------------------------------------------------------------------


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def _(t: Tables) -> DataFrame:
    return dedup.distinct_rows(t.lineitem, "l_partkey", "l_suppkey", "l_returnflag")


@query(
    "dedup_keep_first",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_suppkey, l_quantity, l_extendedprice) = 1""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_partkey", *LINE_ORDER[:4])
    return dedup.keep_first(rows, ["l_orderkey", "l_partkey"], LINE_ORDER[:4])


@query(
    "dedup_keep_last",
    """SELECT l_partkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1""",
)
def _(t: Tables) -> DataFrame:
    return dedup.keep_last(t.lineitem.select("l_partkey", *LINE_ORDER[:4]), ["l_partkey"], LINE_ORDER[:4])


@query(
    "latest_row",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
)
def _(t: Tables) -> DataFrame:
    return dedup.latest_row(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "latest_ties",
    """SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey FROM lineitem
       QUALIFY rank() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC) = 1""",
)
def _(t: Tables) -> DataFrame:
    return dedup.latest_ties(t.lineitem, ["l_partkey"], "l_shipdate").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey")


@query(
    "one_row_per_user",
    """SELECT o_custkey AS "userId", min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey""",
)
def _(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("userId"), "o_orderkey")
    return dedup.keep_first(rows, ["userId"], ["o_orderkey"])


@query(
    "duplicate_report",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
       QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dedup.duplicates(rows, ["l_orderkey", "l_linenumber"])


# --- surrogate keys ---------------------------------------------------------------------------


@query(
    "dense_keys",
    """SELECT row_number() OVER (ORDER BY p_name, p_brand, p_type) AS product_key, p_name, p_brand, p_type
       FROM (SELECT DISTINCT p_name, p_brand, p_type FROM part)""",
)
def _(t: Tables) -> DataFrame:
    names = ["p_name", "p_brand", "p_type"]
    return with_dense_key(t.part.select(*names).distinct(), "product_key", names)


@query(
    "dense_keys_next_batch",
    """WITH old AS (SELECT row_number() OVER (ORDER BY o_custkey) AS user_key, o_custkey
                    FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < DATE '1996-01-01')),
       fresh AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_custkey NOT IN (SELECT o_custkey FROM old))
       SELECT user_key, o_custkey FROM old
       UNION ALL SELECT (SELECT max(user_key) FROM old) + row_number() OVER (ORDER BY o_custkey), o_custkey FROM fresh""",
)
def _(t: Tables) -> DataFrame:
    cutoff = F.lit("1996-01-01").cast("timestamp_ntz")
    first = t.orders.where(F.col("o_orderdate") < cutoff).select("o_custkey").distinct()
    later = t.orders.where(F.col("o_orderdate") >= cutoff).select("o_custkey").distinct()
    old = with_dense_key(first, "user_key", ["o_custkey"])
    return old.unionByName(with_dense_key(later, "user_key", ["o_custkey"], existing=old))


@query(
    "hash_keys",
    "SELECT c_custkey, sha256('dim_user' || chr(1) || c_custkey || chr(1) || c_name) AS user_key FROM customer",
)
def _(t: Tables) -> DataFrame:
    return with_hash_key(t.customer, "user_key", "dim_user", ["c_custkey", "c_name"]).select("c_custkey", "user_key")


@query("unique_violations", "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(t: Tables) -> DataFrame:
    return integrity.unique_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "foreign_key_violations",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN
         (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')""",
)
def _(t: Tables) -> DataFrame:
    known = t.customer.where("c_mktsegment <> 'MACHINERY'")
    return integrity.foreign_key_violations(t.orders.select("o_orderkey", "o_custkey"), known, "o_custkey", "c_custkey")


@query(
    "primary_key_violations",
    """SELECT l_partkey, s AS l_suppkey, count(*) AS row_count
       FROM (SELECT l_partkey, CASE WHEN l_quantity >= 2 THEN l_suppkey END AS s FROM lineitem)
       GROUP BY l_partkey, s HAVING count(*) > 1 OR s IS NULL""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.selectExpr("l_partkey", "if(l_quantity < 2, NULL, l_suppkey) AS l_suppkey")
    return integrity.primary_key_violations(rows, ["l_partkey", "l_suppkey"])


# --- lookups and bridges ----------------------------------------------------------------------


@query(
    "combo_staging",
    f"""WITH {inputs.SALES_STAGING_SQL}
        SELECT id, "userId", date, "productId", quantity, title, price, rate, count, city, firstname, lastname FROM combo""",
)
def _(t: Tables) -> DataFrame:
    return combo(t).select("id", "userId", "date", "productId", "quantity", "title", "price", "rate", "count", "city", "firstname", "lastname")


def combo(t: Tables) -> DataFrame:
    return sales.combine_staging(
        sales.stage_products(inputs.product_documents(t)),
        sales.stage_carts(inputs.cart_documents(t)),
        sales.stage_users(inputs.user_documents(t)),
    )


@query(
    "key_lookup_one_column",
    """SELECT l_orderkey, l_linenumber, l_suppkey, p_partkey + 1 AS product_key FROM lineitem
       LEFT JOIN (SELECT * FROM part WHERE p_type <> 'ECONOMY') ON l_partkey = p_partkey""",
)
def _(t: Tables) -> DataFrame:
    dim = t.part.where("p_type <> 'ECONOMY'").selectExpr("p_partkey", "p_partkey + 1 AS product_key")
    keyed = lookup.lookup_key(t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"), dim, "product_key", {"l_partkey": "p_partkey"})
    return keyed.drop("l_partkey")


@query(
    "key_lookup_two_columns",
    """WITH dim AS (SELECT row_number() OVER (ORDER BY p_brand, p_type) AS kind_key, p_brand, p_type
                    FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size < 25))
       SELECT p_partkey, kind_key FROM part LEFT JOIN dim USING (p_brand, p_type)""",
)
def _(t: Tables) -> DataFrame:
    dim = with_dense_key(t.part.where("p_size < 25").select("p_brand", "p_type").distinct(), "kind_key", ["p_brand", "p_type"])
    return lookup.lookup_key(t.part, dim, "kind_key", ["p_brand", "p_type"]).select("p_partkey", "kind_key")


@query(
    "key_lookup_three_columns",
    """WITH dim AS (SELECT row_number() OVER (ORDER BY p_name, p_brand, p_type) AS name_key, p_name, p_brand, p_type
                    FROM (SELECT DISTINCT p_name, p_brand, p_type FROM part))
       SELECT p_partkey, name_key FROM part LEFT JOIN dim USING (p_name, p_brand, p_type)""",
)
def _(t: Tables) -> DataFrame:
    names = ["p_name", "p_brand", "p_type"]
    dim = with_dense_key(t.part.select(*names).distinct(), "name_key", names)
    return lookup.lookup_key(t.part, dim, "name_key", names).select("p_partkey", "name_key")


@query(
    "key_lookup_hot_split",
    """WITH dim AS (SELECT row_number() OVER (ORDER BY l_returnflag) AS flag_key, l_returnflag
                    FROM (SELECT DISTINCT l_returnflag FROM lineitem))
       SELECT l_orderkey, l_linenumber, l_suppkey, flag_key FROM lineitem JOIN dim USING (l_returnflag)""",
)
def _(t: Tables) -> DataFrame:
    """A dimension of three members, each with a third of all rows."""
    dim = with_dense_key(t.lineitem.select("l_returnflag").distinct(), "flag_key", ["l_returnflag"])
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    return lookup.lookup_key(rows, dim, "flag_key", ["l_returnflag"], hot_rows=1000).drop("l_returnflag")


@query(
    "batch_key_lookup",
    """SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) = DATE '2000-02-29' THEN c_custkey + 1 END AS user_key
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE CAST(o_orderdate AS DATE) = DATE '2000-02-29'""",
)
def _(t: Tables) -> DataFrame:
    staged = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("created_date"))
    dim = t.customer.selectExpr("c_custkey", "c_custkey + 1 AS user_key")
    today = project.batch_of(staged, "2000-02-29")
    return lookup.lookup_key(today, dim, "user_key", {"o_custkey": "c_custkey"}).select("o_orderkey", "user_key")


@query(
    "push_key",
    """SELECT c_custkey, min(o_orderkey) AS order_key FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P'
       GROUP BY c_custkey""",
)
def _(t: Tables) -> DataFrame:
    source = t.orders.where("o_orderstatus = 'P'").selectExpr("o_custkey", "o_orderkey AS order_key")
    return lookup.push_key(t.customer.select("c_custkey"), source, "order_key", {"c_custkey": "o_custkey"}, ["order_key"])


@query(
    "push_key_through",
    """SELECT o_custkey, n_regionkey AS region_key FROM (SELECT DISTINCT o_custkey FROM orders)
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def _(t: Tables) -> DataFrame:
    dim = t.orders.select("o_custkey").distinct()
    nations = t.nation.selectExpr("n_nationkey", "n_regionkey AS region_key")
    return lookup.push_key_through(
        dim, t.customer, nations, "region_key", {"o_custkey": "c_custkey"}, {"c_nationkey": "n_nationkey"}, ["c_custkey"]
    )


@query(
    "push_newest_key",
    """SELECT p_partkey, l_suppkey AS supplier_key FROM part LEFT JOIN
         (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_suppkey) = 1)
         ON p_partkey = l_partkey""",
)
def _(t: Tables) -> DataFrame:
    ties = dedup.latest_ties(t.lineitem.selectExpr("l_partkey", "l_suppkey AS supplier_key", "l_shipdate"), ["l_partkey"], "l_shipdate")
    return lookup.push_key(t.part.select("p_partkey"), ties, "supplier_key", {"p_partkey": "l_partkey"}, ["supplier_key"])


@query("bridge_keys", "SELECT DISTINCT l_partkey AS product_key, l_suppkey AS supplier_key FROM lineitem")
def _(t: Tables) -> DataFrame:
    return lookup.bridge(t.lineitem.selectExpr("l_partkey AS product_key", "l_suppkey AS supplier_key"), "product_key", "supplier_key")


@query("bridge_null_rows", "SELECT count(*) AS null_rows FROM lineitem WHERE l_quantity < 5")
def _(t: Tables) -> DataFrame:
    keyed = t.lineitem.selectExpr("l_partkey AS product_key", "if(l_quantity < 5, NULL, l_suppkey) AS user_key")
    return lookup.bridge_null_rows(keyed, "product_key", "user_key")


@query(
    "bridge_through_dim",
    """WITH dim AS (SELECT row_number() OVER (ORDER BY p_brand) AS brand_key, p_brand FROM (SELECT DISTINCT p_brand FROM part))
       SELECT DISTINCT brand_key, l_suppkey AS supplier_key FROM lineitem JOIN part ON l_partkey = p_partkey JOIN dim USING (p_brand)""",
)
def _(t: Tables) -> DataFrame:
    dim = with_dense_key(t.part.select("p_brand").distinct(), "brand_key", ["p_brand"])
    staged = t.lineitem.selectExpr("l_partkey", "l_suppkey AS supplier_key").join(t.part.selectExpr("p_partkey AS l_partkey", "p_brand"), "l_partkey")
    return lookup.bridge_through(staged, [(dim, "brand_key", ["p_brand"])], "supplier_key")


@query(
    "bridge_business_keys",
    """SELECT DISTINCT c_nationkey AS nation_key, l_partkey + 1 AS product_key FROM lineitem
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    staged = t.lineitem.select("l_orderkey", "l_partkey").join(t.orders.selectExpr("o_orderkey AS l_orderkey", "o_custkey"), "l_orderkey")
    products = t.part.selectExpr("p_partkey", "p_partkey + 1 AS product_key")
    users = t.customer.selectExpr("c_custkey", "c_nationkey AS nation_key")
    return lookup.bridge_through(
        staged, [(products, "product_key", {"l_partkey": "p_partkey"}), (users, "nation_key", {"o_custkey": "c_custkey"})]
    )


@query(
    "anti_insert",
    """SELECT DISTINCT CAST(l_shipdate AS DATE) AS sale_date, CAST(month(l_shipdate) AS INTEGER) AS month,
         CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem
       WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    known = t.orders.select(F.to_date("o_orderdate").alias("sale_date")).distinct()
    days = t.lineitem.select(F.to_date("l_shipdate").alias("sale_date")).distinct()
    fresh = lookup.missing_rows(days, known, ["sale_date"])
    return fresh.select("sale_date", F.month("sale_date").alias("month"), F.year("sale_date").alias("year"))


@query(
    "semi_probe",
    """SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice >= 450000)""",
)
def _(t: Tables) -> DataFrame:
    return lookup.existing_rows(t.customer.select("c_custkey"), t.orders.where("o_totalprice >= 450000"), {"c_custkey": "o_custkey"})


@query(
    "request_key_lookups",
    """SELECT o_orderkey AS request_no, p_partkey + 1 AS product_key, c_custkey + 1 AS user_key FROM orders
       LEFT JOIN part ON o_orderkey = p_partkey LEFT JOIN customer ON o_custkey = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    requests = t.orders.selectExpr("o_orderkey AS request_no", "o_orderkey AS product_id", "o_custkey AS user_id")
    products = t.part.selectExpr("p_partkey AS product_id", "p_partkey + 1 AS product_key")
    users = t.customer.selectExpr("c_custkey AS user_id", "c_custkey + 1 AS user_key")
    keyed = lookup.lookup_key(lookup.lookup_key(requests, products, "product_key", ["product_id"]), users, "user_key", ["user_id"])
    return keyed.select("request_no", "product_key", "user_key")


# --- single dimensions ------------------------------------------------------------------------


@query(
    "dim_part",
    """SELECT row_number() OVER (ORDER BY p_name, p_brand) AS product_key, p_name AS product_name, p_brand AS brand, p_type AS category, p_size AS size
       FROM (SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) = 1)""",
)
def _(t: Tables) -> DataFrame:
    columns = {"p_name": "product_name", "p_brand": "brand", "p_type": "category", "p_size": "size"}
    return star.build_dim(t.part, columns, ["product_name", "brand"], "product_key", ["p_partkey"])


@query(
    "dim_part_hashed",
    """SELECT sha256('dim_product' || chr(1) || p_name || chr(1) || p_brand) AS product_key, p_name AS product_name, p_brand AS brand, p_size AS size
       FROM part QUALIFY row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) = 1""",
)
def _(t: Tables) -> DataFrame:
    columns = {"p_name": "product_name", "p_brand": "brand", "p_size": "size"}
    return star.build_dim(t.part, columns, ["product_name", "brand"], "product_key", ["p_partkey"], hash_namespace="dim_product")


@query(
    "date_dim",
    """SELECT row_number() OVER (ORDER BY sale_date) AS date_key, sale_date, CAST(month(sale_date) AS INTEGER) AS month,
         CAST(year(sale_date) AS INTEGER) AS year FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS sale_date FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    return star.date_dim(t.orders, "o_orderdate")


@query(
    "dim_nation_snowflake",
    """WITH regions AS (SELECT row_number() OVER (ORDER BY r_name) AS region_key, r_name FROM region),
       nations AS (SELECT row_number() OVER (ORDER BY n_name) AS nation_key, n_name, n_regionkey FROM nation)
       SELECT nation_key, n_name AS nation_name, region_key FROM nations JOIN region ON n_regionkey = r_regionkey JOIN regions USING (r_name)""",
)
def _(t: Tables) -> DataFrame:
    staged = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    regions = star.build_dim(staged, {"r_name": "region_name"}, ["region_name"], "region_key")
    nations = star.build_dim(staged, {"n_name": "nation_name"}, ["nation_name"], "nation_key")
    return lookup.push_key_through(
        nations, staged, regions, "region_key", {"nation_name": "n_name"}, {"r_name": "region_name"}, ["region_key"]
    )


@query(
    "staging_key_by_hash",
    "SELECT l_orderkey, l_linenumber, sha256('dim_product' || chr(1) || l_partkey) AS product_key FROM lineitem",
)
def _(t: Tables) -> DataFrame:
    """Staging keyed without a join."""
    return t.lineitem.select("l_orderkey", "l_linenumber", hash_key("dim_product", "l_partkey").alias("product_key"))
