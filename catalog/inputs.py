"""Review, movie and sales sources derived row by row from the given tables, and the same in SQL.

Every derivation is a projection, so it costs no shuffle and grows with its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog.registry import Tables

# Product reviews, one wide row per line item; the number of packed reviews is the line number (1 to 7).
REVIEW_ORDER = [
    "modified_date", "review_id", "user_id", "product_name", "category", "about_product", "img_link", "rating",
    "rating_count", "discounted_price", "actual_price", "discount_percentage", "review_title",
]


#: Setting that names the partitions over which a derived source is spread; unset, rows stay where their files put them.
PARTITIONS = "loomstar.source.partitions"


def spread(df: DataFrame) -> DataFrame:
    wanted = df.sparkSession.conf.get(PARTITIONS, None)
    return df.repartition(int(wanted)) if wanted else df


def review_extract(t: Tables) -> DataFrame:
    def packed(item: str) -> str:
        return f"array_join(transform(sequence(1, l_linenumber), i -> {item}), ',')"

    return spread(t.lineitem).selectExpr(
        "concat('P', l_partkey) AS product_id",
        "concat('Part ', l_partkey, if(l_returnflag = 'R', ' (renewed)', '')) AS product_name",
        "l_returnflag AS category",
        "l_linestatus AS about_product",
        "concat('img/', l_suppkey) AS img_link",
        "concat('p/', l_partkey) AS product_link",
        "cast(l_linenumber AS string) AS rating",
        "if(l_quantity < 5, NULL, cast(cast(l_quantity AS bigint) AS string)) AS rating_count",
        "concat('₹', format_number(l_quantity * 100, 2)) AS discounted_price",
        "concat('₹', format_number(l_extendedprice, 2)) AS actual_price",
        "concat(cast(round(l_discount * 100) AS int), '%') AS discount_percentage",
        packed("concat('U', l_suppkey + i)") + " AS user_id",
        packed("concat('User ', l_suppkey + i)") + " AS user_name",
        packed("concat('R', l_orderkey, '-', l_partkey, '-', i)") + " AS review_id",
        packed("concat('Title ', l_returnflag, i)") + " AS review_title",
        "cast(l_shipdate AS date) AS modified_date",
    )


REVIEW_STAGING_SQL = """
reviews AS (
  SELECT DISTINCT
    'P' || l_partkey AS product_id,
    'Part ' || l_partkey || CASE WHEN l_returnflag = 'R' THEN ' (renewed)' ELSE '' END AS product_name,
    l_returnflag AS category, l_linestatus AS about_product, 'img/' || l_suppkey AS img_link,
    'p/' || l_partkey AS product_link, CAST(l_linenumber AS VARCHAR) AS rating,
    CASE WHEN l_quantity < 5 THEN '1' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS rating_count,
    l_quantity * 100 AS discounted_price, l_extendedprice AS actual_price,
    CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' AS discount_percentage,
    'U' || (l_suppkey + i) AS user_id, 'User ' || (l_suppkey + i) AS user_name,
    'R' || l_orderkey || '-' || l_partkey || '-' || i AS review_id,
    'Title ' || l_returnflag || i AS review_title, CAST(l_shipdate AS DATE) AS modified_date
  FROM (SELECT *, unnest(range(1, l_linenumber + 1)) AS i FROM lineitem)
)
"""
REVIEW_ORDER_SQL = ", ".join(REVIEW_ORDER)


def movies(t: Tables) -> DataFrame:
    """A movie table, one row per order: list-packed genre, four star columns, numbers as text."""
    return spread(t.orders).selectExpr(
        "concat('http://p/', o_orderkey) AS Poster_Link",
        "concat('Story ', o_custkey) AS Series_Title",
        "if(o_orderpriority = '5-LOW' AND o_orderstatus = 'P', 'PG', cast(year(o_orderdate) AS string)) AS Released_Year",
        "if(o_orderstatus = 'P', NULL, o_orderstatus) AS Certificate",
        "concat(month(o_orderdate), ' min') AS Runtime",
        "concat(o_orderpriority, ', ', o_orderstatus) AS Genre",
        "if(day(o_orderdate) = 1, 'n/a', concat(day(o_orderdate), '.5')) AS IMDB_Rating",
        "concat('Total ', cast(floor(o_totalprice) AS bigint)) AS Overview",
        "if(o_orderstatus = 'F', cast(NULL AS double), cast(month(o_orderdate) AS double)) AS Meta_score",
        "concat('Director ', month(o_orderdate)) AS Director",
        "cast(o_custkey AS string) AS No_of_Votes",
        "format_number(floor(o_totalprice), 0) AS Gross",
        "concat('Actor ', o_custkey) AS Star1",
        "concat('Actor ', o_custkey + 1) AS Star2",
        "concat('Actor ', o_orderpriority) AS Star3",
        "if(o_orderstatus = 'F', NULL, concat('Actor ', o_orderstatus)) AS Star4",
    )


MOVIE_STAGING_SQL = """
movie_rows AS (
  SELECT 'http://p/' || o_orderkey AS "Poster_Link", 'Story ' || o_custkey AS "Series_Title",
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 0 ELSE CAST(year(o_orderdate) AS BIGINT) END AS "Released_Year",
    CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE o_orderstatus END AS "Certificate",
    month(o_orderdate) || ' min' AS "Runtime",
    unnest([o_orderpriority, o_orderstatus]) AS "Genre",
    CASE WHEN day(o_orderdate) = 1 THEN 0.0 ELSE day(o_orderdate) + 0.5 END::DOUBLE AS "IMDB_Rating",
    'Total ' || CAST(floor(o_totalprice) AS BIGINT) AS "Overview",
    CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE month(o_orderdate) END::DOUBLE AS "Meta_score",
    'Director ' || month(o_orderdate) AS "Director", o_custkey AS "No_of_Votes",
    CAST(floor(o_totalprice) AS BIGINT) AS "Gross",
    ['Actor ' || o_custkey, 'Actor ' || (o_custkey + 1), 'Actor ' || o_orderpriority,
     CASE WHEN o_orderstatus = 'F' THEN 'NA' ELSE 'Actor ' || o_orderstatus END] AS stars
  FROM orders
),
movie_staging AS (SELECT DISTINCT * EXCLUDE (stars), unnest(stars) AS "Actor_Name" FROM movie_rows)
"""


def product_documents(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "p_partkey AS id", "p_name AS title", "p_retailprice AS price", "concat(p_brand, ' ', p_name) AS description",
        "p_type AS category", "concat('img/', p_partkey) AS image",
        "named_struct('rate', p_size / 10.0D, 'count', cast(p_size AS bigint) * 10) AS rating",
    )


def cart_documents(t: Tables) -> DataFrame:
    """One cart per order, with zero to three products by the day of the month."""
    lines = "transform(sequence(1, {n}), i -> named_struct('productId', o_custkey + i, 'quantity', cast(i AS bigint)))"
    count = "day(o_orderdate) % 4"
    return t.orders.selectExpr(
        "o_orderkey AS id", "o_custkey AS userId", "date_format(o_orderdate, \"yyyy-MM-dd'T'00:00:00.000'Z'\") AS date",
        f"if({count} = 0, array(), {lines.format(n=count)}) AS products", "cast(0 AS bigint) AS __v",
    )


def user_documents(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "c_custkey AS id", "concat(c_name, '@mail') AS email", "lower(c_name) AS username", "'secret' AS password",
        "cast(c_acctbal AS string) AS phone", "cast(0 AS bigint) AS __v",
        "named_struct('firstname', lower(c_mktsegment), 'lastname', upper(c_name)) AS name",
        "named_struct('city', concat('city ', c_nationkey), 'street', concat(\"o'neil-smith st \", lower(c_mktsegment)),"
        " 'number', cast(c_nationkey AS bigint), 'zipcode', cast(c_custkey AS string), 'geolocation',"
        " named_struct('lat', cast(c_nationkey AS string), 'long', cast(-c_nationkey AS string))) AS address",
    )


SALES_STAGING_SQL = """
carts AS (
  SELECT o_orderkey AS id, o_custkey AS "userId", CAST(o_orderdate AS DATE) AS date,
    o_custkey + i AS "productId", CAST(i AS BIGINT) AS quantity
  FROM (SELECT *, unnest(range(1, 1 + CAST(day(o_orderdate) AS BIGINT) % 4)) AS i FROM orders)
),
combo AS (
  SELECT s.id, s."userId", s.date, CAST(month(s.date) AS INTEGER) AS month, CAST(year(s.date) AS INTEGER) AS year,
    s."productId", s.quantity, p_name AS title, p_retailprice AS price, p_brand || ' ' || p_name AS description,
    p_type AS category, 'img/' || p_partkey AS image, CAST(p_size / 10.0 AS DOUBLE) AS rate,
    CAST(p_size AS BIGINT) * 10 AS count, c_name || '@mail' AS email, lower(c_name) AS username, 'secret' AS password,
    'city ' || c_nationkey AS city, c_nationkey, c_custkey,
    upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS firstname, upper(c_name[1]) || lower(c_name[2:]) AS lastname,
    'O''Neil-Smith St ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS street
  FROM carts s JOIN part ON s."productId" = p_partkey JOIN customer ON s."userId" = c_custkey
)
"""
SALES_ORDER = ["id", "productId", "quantity"]
