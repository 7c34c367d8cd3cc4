"""Merges, facts, audits, stock, whole stars and the daily load."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog import inputs
from catalog.keys import combo
from catalog.registry import Tables, query
from loomstar.operators import dedup, merge, project
from loomstar.operators.audit import audit_row
from loomstar.operators.stock import apply_sales, record_sales
from loomstar.plans import movies, reviews, sales, star
from loomstar.plans.commits import Commits
from loomstar.plans.daily import STAR, DailyReviews
from loomstar.plans.warehouse import Warehouse
from loomstar.session import scratch_path, stored
from loomstar.sources import sinks
from loomstar.sources.bucketed import BucketedDim
from loomstar.sources.schemas import fit, target

# --- merges: customers known by the end of 1995, then everything they ordered since -----------

CUTOFF = "1996-01-01"
BATCH = "2001-08-02"


def _orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("last_order"),
        F.col("o_totalprice").alias("last_price"), F.to_date("o_orderdate").alias("created_date"),
    )


def _known(t: Tables) -> DataFrame:
    early = _orders(t).where(F.col("created_date") < F.lit(CUTOFF).cast("date"))
    first = dedup.latest_row(early, ["user_id"], "created_date", [F.col("last_order").desc()])
    return first.withColumn("last_updated_date", F.lit(None).cast("date"))


def _batch(t: Tables) -> DataFrame:
    return _orders(t).where(F.col("created_date") >= F.lit(CUTOFF).cast("date"))


def _upserted(t: Tables) -> DataFrame:
    return merge.upsert(
        _known(t), _batch(t), ["user_id"], ["last_order", "last_price"], BATCH, ["created_date", "last_order"]
    )


MERGE_SQL = f"""
all_orders AS (SELECT o_custkey AS user_id, o_orderkey AS last_order, o_totalprice AS last_price,
                 CAST(o_orderdate AS DATE) AS created_date FROM orders),
known AS (SELECT *, CAST(NULL AS DATE) AS last_updated_date FROM all_orders WHERE created_date < DATE '{CUTOFF}'
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created_date DESC, last_order DESC) = 1),
batch AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM all_orders WHERE created_date >= DATE '{CUTOFF}'
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created_date DESC, last_order DESC) = 1),
upserted AS (
  SELECT coalesce(b.user_id, k.user_id) AS user_id, coalesce(b.last_order, k.last_order) AS last_order,
    coalesce(b.last_price, k.last_price) AS last_price,
    CASE WHEN k.user_id IS NULL THEN DATE '{BATCH}' ELSE k.created_date END AS created_date,
    CASE WHEN b.user_id IS NULL THEN NULL WHEN k.user_id IS NOT NULL OR b.n > 1 THEN DATE '{BATCH}' END AS last_updated_date
  FROM known k FULL JOIN batch b ON k.user_id = b.user_id)
"""


@query("upsert_customer", f"WITH {MERGE_SQL} SELECT * FROM upserted")
def _(t: Tables) -> DataFrame:
    return _upserted(t)


@query("upsert_touched_files", f"WITH {MERGE_SQL} SELECT * FROM upserted")
def _(t: Tables) -> DataFrame:
    commits = Commits(t.spark, scratch_path(t.spark, "customers"))
    with commits.batch("known") as batch:
        batch.put("customer", _known(t), ["user_id"])
    with commits.batch("orders") as batch:
        batch.upsert("customer", _batch(t), ["user_id"], ["last_order", "last_price"], BATCH, ["created_date", "last_order"])
    return commits.snapshot().table("customer")


@query(
    "merge_strict",
    f"""WITH {MERGE_SQL} SELECT coalesce(b.user_id, k.user_id) AS user_id, coalesce(b.last_order, k.last_order) AS last_order,
          coalesce(b.last_price, k.last_price) AS last_price, coalesce(k.created_date, DATE '{BATCH}') AS created_date,
          CASE WHEN b.user_id IS NOT NULL AND k.user_id IS NOT NULL THEN DATE '{BATCH}' END AS last_updated_date
        FROM known k FULL JOIN batch b ON k.user_id = b.user_id""",
)
def _(t: Tables) -> DataFrame:
    unique = dedup.latest_row(_batch(t), ["user_id"], "created_date", [F.col("last_order").desc()])
    on_update, on_insert = merge.stamp_today(BATCH)
    return merge.merge(_known(t), unique, ["user_id"], ["last_order", "last_price"], on_update, on_insert, strict=True)


@query(
    "merge_source_stamp",
    f"""WITH {MERGE_SQL} SELECT coalesce(b.user_id, k.user_id) AS user_id, coalesce(b.last_order, k.last_order) AS last_order,
          coalesce(b.last_price, k.last_price) AS last_price, coalesce(b.created_date, k.created_date) AS created_date,
          CASE WHEN k.user_id IS NOT NULL THEN b.created_date END AS last_updated_date
        FROM known k FULL JOIN batch b ON k.user_id = b.user_id""",
)
def _(t: Tables) -> DataFrame:
    on_update, on_insert = merge.stamp_from_source()
    return merge.merge(
        _known(t), _batch(t), ["user_id"], ["last_order", "last_price"], on_update, on_insert,
        strict=False, order=["created_date", "last_order"],
    )


@query(
    "insert_ignore",
    f"""WITH {MERGE_SQL} SELECT user_id, last_order, created_date FROM known
        UNION ALL SELECT user_id, last_order, created_date FROM all_orders WHERE user_id NOT IN (SELECT user_id FROM known)
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created_date, last_order) = 1""",
)
def _(t: Tables) -> DataFrame:
    merged = merge.insert_ignore(_known(t), _batch(t), ["user_id"], ["created_date", "last_order"])
    return merged.select("user_id", "last_order", "created_date")


@query(
    "insert_ignore_null_keys",
    f"""WITH {MERGE_SQL}, asked AS (SELECT CASE WHEN last_order % 5 <> 0 THEN user_id END AS user_id, last_order, created_date FROM all_orders WHERE created_date >= DATE '{CUTOFF}')
        SELECT user_id, last_order, created_date FROM known UNION ALL SELECT * FROM asked WHERE user_id IS NULL
        UNION ALL (SELECT * FROM asked WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM known)
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created_date, last_order) = 1)""",
)
def _(t: Tables) -> DataFrame:
    """Rows without a key conflict with nothing."""
    batch = _batch(t).withColumn("user_id", F.when(F.col("last_order") % 5 != 0, F.col("user_id")))
    merged = merge.insert_ignore(_known(t), batch, ["user_id"], ["created_date", "last_order"])
    return merged.select("user_id", "last_order", "created_date")


# --- facts ------------------------------------------------------------------------------------


def _fact_rows(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_partkey").alias("product_key"), F.col("l_extendedprice").alias("actual_price"),
        F.col("l_orderkey").alias("sale_id"), F.to_date("l_shipdate").alias("created_date"),
    )


@query(
    "fact_append",
    """SELECT l_partkey AS product_key, l_extendedprice AS actual_price,
         CASE WHEN l_shipdate < DATE '2001-01-01' THEN DATE '2001-08-01' ELSE DATE '2001-08-02' END AS created_date FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    """Everything shipped before 2001 is in the fact already; the batch of the day is appended to it."""
    rows = _fact_rows(t).drop("sale_id")
    cut = F.lit("2001-01-01").cast("date")
    path = scratch_path(t.spark, "fact_price")
    sinks.write_table(project.stamp(rows.where(F.col("created_date") < cut), "2001-08-01"), path)
    staged = project.stamp(rows.where(F.col("created_date") >= cut), BATCH)
    sinks.write_table(project.batch_of(staged, BATCH), path, "append")
    return sinks.read_table(t.spark, path)


@query(
    "fact_serial_key",
    """SELECT count(*) AS row_count, CAST(1 AS BIGINT) AS low, count(*) AS high, count(*) AS different FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    fact = star.build_fact(_fact_rows(t), {"actual_price": F.col("actual_price")}, ["product_key"], serial="price_key")
    key = F.col("price_key")
    return fact.agg(F.count(key).alias("row_count"), F.min(key).alias("low"), F.max(key).alias("high"), F.countDistinct(key).alias("different"))


@query(
    "fact_latest",
    """SELECT l_partkey AS product_key, l_extendedprice AS actual_price, l_orderkey AS sale_id FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey, l_extendedprice) = 1""",
)
def _(t: Tables) -> DataFrame:
    return dedup.latest_row(_fact_rows(t), ["product_key"], "created_date", ["sale_id", "actual_price"]).drop("created_date")


# --- audit and stock --------------------------------------------------------------------------

AUDIT_COLUMNS = ["table_name", "staging_count", "insert_count", "update_count", "status", "log_date"]


@query(
    "audit_upsert",
    f"""WITH {MERGE_SQL} SELECT 'dim_user' AS table_name, (SELECT count(*) FROM batch) AS staging_count,
          count(*) FILTER (created_date = DATE '{BATCH}' AND last_updated_date IS NULL) AS insert_count,
          count(*) FILTER (last_updated_date = DATE '{BATCH}') AS update_count, 'PASS' AS status, DATE '{BATCH}' AS log_date
        FROM upserted""",
)
def _(t: Tables) -> DataFrame:
    staged = project.stamp(_batch(t), BATCH)
    return audit_row(staged, _upserted(t), "dim_user", "user_id", BATCH).select(*AUDIT_COLUMNS)


@query(
    "audit_missing_rows",
    """SELECT 'fact_price' AS table_name, (SELECT count(DISTINCT l_partkey) FROM lineitem) AS staging_count,
         count(*) AS insert_count, CAST(0 AS BIGINT) AS update_count,
         CASE WHEN count(*) = (SELECT count(DISTINCT l_partkey) FROM lineitem) THEN 'PASS' ELSE 'FAIL' END AS status,
         DATE '2001-08-02' AS log_date
       FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type <> 'ECONOMY'))""",
)
def _(t: Tables) -> DataFrame:
    """A load that lost the rows of one product category must not pass."""
    staged = project.stamp(t.lineitem.select(F.col("l_partkey").alias("product_key")), BATCH)
    kept = t.part.where("p_type <> 'ECONOMY'").selectExpr("p_partkey AS product_key")
    loaded = staged.join(kept, "product_key", "left_semi").distinct()
    return audit_row(staged, loaded, "fact_price", "product_key", BATCH, fact=True).select(*AUDIT_COLUMNS)


REQUEST_ORDER = ["sale_id", "line", "supplier", "quantity", "extended"]


@query(
    "apply_sales",
    """WITH req AS (SELECT l_orderkey AS sale_id, l_linenumber AS line, l_suppkey AS supplier, CAST(l_quantity AS BIGINT) AS quantity,
                      l_extendedprice AS extended, l_partkey AS product_id, l_suppkey AS user_id FROM lineitem),
       judged AS (
         SELECT req.*, p.p_partkey + 1 AS product_key, s.s_suppkey + 1 AS user_key, p_retailprice AS price, CAST(p_size AS BIGINT) * 8 AS least,
           coalesce(quantity > 0 AND quantity <= CAST(p_size AS BIGINT) * 10, false) AS accepted
         FROM req LEFT JOIN (SELECT * FROM part WHERE p_type <> 'ECONOMY') p ON product_id = p_partkey
                  LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 5000) s ON user_id = s_suppkey)
       SELECT line, supplier, extended, sale_id, product_key, user_key, CASE WHEN accepted THEN DATE '2001-08-02' END AS sale_date,
         CASE WHEN accepted THEN price END AS price, quantity, CASE WHEN accepted THEN price * quantity END AS total_sale,
         CAST(CASE WHEN accepted THEN least - sum(CASE WHEN accepted THEN quantity ELSE 0 END) OVER
           (PARTITION BY product_key ORDER BY sale_id, line, supplier, quantity, extended ROWS UNBOUNDED PRECEDING) END AS BIGINT) AS stock,
         accepted, CASE WHEN accepted THEN 'Sale successfully completed!' ELSE 'Insufficient Quantity! Check inventory.' END AS notice
       FROM judged""",
)
def _(t: Tables) -> DataFrame:
    stock = "cast(p_size AS bigint) * {}"
    rows = t.part.select(F.col("p_partkey").alias("product_id"), (F.col("p_partkey") + 1).alias("product_key"), F.col("p_retailprice").alias("price"),
                         F.expr(f"inline(array(named_struct('sale_key', 1, 'stock', {stock.format(10)}), named_struct('sale_key', 2, 'stock', {stock.format(8)})))"))
    products = t.part.where("p_type <> 'ECONOMY'").selectExpr("p_partkey AS product_id", "p_partkey + 1 AS product_key")
    users = t.supplier.where("s_acctbal > 5000").selectExpr("s_suppkey AS user_id", "s_suppkey + 1 AS user_key")
    requests = t.lineitem.selectExpr(
        "l_orderkey AS sale_id", "l_linenumber AS line", "l_suppkey AS supplier", "cast(l_quantity AS bigint) AS quantity",
        "l_extendedprice AS extended", "l_partkey AS product_id", "l_suppkey AS user_id",
    )
    return apply_sales(rows, requests, products, users, BATCH, REQUEST_ORDER, unique_order=False)


# --- reviews star -----------------------------------------------------------------------------


def _staged_reviews(t: Tables) -> DataFrame:
    return stored(reviews.stage_reviews(inputs.review_extract(t)), "stg_reviews", "zstd")


REVIEW_STAR_SQL = f"""{inputs.REVIEW_STAGING_SQL},
dim_product AS (SELECT *, row_number() OVER (ORDER BY product_id, product_name) AS product_key FROM
  (SELECT * FROM reviews QUALIFY row_number() OVER (PARTITION BY product_id, product_name ORDER BY {inputs.REVIEW_ORDER_SQL}) = 1)),
dim_user AS (SELECT *, row_number() OVER (ORDER BY user_id, user_name) AS user_key FROM (SELECT DISTINCT user_id, user_name FROM reviews)),
first_review AS (SELECT *, row_number() OVER (ORDER BY review_id) AS review_key FROM
  (SELECT * FROM reviews QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY {inputs.REVIEW_ORDER_SQL}) = 1))
"""


@query(
    "reviews_staging",
    f"WITH {inputs.REVIEW_STAGING_SQL} SELECT * FROM reviews",
)
def _(t: Tables) -> DataFrame:
    return reviews.stage_reviews(inputs.review_extract(t))


@query(
    "reviews_fact",
    f"""WITH {REVIEW_STAR_SQL} SELECT actual_price AS "actual_price (PLN)", discounted_price AS "discounted_price (PLN)",
          discount_percentage, product_key FROM dim_product""",
)
def _(t: Tables) -> DataFrame:
    return reviews.price_fact_only(reviews.stage_reviews(inputs.review_extract(t)), inputs.REVIEW_ORDER)


@query(
    "reviews_bridge",
    f"""WITH {REVIEW_STAR_SQL} SELECT DISTINCT product_key, user_key FROM reviews
        JOIN (SELECT product_id, product_name, product_key FROM dim_product) USING (product_id, product_name)
        JOIN dim_user USING (user_id, user_name)""",
)
def _(t: Tables) -> DataFrame:
    return reviews.build(_staged_reviews(t), inputs.REVIEW_ORDER)["product_user_join"]


@query(
    "reviews_dim_review",
    f"""WITH {REVIEW_STAR_SQL} SELECT review_key, review_id, review_title AS review_content, product_key, user_key FROM first_review
        JOIN (SELECT product_id, product_name, product_key FROM dim_product) USING (product_id, product_name)
        JOIN dim_user USING (user_id, user_name)""",
)
def _(t: Tables) -> DataFrame:
    return reviews.build(_staged_reviews(t), inputs.REVIEW_ORDER, with_bridge=False)["dim_review"]


# --- movies star ------------------------------------------------------------------------------



def _staged_movies(t: Tables) -> DataFrame:
    return stored(movies.stage_movies(inputs.movies(t)), "stg_movies")


MOVIE_STAR_SQL = f"""{inputs.MOVIE_STAGING_SQL},
m AS (SELECT *, row_number() OVER (ORDER BY "Series_Title", "Released_Year") AS movie_key FROM (SELECT * FROM movie_staging
  QUALIFY row_number() OVER (PARTITION BY "Series_Title", "Released_Year" ORDER BY "Runtime", "Overview", "Meta_score", "IMDB_Rating", "Certificate", "Poster_Link", "Director") = 1)),
a AS (SELECT *, row_number() OVER (ORDER BY "Actor_Name") AS actor_key FROM (SELECT DISTINCT "Actor_Name" FROM movie_staging)),
d AS (SELECT *, row_number() OVER (ORDER BY "Director") AS director_key FROM (SELECT DISTINCT "Director" FROM movie_staging)),
g AS (SELECT *, row_number() OVER (ORDER BY "Genre") AS genre_key FROM (SELECT DISTINCT "Genre" FROM movie_staging)),
keyed AS (SELECT s.*, movie_key, actor_key, director_key, genre_key FROM movie_staging s
  JOIN (SELECT "Series_Title", "Released_Year", movie_key FROM m) USING ("Series_Title", "Released_Year")
  JOIN a USING ("Actor_Name") JOIN d USING ("Director") JOIN g USING ("Genre"))
"""


@query("movies_staging", f"WITH {inputs.MOVIE_STAGING_SQL} SELECT * FROM movie_staging")
def _(t: Tables) -> DataFrame:
    return movies.stage_movies(inputs.movies(t))


@query(
    "movies_fact",
    f"""WITH {MOVIE_STAR_SQL} SELECT DISTINCT "Gross", "No_of_Votes", movie_key, actor_key, director_key FROM keyed""",
)
def _(t: Tables) -> DataFrame:
    return movies.gross_fact(movies.build(_staged_movies(t))["stg_movies"])


@query(
    "movies_fact_keys",
    f"""WITH {MOVIE_STAR_SQL} SELECT count(*) AS row_count, count(*) AS different, CAST(1 AS BIGINT) AS low, count(*) AS high
        FROM (SELECT DISTINCT "Gross", "No_of_Votes", movie_key, actor_key, director_key FROM keyed)""",
)
def _(t: Tables) -> DataFrame:
    """The fact's own keys: one each, without gaps."""
    fact = fit(movies.build(_staged_movies(t))["fact_gross"], target("movies", "fact_gross"))
    key = F.col("gross_key")
    return fact.agg(F.count(key).alias("row_count"), F.countDistinct(key).alias("different"), F.min(key).alias("low"), F.max(key).alias("high"))


@query(
    "movies_dim_movie",
    f"""WITH {MOVIE_STAR_SQL} SELECT movie_key, "Series_Title", "Released_Year", "Runtime", "Overview", "Meta_score", "IMDB_Rating",
          "Certificate", "Poster_Link", low AS director_key FROM m JOIN (SELECT movie_key, min(director_key) AS low FROM keyed GROUP BY movie_key) USING (movie_key)""",
)
def _(t: Tables) -> DataFrame:
    return movies.build(_staged_movies(t))["dim_movie"]


@query(
    "movies_bridges",
    f"""WITH {MOVIE_STAR_SQL} SELECT DISTINCT 'genre_movie' AS bridge, genre_key AS left_key, movie_key AS right_key FROM keyed
        UNION ALL SELECT DISTINCT 'actor_movie', actor_key, movie_key FROM keyed
        UNION ALL SELECT DISTINCT 'director_actor', director_key, actor_key FROM keyed""",
)
def _(t: Tables) -> DataFrame:
    tables = movies.build(_staged_movies(t))
    out = None
    for name in ("genre_movie", "actor_movie", "director_actor"):
        left, right = tables[name].columns
        rows = tables[name].select(F.lit(name).alias("bridge"), F.col(left).alias("left_key"), F.col(right).alias("right_key"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "movies_full_load",
    f"""WITH {MOVIE_STAR_SQL}, n AS (
          SELECT 'dim_actor' AS table_name, count(*) AS n FROM a UNION ALL SELECT 'dim_director', count(*) FROM d
          UNION ALL SELECT 'dim_genre', count(*) FROM g UNION ALL SELECT 'dim_movie', count(*) FROM m
          UNION ALL SELECT 'actor_movie', count(*) FROM (SELECT DISTINCT actor_key, movie_key FROM keyed)
          UNION ALL SELECT 'fact_gross', count(*) FROM (SELECT DISTINCT "Gross", "No_of_Votes", movie_key, actor_key, director_key FROM keyed))
        SELECT table_name, n AS staging_count, n AS insert_count, 'PASS' AS status, DATE '{BATCH}' AS log_date FROM n""",
)
def _(t: Tables) -> DataFrame:
    """A star with hash keys, written table by table with an audit row for each."""
    staging = _staged_movies(t)
    built = movies.build(staging, hashed=True)
    names = ("dim_actor", "dim_director", "dim_genre", "dim_movie", "actor_movie", "fact_gross")
    expected = {
        "dim_actor": (staging, ["Actor_Name"]), "dim_director": (staging, ["Director"]), "dim_genre": (staging, ["Genre"]),
        "dim_movie": (staging, ["Series_Title", "Released_Year"]), "actor_movie": (staging, ["Actor_Name", "Series_Title", "Released_Year"]),
        "fact_gross": (staging, ["Gross", "No_of_Votes", "Series_Title", "Released_Year", "Actor_Name", "Director"]),
    }
    wh = Warehouse(t.spark, scratch_path(t.spark, "full"))
    return wh.load_star({n: built[n] for n in names}, expected, BATCH).select("table_name", "staging_count", "insert_count", "status", "log_date")


# --- sales star -------------------------------------------------------------------------------

SALES_STAR_SQL = f"""{inputs.SALES_STAGING_SQL},
p AS (SELECT *, row_number() OVER (ORDER BY "productId", title) AS product_key FROM (SELECT DISTINCT "productId", title FROM combo)),
u AS (SELECT *, row_number() OVER (ORDER BY "userId", firstname, lastname) AS user_key FROM
  (SELECT DISTINCT "userId", firstname, lastname, street, city, c_nationkey, c_custkey FROM combo)),
dt AS (SELECT *, row_number() OVER (ORDER BY date) AS date_key FROM (SELECT DISTINCT date FROM combo)),
ct AS (SELECT *, row_number() OVER (ORDER BY city) AS city_key FROM (SELECT DISTINCT city FROM combo))
"""


@query(
    "sales_fact",
    f"""WITH {SALES_STAR_SQL} SELECT id AS sale_id, price, quantity, price * quantity AS total_sale, count AS stock, product_key, user_key, date_key
        FROM combo JOIN p USING ("productId", title) JOIN u USING ("userId", firstname, lastname) JOIN dt USING (date)""",
)
def _(t: Tables) -> DataFrame:
    return sales.sale_fact(sales.build(stored(combo(t), "stg_combo"), inputs.SALES_ORDER)["stg_combo_table"])


@query(
    "sales_second_load",
    f"""WITH {SALES_STAR_SQL},
        first AS (SELECT "productId", title, row_number() OVER (ORDER BY "productId", title) AS product_key FROM
          (SELECT DISTINCT "productId", title FROM combo WHERE id % 2 = 0)),
        later AS (SELECT "productId", title, (SELECT count(*) FROM first) + row_number() OVER (ORDER BY "productId", title) AS product_key FROM
          (SELECT DISTINCT "productId", title FROM combo ANTI JOIN first USING ("productId", title)))
        SELECT id AS sale_id, quantity, product_key FROM combo JOIN (FROM first UNION ALL FROM later) USING ("productId", title)""",
)
def _(t: Tables) -> DataFrame:
    """Half of the carts make the first load; the second one keeps its keys and goes on from them."""
    staging = stored(combo(t), "stg_combo")
    before = sales.build(staging.where("id % 2 = 0"), inputs.SALES_ORDER)
    known = {name: stored(before[name], name) for name in ("dim_product", "dim_user", "dim_city", "dim_date")}
    star_ = sales.build(staging, inputs.SALES_ORDER, existing=known)
    return sales.sale_fact(star_["stg_combo_table"]).select("sale_id", "quantity", "product_key")


@query(
    "apply_sales_to_star",
    f"""WITH {SALES_STAR_SQL},
        level AS (SELECT "productId", title, max(count) AS most, min(count) AS least, any_value(price) AS price FROM combo GROUP BY ALL),
        asked AS (SELECT o_orderkey AS sale_id, o_custkey AS user_id, o_custkey + 1 AS product_id, CAST(1 + o_orderkey % 40 AS BIGINT) AS quantity FROM orders),
        sold AS (SELECT sale_id, quantity, price * quantity AS total_sale,
            CAST(least - sum(quantity) OVER (PARTITION BY "productId" ORDER BY sale_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stock
          FROM asked JOIN level ON product_id = "productId" WHERE quantity <= most)
        SELECT sale_id, quantity, total_sale, stock, (SELECT count(DISTINCT date) + 1 FROM combo) AS date_key,
          CAST((SELECT count(*) FROM combo) AS BIGINT) AS earlier FROM sold""",
)
def _(t: Tables) -> DataFrame:
    """Requests of a new day against the sales star: its date is added, and the sales go on from the fact's keys."""
    star_ = sales.build(stored(combo(t), "stg_combo"), inputs.SALES_ORDER)
    fact, dates = stored(star_["sale_fact_table"], "fact"), stored(star_["dim_date"], "dates")
    asked = t.orders.selectExpr("o_orderkey AS sale_id", "o_custkey AS user_id", "o_custkey + 1 AS product_id", "cast(1 + o_orderkey % 40 AS bigint) AS quantity")
    answered = apply_sales(fact, asked, star_["dim_product"], star_["dim_user"], BATCH, ["sale_id"])
    _, sold = record_sales(fact, dates, answered, BATCH)
    lowest = sold.agg(F.min("sale_key") - 1).scalar()
    return sold.select("sale_id", "quantity", "total_sale", "stock", "date_key", lowest.alias("earlier"))


@query(
    "sales_dim_user",
    f"""WITH {SALES_STAR_SQL} SELECT user_key, "userId" AS user_id, firstname AS first_name, lastname AS last_name, '***Masked***' AS email,
          '***Masked***' AS username, '***Masked***' AS password, '***Masked***' AS phone, street, CAST(c_nationkey AS BIGINT) AS number,
          CAST(c_custkey AS VARCHAR) AS zipcode, CAST(c_nationkey AS VARCHAR) AS latitude, CAST(-c_nationkey AS VARCHAR) AS longitude, city_key
        FROM u JOIN ct USING (city)""",
)
def _(t: Tables) -> DataFrame:
    return sales.build(stored(combo(t), "stg_combo"), inputs.SALES_ORDER)["dim_user"]


# --- daily load: the whole review extract arriving on three days ------------------------------

DAY_SQL = "CASE WHEN modified_date < DATE '1998-01-01' THEN 1 WHEN modified_date < DATE '2000-01-01' THEN 2 ELSE 3 END"


def _daily_source(t: Tables) -> DataFrame:
    day = F.when(F.col("modified_date") < F.lit("1998-01-01").cast("date"), 1).when(F.col("modified_date") < F.lit("2000-01-01").cast("date"), 2).otherwise(3)
    return inputs.review_extract(t).withColumn("modified_date", F.date_add(F.lit("2023-12-31").cast("date"), day))


DAILY_ORDER = [c for c in inputs.REVIEW_ORDER if c != "modified_date"]
DAILY_ORDER_SQL = ", ".join(DAILY_ORDER)
DAILY_SQL = f"""{inputs.REVIEW_STAGING_SQL},
staged AS (SELECT DISTINCT * EXCLUDE (modified_date), DATE '2024-01-01' + CAST({DAY_SQL} AS INTEGER) AS created_date FROM reviews),
pairs AS (SELECT * FROM staged QUALIFY row_number() OVER (PARTITION BY created_date, product_id, product_name ORDER BY {DAILY_ORDER_SQL}) = 1),
members AS (
  SELECT 'dim_product' AS table_name, created_date, product_id AS id, count(*) AS n FROM pairs GROUP BY ALL
  UNION ALL SELECT DISTINCT 'dim_user', created_date, user_id, 1 FROM staged
  UNION ALL SELECT DISTINCT 'dim_review', created_date, review_id, 1 FROM staged),
firsts AS (SELECT table_name, id, min(created_date) AS first_day FROM members GROUP BY ALL)
"""


@query(
    "daily_audit_log",
    f"""WITH {DAILY_SQL} SELECT table_name, count(*) AS staging_count, count(*) FILTER (created_date = first_day AND n = 1) AS insert_count,
          count(*) FILTER (created_date > first_day OR n > 1) AS update_count, 'PASS' AS status, created_date AS log_date
        FROM members JOIN firsts USING (table_name, id) GROUP BY table_name, created_date
        UNION ALL SELECT 'fact_price', count(DISTINCT product_id), count(DISTINCT product_id), 0, 'PASS', created_date FROM staged GROUP BY created_date""",
)
def _(t: Tables) -> DataFrame:
    """Three batch dates, each staged, merged, loaded and audited on disk."""
    load = DailyReviews(Warehouse(t.spark, scratch_path(t.spark, "daily")), DAILY_ORDER)
    return load.replay(_daily_source(t), "2024-01-02", 3).select(*AUDIT_COLUMNS)


@query(
    "daily_rerun_audit",
    f"""WITH {DAILY_SQL} SELECT table_name, count(*) AS staging_count, count(*) FILTER (created_date = first_day AND n = 1) AS insert_count,
          count(*) FILTER (created_date > first_day OR n > 1) AS update_count, 'PASS' AS status, created_date AS log_date
        FROM members JOIN firsts USING (table_name, id) GROUP BY table_name, created_date
        UNION ALL SELECT 'fact_price', count(DISTINCT product_id), count(DISTINCT product_id), 0, 'PASS', created_date FROM staged GROUP BY created_date""",
)
def _(t: Tables) -> DataFrame:
    """Three batch dates, and the first one again: the days after it are built anew upon it."""
    load, source = DailyReviews(Warehouse(t.spark, scratch_path(t.spark, "daily")), DAILY_ORDER), _daily_source(t)
    load.replay(source, "2024-01-02", 3)
    load.run_batch(source, "2024-01-02")
    return load.audit_log().select(*AUDIT_COLUMNS)


@query(
    "daily_dim_product",
    f"""WITH {DAILY_SQL},
        last AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY created_date DESC,
                 {', '.join(c + ' DESC' for c in DAILY_ORDER)}) = 1),
        days AS (SELECT id AS product_id, min(created_date) AS first_day, max(created_date) AS last_day, max_by(n, created_date) AS last_n
                 FROM members WHERE table_name = 'dim_product' GROUP BY id)
        SELECT sha256('dim_product' || chr(1) || product_id) AS product_key, product_id, product_name, category, about_product, img_link,
          product_link, rating, rating_count, first_day AS created_date,
          CASE WHEN last_day > first_day OR last_n > 1 THEN last_day END AS last_updated_date
        FROM last JOIN days USING (product_id)""",
)
def _(t: Tables) -> DataFrame:
    load = DailyReviews(Warehouse(t.spark, scratch_path(t.spark, "unused")), DAILY_ORDER)
    dim = t.spark.createDataFrame([], target(STAR, "dim_product"))
    for day in ("2024-01-02", "2024-01-03", "2024-01-04"):
        dim = stored(load.next_product(dim, load.extract(_daily_source(t), day), day), "dim_product")
    return dim


# --- an older day again, carried through the later days by what changed ------------------------


def _corrected_source(t: Tables) -> DataFrame:
    """The source of the three days, in which the first day has lost every third product and another category for every fifth one."""
    number, first = F.expr("cast(substr(product_id, 2) AS bigint)"), F.col("modified_date") == F.lit("2024-01-01").cast("date")
    kept = _daily_source(t).where(~(first & (number % 3 == 0)))
    return kept.withColumn("category", F.when(first & (number % 5 == 0), F.lit("moved")).otherwise(F.col("category")))


def _backfilled(t: Tables) -> DailyReviews:
    load = DailyReviews(Warehouse(t.spark, scratch_path(t.spark, "daily")), DAILY_ORDER)
    load.replay(_daily_source(t), "2024-01-02", 3)
    load.run_batch(_corrected_source(t), "2024-01-02")
    return load


CORRECTED_SQL = DAILY_SQL.replace(
    "\nstaged AS (SELECT DISTINCT * EXCLUDE (modified_date),",
    """
corrected AS (SELECT * EXCLUDE (category), CASE WHEN modified_date < DATE '1998-01-01' AND CAST(substr(product_id, 2) AS BIGINT) % 5 = 0 THEN 'moved' ELSE category END AS category
  FROM reviews WHERE NOT (modified_date < DATE '1998-01-01' AND CAST(substr(product_id, 2) AS BIGINT) % 3 = 0)),
staged AS (SELECT DISTINCT * EXCLUDE (modified_date),""",
).replace("AS created_date FROM reviews)", "AS created_date FROM corrected)")


@query(
    "daily_backfill_delta",
    f"""WITH {CORRECTED_SQL},
        last AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY created_date DESC,
                 {', '.join(c + ' DESC' for c in DAILY_ORDER)}) = 1),
        days AS (SELECT id AS product_id, min(created_date) AS first_day, max(created_date) AS last_day, max_by(n, created_date) AS last_n
                 FROM members WHERE table_name = 'dim_product' GROUP BY id)
        SELECT sha256('dim_product' || chr(1) || product_id) AS product_key, product_id, product_name, category, about_product, img_link,
          product_link, rating, rating_count, first_day AS created_date,
          CASE WHEN last_day > first_day OR last_n > 1 THEN last_day END AS last_updated_date
        FROM last JOIN days USING (product_id)""",
)
def _(t: Tables) -> DataFrame:
    """Three days, then the first one again from a corrected source: the product dimension as if loaded so from the start."""
    return _backfilled(t).wh.snapshot("dim_product", target(STAR, "dim_product"))


@query(
    "daily_backfill_audit",
    f"""WITH {CORRECTED_SQL} SELECT table_name, count(*) AS staging_count, count(*) FILTER (created_date = first_day AND n = 1) AS insert_count,
          count(*) FILTER (created_date > first_day OR n > 1) AS update_count, 'PASS' AS status, created_date AS log_date
        FROM members JOIN firsts USING (table_name, id) GROUP BY table_name, created_date
        UNION ALL SELECT 'fact_price', count(DISTINCT product_id), count(DISTINCT product_id), 0, 'PASS', created_date FROM staged GROUP BY created_date""",
)
def _(t: Tables) -> DataFrame:
    return _backfilled(t).audit_log().select(*AUDIT_COLUMNS)


# --- whole batches and bucketed dimensions ------------------------------------------------------


@query(
    "atomic_batch",
    """SELECT 'pinned' AS view, (SELECT count(*) FROM customer WHERE c_nationkey % 2 = 0) AS members, (SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey % 2 = 0) AS facts
       UNION ALL SELECT 'after a failure', (SELECT count(*) FROM customer), (SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey)
       UNION ALL SELECT 'rolled back', (SELECT count(*) FROM customer WHERE c_nationkey % 2 = 0), (SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey % 2 = 0)""",
)
def _(t: Tables) -> DataFrame:
    """Two batches of two tables, a third that fails between them, and the way back; a reader stays with the first."""
    commits = Commits(t.spark, scratch_path(t.spark, "commits"))

    def load(members: DataFrame, broken: bool = False) -> None:
        with commits.batch("load") as batch:
            batch.put("dim_user", members)
            if broken:
                raise RuntimeError("lost between two tables")
            batch.put("fact", t.orders.join(batch.table("dim_user").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_custkey"))

    load(t.customer.where("c_nationkey % 2 = 0"))
    pinned = commits.snapshot()
    load(t.customer)
    try:
        load(t.customer.limit(1), broken=True)
    except RuntimeError:
        after = commits.snapshot()
    commits.roll_back(pinned.number)
    out = None
    for view, held in (("pinned", pinned), ("after a failure", after), ("rolled back", commits.snapshot())):
        members = held.table("dim_user").agg(F.count(F.lit(1)).alias("n")).scalar()
        row = held.table("fact").agg(F.lit(view).alias("view"), F.count(F.lit(1)).alias("facts")).select("view", members.alias("members"), "facts")
        out = row if out is None else out.unionByName(row)
    return out


def _in_buckets(t: Tables, members: DataFrame) -> BucketedDim:
    path = scratch_path(t.spark, "buckets")
    dim = BucketedDim(t.spark, f"buckets_{path.rpartition('-')[2]}", ["part_id"], 8)
    dim.write(members, path)
    return dim


@query("bucketed_lookup", "SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 <> 0 THEN l_partkey * 10 END AS part_key FROM lineitem")
def _(t: Tables) -> DataFrame:
    """Keys from a dimension in buckets, which lacks every seventh part."""
    dim = _in_buckets(t, t.part.where("p_partkey % 7 <> 0").selectExpr("p_partkey * 10 AS part_key", "p_partkey AS part_id", "p_name AS name"))
    return dim.lookup(t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey")), "part_key", {"l_partkey": "part_id"}).drop("l_partkey")


@query(
    "bucketed_upsert",
    f"""SELECT p_partkey AS part_id, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS name,
          CASE WHEN p_partkey % 2 = 0 THEN DATE '2023-01-01' ELSE DATE '{BATCH}' END AS created_date, CASE WHEN p_partkey % 6 = 0 THEN DATE '{BATCH}' END AS last_updated_date
        FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0""",
)
def _(t: Tables) -> DataFrame:
    """Half of the parts in buckets, a third of all in the batch."""
    old = t.part.where("p_partkey % 2 = 0").selectExpr("p_partkey AS part_id", "p_name AS name", "date '2023-01-01' AS created_date", "cast(NULL AS date) AS last_updated_date")
    return _in_buckets(t, old).upserted(t.part.where("p_partkey % 3 = 0").selectExpr("p_partkey AS part_id", "upper(p_name) AS name"), ["name"], BATCH, ["name"])
