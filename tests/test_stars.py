from pyspark.sql import functions as F

from loomstar.operators import integrity
from loomstar.plans import movies, reviews, sales
from loomstar.session import stored
from loomstar.sources.schemas import CART_DOCUMENT, PRODUCT_DOCUMENT, REVIEW_EXTRACT, USER_DOCUMENT, fit, target


def test_reviews_star(spark, rows):
    import datetime as dt

    day = dt.date(2024, 1, 1)
    row = lambda pid, name, u, un, r, rt, price: (pid, name, "c", "a", "i", "l", "4", None, price, price, "5%", u, un, r, rt, day)
    data = [row("p1", "Pen", "u1,u2", "Ann,Bob", "r1,r2", "x,y", "₹10"), row("p1", "Pen", "u1,u2", "Ann,Bob", "r1,r2", "x,y", "₹10"), row("p1", "Pen B", "u1", "Anne", "r3", "z", "₹1,200.5")]
    staging = stored(reviews.stage_reviews(spark.createDataFrame(data, REVIEW_EXTRACT)), "t")
    assert staging.count() == 3
    order = ["product_name", "review_id"]
    star = reviews.build(staging, order)
    assert star["dim_product"].count() == 2 and star["dim_user"].count() == 3 and star["dim_review"].count() == 3
    assert integrity.primary_key_violations(star["product_user_join"], ["product_key", "user_key"]).count() == 0
    assert integrity.foreign_key_violations(star["dim_review"], star["dim_product"], "product_key").count() == 0
    assert rows(star["fact_price"], "product_key", "discounted_price (PLN)") == [(1, 10.0), (2, 1200.5)]
    for name in ("dim_product", "dim_user", "product_user_join", "fact_price"):
        fit(star[name], target("reviews", name)).count()
    flat = reviews.build(staging, order, with_bridge=False)
    assert "product_user_join" not in flat and flat["dim_review"].where("user_key IS NULL").count() == 0


def test_movies_star(spark, rows):
    columns = "Poster_Link string, Series_Title string, Released_Year string, Certificate string, Runtime string, Genre string, IMDB_Rating string, Overview string, Meta_score double, Director string, No_of_Votes string, Gross string, Star1 string, Star2 string, Star3 string, Star4 string"
    data = [
        ("p", "Apollo 13", "PG", None, "140 min", "Adventure, Drama", "7.6", "o", None, "Ron", "1000", "173,837,933", "Tom", "Bill", "Kevin", None),
        ("p", "Drishyam", "2013", "U", "160 min", "Crime", "8.3", "o", 80.0, "Jeethu", "30", None, "Mohanlal", "Meena", "Asha", "Ansiba"),
        ("p", "Drishyam", "2015", "UA", "163 min", "Crime, Drama", "8.2", "o", 70.0, "Nishikant", "70", None, "Ajay", "Tabu", "Shriya", "Ajay"),
    ]
    staging = stored(movies.stage_movies(spark.createDataFrame(data, columns)), "t")
    assert staging.count() == 2 * 4 + 1 * 4 + 2 * 3
    assert rows(staging.where("Series_Title = 'Apollo 13'").select("Released_Year", "Gross", "Meta_score", "Certificate").distinct()) == [(0, 173837933, 0.0, "NA")]
    star = movies.build(staging)
    assert rows(star["dim_genre"], "Genre") == [("Adventure",), ("Crime",), ("Drama",)]
    assert star["dim_movie"].count() == 3 and star["dim_movie"].where("director_key IS NULL").count() == 0
    assert star["fact_gross"].count() == 4 + 4 + 3 and star["genre_movie"].count() == 5
    for name in target_names("movies"):
        fit(star[name], target("movies", name)).count()


def target_names(star):
    from loomstar.sources.schemas import TARGETS

    return TARGETS[star]


def test_sales_star(spark, rows):
    products = spark.createDataFrame([(1, "Bag", 10.0, "d", "c", "i", (3.9, 12)), (2, "Hat", 2.5, "d", "c", "i", (4.5, 7))], PRODUCT_DOCUMENT)
    carts = spark.createDataFrame([(1, 1, "2020-03-02T00:00:00.000Z", [(1, 4), (2, 1)], 0), (2, 1, "2020-01-02T00:00:00.000Z", [], 0), (3, 9, "2020-03-02T00:00:00.000Z", [(1, 1)], 0)], CART_DOCUMENT)
    users = spark.createDataFrame(
        [(1, "m", "u", "p", "t", 0, ("john", "o'NEIL"), ("kilcoole", "new road-east", 7, "z", ("1", "2"))), (2, "m", "u", "p", "t", 0, ("ida", "x"), ("oslo", "s", 1, "z", ("1", "2")))], USER_DOCUMENT
    )
    staging = stored(sales.combine_staging(sales.stage_products(products), sales.stage_carts(carts), sales.stage_users(users)), "t")
    assert rows(staging, "id", "productId", "quantity", "month", "year") == [(1, 1, 4, 3, 2020), (1, 2, 1, 3, 2020)]
    star = sales.build(staging, ["id", "productId"])
    assert rows(star["dim_user"], "first_name", "last_name", "email", "street", "city_key") == [("John", "O'neil", "***Masked***", "New Road-East", 1)]
    assert rows(star["sale_fact_table"], "product_key", "total_sale", "stock") == [(1, 40.0, 12), (2, 2.5, 7)]
    assert rows(sales.build(staging, ["id", "productId"], private=["password", "phone"])["dim_user"], "email", "phone") == [("m", "***Masked***")]
    for name in target_names("sales"):
        fit(star[name], target("sales", name)).count()


def test_facts_know_their_serial_key(spark):
    from loomstar.plans.star import build_fact

    fact = build_fact(spark.range(20).withColumn("k", F.lit(1)), {"amount": F.col("id")}, ["k"], serial="fact key (PLN)")
    assert sorted(r[0] for r in fact.collect()) == list(range(1, 21))


REVIEW = ("p1", "Pen", "c", "a", "i", "l", "4", None, "₹10", "₹10", "5%")


def _reviews(spark, lists):
    import datetime as dt

    rows = [(f"p{p}", *REVIEW[1:], *items, dt.date(2024, 1, 1)) for p, items in lists]
    return spark.createDataFrame(rows, REVIEW_EXTRACT)


def test_staging_without_duplicates_is_not_compared(spark, plan):
    staging = reviews.stage_reviews(_reviews(spark, [(p, ("u1,u2", "A,B", "r1,r2", "x,x")) for p in range(20)]))
    assert staging.count() == 40
    staging.collect()
    assert "HashAggregate" not in plan(staging).split("Initial Plan")[0]


def test_staging_drops_duplicates_within_and_across_wide_rows(spark, rows):
    same = [(1, ("u1,u1", "A,A", "r1,r1", "x,x")), (2, ("u1,u2", "A,B", "r1,r2", "x,y")), (2, ("u2,u3", "B,C", "r2,r3", "y,z")), (3, (None, None, None, None))]
    staging = reviews.stage_reviews(_reviews(spark, same))
    assert {tuple(r) for r in staging.select("product_id", "user_id").collect()} == {("p1", "u1"), ("p2", "u1"), ("p2", "u2"), ("p2", "u3"), ("p3", None)}
    assert staging.distinct().count() == staging.count() == 5


def test_movie_staging_compares_rows_as_filled(spark, plan):
    columns = "Poster_Link string, Series_Title string, Released_Year string, Certificate string, Runtime string, Genre string, IMDB_Rating string, Overview string, Meta_score double, Director string, No_of_Votes string, Gross string, Star1 string, Star2 string, Star3 string, Star4 string"
    row = lambda t, cert, genre, stars: ("p", t, "2001", cert, "1 min", genre, "7", "o", 1.0, "D", "1", "2", *stars)
    alike = [row("a", None, "X, Y", "stuv"), row("a", "NA", "Y", "stuw"), row("b", "U", "X, X", ["s", None, "NA", "t"]), row("c", "U", None, "stuv")]
    staging = movies.stage_movies(spark.createDataFrame(alike, columns))
    assert staging.count() == staging.distinct().count() == 9 + 3 + 4
    alone = movies.stage_movies(spark.createDataFrame([row(f"t{i}", "U", "X, Y", "stuv") for i in range(20)], columns))
    assert len(alone.collect()) == 160 and "HashAggregate" not in plan(alone).split("Initial Plan")[0]
