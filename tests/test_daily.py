import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomstar.operators.audit import audit_row
from loomstar.plans.daily import STAR, DailyReviews
from loomstar.plans.warehouse import Warehouse
from loomstar.sources.schemas import REVIEW_EXTRACT, target

ORDER = ["product_id", "product_name", "review_id", "user_id", "user_name", "review_title"]


def extract(spark):
    def row(pid, name, users, names, reviews, titles, day, price="₹1,099"):
        return (pid, name, "cat", "about", "img", "link", "4.1", None, price, "₹2,000.50", "45%", users, names, reviews, titles, dt.date(2024, 1, day))

    data = [
        row("p1", "Pen", "u1,u2", "Ann,Bob", "r1,r2", "good,bad", 1),
        row("p2", "Ink", "u1", "Ann", "r3", "fine", 1),
        row("p1", "Pen XL", "u3", "Cid", "r4", "new", 2, "₹999"),
        row("p3", "Cap", "u2", "Rob", "r2", "worse", 2),
        row("p4", "Mug", "u4", "Dee", "r5", "ok", 3),
        row("p4", "Mug 2", "u4", "Dee", "r6", "ok", 3),
    ]
    return spark.createDataFrame(data, REVIEW_EXTRACT)


@pytest.fixture
def load(spark, tmp_path):
    return DailyReviews(Warehouse(spark, str(tmp_path)), ORDER)


def test_three_days(spark, load, rows):
    log = load.replay(extract(spark), "2024-01-02", 3)
    assert log.where("status <> 'PASS'").count() == 0
    assert rows(log.where("log_date = '2024-01-03'"), "table_name", "staging_count", "insert_count", "update_count") == [
        ("dim_product", 2, 1, 1), ("dim_review", 2, 1, 1), ("dim_user", 2, 1, 1), ("fact_price", 2, 2, 0),
    ]
    products = load.wh.snapshot("dim_product", target(STAR, "dim_product"))
    day = lambda d: dt.date(2024, 1, d)
    assert rows(products, "product_id", "product_name", "rating_count", "created_date", "last_updated_date") == [
        ("p1", "Pen XL", "1", day(2), day(3)), ("p2", "Ink", "1", day(2), None), ("p3", "Cap", "1", day(3), None), ("p4", "Mug 2", "1", day(4), day(4)),
    ]
    reviews = load.wh.snapshot("dim_review", target(STAR, "dim_review"))
    named = reviews.join(products.select("product_key", "product_id"), "product_key")
    assert rows(named, "review_id", "review_content", "product_id") == [
        ("r1", "good", "p1"), ("r2", "worse", "p3"), ("r3", "fine", "p2"), ("r4", "new", "p1"), ("r5", "ok", "p4"), ("r6", "ok", "p4"),
    ]
    fact = load.wh.table("fact_price", target(STAR, "fact_price"))
    assert fact.count() == 5 and fact.select("price_key").distinct().count() == 5
    assert rows(fact.where("created_date = '2024-01-03'"), "discounted_price") == [(1099.0,), (999.0,)]


def test_a_day_can_run_again(spark, load, rows):
    source = extract(spark)
    load.replay(source, "2024-01-02", 3)
    names = ["dim_product", "dim_user", "dim_review"]
    before = {n: rows(load.wh.snapshot(n, target(STAR, n))) for n in names}
    staged = load.wh.spark.read.parquet(load.wh.path("stg_product_review")).count()
    load.run_batch(source, "2024-01-04")
    assert {n: rows(load.wh.snapshot(n, target(STAR, n))) for n in names} == before
    assert load.wh.spark.read.parquet(load.wh.path("stg_product_review")).count() == staged
    assert load.audit_log().count() == 12 and load.audit_log().where("status <> 'PASS'").count() == 0


def test_unfinished_snapshot_is_ignored(spark, load, tmp_path):
    load.replay(extract(spark), "2024-01-02", 1)
    (tmp_path / "dim_product" / "as_of=2024-01-03").mkdir()
    assert load.wh.versions("dim_product") == ["2024-01-02"]
    assert load.wh.snapshot("dim_product", target(STAR, "dim_product")).count() == 2


def test_lookup_by_pair_gives_the_losing_name_no_key(spark, tmp_path, rows):
    load = DailyReviews(Warehouse(spark, str(tmp_path)), ORDER, by_pair=True)
    log = load.replay(extract(spark), "2024-01-02", 3)
    staged = spark.read.parquet(load.wh.path("stg_keyed"))
    assert rows(staged.where("product_key IS NULL"), "product_name") == [("Mug",)]
    # The null key is inserted into the fact but is no key of staging, so this one load does not pass.
    assert rows(log.where("status = 'FAIL'"), "table_name", "staging_count", "insert_count") == [("fact_price", 1, 2)]


def test_first_load_takes_everything(spark, load):
    load.run_batch(extract(spark), "2024-01-02", days_back=None)
    assert load.wh.snapshot("dim_product", target(STAR, "dim_product")).count() == 4
    assert load.audit_log().where("status = 'PASS'").count() == 4


def test_an_empty_day_passes(spark, load):
    log = load.replay(extract(spark), "2024-01-02", 5)
    assert log.where("log_date = '2024-01-06' AND staging_count = 0 AND status = 'PASS'").count() == 4


def test_a_lost_row_fails_the_audit(spark, rows):
    staged = spark.createDataFrame([("a", dt.date(2024, 1, 2)), ("b", dt.date(2024, 1, 2)), (None, dt.date(2024, 1, 2))], "id string, created_date date")
    loaded = staged.dropna().withColumn("last_updated_date", F.lit(None).cast("date"))
    assert audit_row(staged, loaded, "t", "id", "2024-01-02").first().status == "PASS"
    assert audit_row(staged, loaded.where("id = 'a'"), "t", "id", "2024-01-02").first().status == "FAIL"
    with_null = staged.withColumn("last_updated_date", F.lit(None).cast("date"))
    assert audit_row(staged, with_null, "t", "id", "2024-01-02").first().status == "FAIL"
