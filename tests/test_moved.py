"""What wide loads move: rows that meet no others stay where they are."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loomstar.operators import merge, reshape
from loomstar.plans import reviews, star
from loomstar.plans.daily import STAR, DailyReviews, _differing, _digests
from loomstar.plans.warehouse import Warehouse
from loomstar.session import stored
from loomstar.sources import records
from loomstar.sources.schemas import REVIEW_EXTRACT, target

DAY = "2024-01-02"


@pytest.fixture
def no_hints(spark):
    """Only what is known to be small is broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def members(spark, first, last):
    return spark.range(first, last).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), F.col("id").cast("string").alias("id"), F.lit("n").alias("name"), F.lit(None).cast("date").alias("created_date"))


def test_new_rows_of_a_large_batch_are_not_shuffled(spark, plan, rows, tmp_path, no_hints):
    members(spark, 0, 3000).write.parquet(f"{tmp_path}/t")
    members(spark, 2995, 6000).drop("created_date").withColumn("name", F.lit("m")).write.parquet(f"{tmp_path}/b")
    out = merge.upsert(spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/b"), ["id"], ["name"], DAY, unique=True)
    new = plan(out).split("Union")[1].split("LeftAnti")
    assert "Exchange hashpartitioning" not in plan(out).rpartition("LeftAnti")[2]
    assert len(new) == 2 and out.count() == 6000 and out.where("name = 'm'").count() == 3005


def test_a_snapshot_of_few_members_moves_few_rows(spark, plan, tmp_path, no_hints):
    wh = Warehouse(spark, str(tmp_path))
    held = members(spark, 0, 3000)
    wh.publish("dim", held, "2024-01-01")
    part = wh.snapshot("dim", held.schema, only=spark.range(2998, 9000).select(F.col("id").cast("string")))
    assert "Exchange hashpartitioning" not in plan(part) and part.count() == 2


def test_digests_tell_rows_apart(spark, rows):
    make = lambda data: spark.createDataFrame(data, "id string, a string, b string, d date")
    old = make([("1", None, "x", None), ("2", "x", None, None), ("3", "a", "b", None), ("4", "a", "b", None), (None, "q", "q", None)])
    new = make([("1", "x", None, None), ("2", "x", None, None), ("3", "ab", "", None), ("5", "a", "b", None), (None, "r", "q", None)])
    assert rows(_differing(_digests(old, "id"), _digests(new, "id"), "id")) == [("1",), ("3",), ("4",), ("5",)]


def test_equal_rows_are_put_together_before_they_are_sorted(spark, plan):
    staging = spark.range(100).selectExpr("cast(id % 5 AS string) AS t", "cast(id % 10 AS string) AS o")
    text = plan(star.build_dim(staging, ["t", "o"], ["t"], "key", hash_namespace="dim"))
    assert "HashAggregate" in text[text.rindex("Sort"):]


def test_a_split_is_added_up_in_runs(spark, rows, tmp_path, monkeypatch):
    text = "id,note\n" + "".join(f'{i},"a\n""{i}""\n\nb"\n' if i % 3 else f"{i},plain\n" for i in range(200))
    (tmp_path / "a.csv").write_text(text)
    whole = rows(records.csv_records(spark, str(tmp_path), "id long, note string")[0])
    monkeypatch.setattr(records, "_RUN_BITS", 2)
    monkeypatch.setattr(records, "_TASK_RUNS", 5)
    good, bad = records.csv_records(spark, str(tmp_path), "id long, note string")
    assert rows(good) == whole and len(whole) == 200 and bad.isEmpty()
    pieces = records._pieces(spark, str(tmp_path), "\n")
    assert pieces.groupBy(*records._PLACE).count().agg(F.max("count")).first()[0] <= 4
    placed = records._ahead(pieces, F.lit(1), "_n")
    assert placed.groupBy(F.spark_partition_id()).count().count() > 10
    assert placed.where("_n >= 0").select("_n").distinct().count() == pieces.count()


ORDER = ["product_id", "product_name", "review_id", "user_id", "user_name", "review_title"]
REVIEW = ("c", "a", "i", "l", "4", None, "₹10", "₹10", "5%")


def extract(spark, *lines):
    """Wide review rows from (product, name, users, names, reviews, titles), all of one day."""
    return spark.createDataFrame([(p, n, *REVIEW, *lists, dt.date(2024, 1, 1)) for p, n, *lists in lines], REVIEW_EXTRACT)


def test_lists_without_repeats_are_unpacked_in_one_pass(spark, plan):
    staging = reviews.stage_reviews(extract(spark, *[(f"p{i}", "Pen", "u1,u2", "A,B", "r1,r2", "x,x") for i in range(20)]))
    assert len(staging.collect()) == 40
    assert plan(staging).split("Initial Plan")[0].count("Generate inline") == 1


@pytest.mark.parametrize("mode", ["strict", "pad"])
def test_equal_items_of_one_row_come_out_once(spark, rows, mode):
    lists = [("k", ["x", "x", None, "y", None], ["1", "1", "2", "1", "2"]), ("m", None, ["5"]), ("n", None, None), ("o", ["b", "a"], ["1", "1"])]
    lists += [("q", ["a", "a", "a"], ["1"])] if mode == "pad" else []
    df = spark.createDataFrame(lists, "id string, a array<string>, b array<string>")
    found = reshape.explode_parallel(df, ["a", "b"], mode, distinct=True)
    assert rows(found) == rows(reshape.explode_parallel(df, ["a", "b"], mode).distinct()) and found.columns == df.columns


def test_only_users_of_several_names_are_put_in_order(spark, plan, rows, tmp_path):
    load = DailyReviews(Warehouse(spark, str(tmp_path)), ORDER)
    one = stored(load.extract(extract(spark, ("p1", "Pen", "u1,u2", "A,B", "r1,r2", "x,y"), ("p2", "Ink", "u1", "A", "r3", "z")), DAY), "staged")
    batch = load.user_batch(one)
    assert rows(batch, "user_id", "user_name") == [("u1", "A"), ("u2", "B")]
    batch.collect()
    assert "EmptyRelation Join LeftSemi" in plan(batch).split("Initial Plan")[0]  # no staged row is read for its order
    several = load.extract(extract(spark, ("p1", "Pen", "u1,u2", "A,B", "r1,r2", "x,y"), ("p2", "Ink", "u1", "C", "r0", "z"), ("p3", "Cap", None, None, None, None), ("p4", "Mug", "u2", "B", "r5", "z")), DAY)
    old = spark.createDataFrame([], target(STAR, "dim_user"))
    day = dt.date(2024, 1, 2)
    # the last of a user's names in order wins, and marks the row as updated; a user without an id is a row of its own
    assert rows(load.next_user(old, several, DAY), "user_id", "user_name", "last_updated_date") == [(None, None, None), ("u1", "C", day), ("u2", "B", None)]


def test_products_and_prices_come_from_one_search(spark, rows, tmp_path):
    load = DailyReviews(Warehouse(spark, str(tmp_path)), ORDER)
    lines = [("p1", "Pen", "u1,u2", "A,B", "r2,r1", "x,y"), ("p1", "Ink", "u1", "A", "r3", "z"), (None, "Cap", "u1", "A", "r4", "z"), (None, "Mug", "u1", "A", "r0", "z")]
    staged = stored(load.extract(extract(spark, *lines).withColumn("actual_price", F.concat(F.lit("₹"), F.ascii("review_id"), F.ascii("product_name"))), DAY), "staged")
    first = load.product_rows(staged)
    assert first.count() == 4 and first.count() < staged.count()
    assert rows(load.price_batch(first)) == rows(load.price_batch(staged))
    assert rows(load.product_batch(first), *staged.columns[:8]) == rows(load.product_batch(staged), *staged.columns[:8])


def test_prices_look_up_keys_for_the_first_rows_alone(spark, plan, rows, tmp_path):
    lines = [(f"p{i % 3}", "Pen" if i % 2 else None, "u1,u2", "A,B", f"r{i},s{i}", "x,y") for i in range(12)]
    reviews.stage_reviews(extract(spark, *lines)).write.parquet(f"{tmp_path}/staged")
    staged = spark.read.parquet(f"{tmp_path}/staged")
    fact = reviews.price_fact_only(staged, ORDER)
    assert f"{tmp_path}/staged" not in plan(fact)
    products = star.build_dim(staged, reviews.PRODUCT, list(reviews.PRODUCT_ON), "product_key", ORDER)
    whole = reviews.price_fact(star.load_keys(staged, [(products, "product_key", reviews.PRODUCT_ON)]), ORDER)
    assert rows(fact) == rows(whole) and fact.count() == 4


def test_staging_of_a_star_is_stored_small(spark, tmp_path):
    wide = spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"))
    size = lambda df: sum(Path(f.removeprefix("file://")).stat().st_size for f in df.inputFiles())
    assert size(stored(wide, "small", "zstd")) < 0.7 * size(stored(wide, "plain"))


def test_rows_known_to_be_met_are_not_searched_for(spark, rows):
    old, batch = members(spark, 0, 5), members(spark, 0, 9).drop("created_date").withColumn("name", F.lit("m"))
    assert rows(merge.upsert(old, batch, ["id"], ["name"], DAY, unique=True, met=True)) == rows(merge.upsert(old, batch, ["id"], ["name"], DAY, unique=True))
