"""Bad input, clashes and missing settings must fail, whichever columns are asked for; re-runs must agree."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomstar import session
from loomstar.operators import dedup, lookup, merge
from loomstar.plans import reviews
from loomstar.plans.daily import STAR, DailyReviews
from loomstar.plans.warehouse import Warehouse
from loomstar.sources import readers, schemas, sinks
from loomstar.streaming.pickup import append_to_raw, pick_up
from tests.test_daily import ORDER, extract


def lines(spark, path, *rows):
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(str(path))
    return str(path)


def test_bad_json_fails(spark, tmp_path):
    for n, bad in enumerate(('{"id": 2, "v', '{"id": "zz", "v": 1}')):
        path = lines(spark, tmp_path / str(n), '{"id": 1, "v": 5}', bad)
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
            readers.read_ndjson(spark, path, "id bigint, v bigint").collect()
        good, wrong = readers.quarantine(spark, path, "id bigint, v bigint")
        assert [tuple(r) for r in good.collect()] == [(1, 5)] and [r[0] for r in wrong.collect()] == [bad]


def test_bad_csv_fails(spark, tmp_path):
    path, short = lines(spark, tmp_path / "a", "id,v", "1,5", "2,x"), lines(spark, tmp_path / "d", "id,v", "1,5", "2")
    for broken, pick in ((path, ["id", "v"]), (path, ["v"]), (short, ["id", "v"]), (short, ["id"])):
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
            readers.read_csv(spark, broken, "id bigint, v bigint").select(*pick).collect()
    good, bad = readers.quarantine(spark, path, "id bigint, v bigint", "csv")
    assert good.select("id").collect() == [(1,)] and bad.collect() == [("2,x",)]
    swapped = lines(spark, tmp_path / "b", "v,id", "1,5")
    with pytest.raises(Exception, match="header does not conform|FAILED_READ"):
        readers.read_csv(spark, swapped, "id bigint, v bigint").collect()
    with pytest.raises(ValueError, match="does not name"):
        readers.read_indexed_csv(spark, lines(spark, tmp_path / "c", ",v,id", "0,1,5"), "id bigint, v bigint")
    with pytest.raises(Exception):
        pick_up(spark, path, "id bigint, v bigint", str(tmp_path / "seen"), append_to_raw(str(tmp_path / "raw")), header=True)


def test_line_breaks_survive(spark, tmp_path):
    df = spark.createDataFrame([(1, 'two\nlines, "quoted"'), (2, "one")], "id bigint, t string")
    sinks.land_csv(df, str(tmp_path / "x"), index=True)
    back = readers.read_indexed_csv(spark, str(tmp_path / "x"), "id bigint, t string", multiline=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_strict_checks_survive_pruning(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "id int, name string")
    merged = merge.merge(target, twice, ["id"], ["name"])
    for action in (lambda: merged.count(), lambda: merged.select("id").collect()):
        with pytest.raises(Exception, match="several source rows"):
            action()
    pushed = lookup.push_key(target, spark.createDataFrame([(1, 7), (1, 8)], "id int, k int"), "k", ["id"], ["k"], strict=True)
    for action in (lambda: pushed.count(), lambda: pushed.select("id").collect()):
        with pytest.raises(Exception, match="several k values"):
            action()


def test_insert_ignore_keeps_rows_without_a_key(spark, rows):
    schema = "id int, name string"
    target = spark.createDataFrame([(1, "a"), (None, "old")], schema)
    batch = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "p"), (None, "p")], schema)
    assert rows(merge.insert_ignore(target, batch, ["id"], ["name"])) == [(None, "old"), (None, "p"), (None, "p"), (1, "a"), (2, "y")]


def test_ties_are_pruned_before_the_shuffle(spark, plan):
    df = spark.range(1000).select((F.col("id") % 5).alias("k"), (F.col("id") % 7).alias("v"), F.col("id").alias("i"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(dedup.latest_ties(df, ["k"], "v"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "WindowGroupLimit" in text
    assert len(dedup.latest_ties(df, ["k"], "v").collect()) == sum(1 for i in range(1000) if i % 7 == 6)


def test_a_cluster_needs_a_shared_folder():
    assert session._one_machine("local[8]") and session._one_machine("local")
    assert not session._one_machine("local-cluster[2,1,1024]") and not session._one_machine("yarn")


def test_scratch_is_freed(spark, tmp_path):
    with session.scratch(spark):
        kept = session.stored(spark.range(3), "inner")
        path = kept.inputFiles()[0].rpartition("/")[0]
    assert not Warehouse(spark, "")._exists(path)


@pytest.mark.parametrize("day", ["2024-01-02", "2024-01-03"])
def test_an_older_day_runs_again(spark, tmp_path, rows, day):
    source, names = extract(spark), ["dim_product", "dim_user", "dim_review"]
    load = DailyReviews(Warehouse(spark, str(tmp_path)), ORDER)
    load.replay(source, "2024-01-02", 3)
    state = lambda: {n: rows(load.wh.snapshot(n, target_of(n))) for n in names}
    target_of = lambda n: schemas.target(STAR, n)
    before = state()
    load.run_batch(source, day)
    assert state() == before and load.audit_log().where("status <> 'PASS'").count() == 0 and load.audit_log().count() == 12
    # a changed source reaches the days built upon it
    changed = source.withColumn("category", F.when(F.col("modified_date") < F.lit(day).cast("date"), F.lit("other")).otherwise(F.col("category")))
    load.run_batch(changed, day)
    assert load.audit_log().where("status <> 'PASS'").count() == 0
    assert load.wh.snapshot("dim_product", target_of("dim_product")).where("category = 'other'").count() > 0


def test_a_day_writes_its_own_rows_only(spark, tmp_path, rows):
    source = extract(spark)
    load = DailyReviews(Warehouse(spark, str(tmp_path)), ORDER)
    load.replay(source, "2024-01-02", 3)
    schema = schemas.target(STAR, "dim_product")
    assert [r[0] for r in rows(load.wh.day("dim_product", schema, "2024-01-04"), "product_id")] == ["p4"]
    now = rows(load.wh.snapshot("dim_product", schema))
    assert len(now) == 4
    load.wh.compact("dim_product", schema, "2024-01-03")
    load.wh.forget_before("dim_product", "2024-01-03")
    assert rows(load.wh.snapshot("dim_product", schema)) == now and load.wh.versions("dim_product") == ["2024-01-04"]
    with pytest.raises(ValueError):
        load.wh.forget_before("dim_user", "2024-01-03")
    wanted = spark.createDataFrame([("p1",), ("p9",)], "id string")
    assert rows(load.wh.snapshot("dim_product", schema, only=wanted), "product_id") == [("p1",)]


def test_price_rows_of_every_staged_row(spark, tmp_path):
    load = DailyReviews(Warehouse(spark, str(tmp_path)), ORDER, grain="rows")
    log = load.replay(extract(spark), "2024-01-02", 3)
    fact = load.wh.table("fact_price", schemas.target(STAR, "fact_price"))
    assert fact.count() == load.wh.table("stg_product_review", fact.schema).count() == fact.select("price_key").distinct().count()
    assert log.where("status <> 'PASS'").count() == 0


def test_keys_go_on_in_a_second_load(spark, rows):
    order = ["review_id", "modified_date"]
    staging = session.stored(reviews.stage_reviews(extract(spark)), "stg")
    first = reviews.build(staging.where(F.col("modified_date") < F.lit(dt.date(2024, 1, 2))), order)
    known = {n: session.stored(first[n], n) for n in ("dim_product", "dim_user", "dim_review", "fact_price")}
    star = reviews.build(staging, order, existing=known)
    for name, df in known.items():
        key = schemas.target("reviews", name).names[0]
        both = star[name]
        assert both.select(key).distinct().count() == both.count()
        if name != "fact_price":
            assert set(r[0] for r in df.select(key).collect()) < set(r[0] for r in both.select(key).collect())
            old = df.drop("product_key") if name == "dim_review" else df
            assert both.join(old, old.columns, "left_semi").count() == df.count()
        else:
            assert both.agg(F.min(key)).first()[0] == df.agg(F.max(key)).first()[0] + 1
    assert star["stg_reviews"].where("product_key IS NULL OR user_key IS NULL").count() == 0


def test_only_what_is_asked_for_is_built(spark, monkeypatch):
    asked = []
    real = reviews.star.build_dim
    monkeypatch.setattr(reviews.star, "build_dim", lambda *a, **k: asked.append(a[3]) or real(*a, **k))
    reviews.build(reviews.stage_reviews(extract(spark)), ["review_id"])["product_user_join"]
    assert asked == ["product_key", "user_key"]


def test_hash_keys_need_no_dimension(spark, monkeypatch):
    staging = session.stored(reviews.stage_reviews(extract(spark)), "stg")
    asked = []
    real = reviews.star.build_dim
    monkeypatch.setattr(reviews.star, "build_dim", lambda *a, **k: asked.append(a[3]) or real(*a, **k))
    star = reviews.build(staging, ["review_id"], hashed=True)
    fact = star["fact_price"]
    assert not asked
    assert fact.join(star["dim_product"], "product_key", "left_anti").count() == 0 and fact.select("price_key").distinct().count() == fact.count() == 6
    later = reviews.build(staging, ["review_id"], hashed=True, existing={"dim_product": session.stored(star["dim_product"].limit(2), "some")})
    assert sorted(map(tuple, later["dim_product"].collect())) == sorted(map(tuple, star["dim_product"].collect()))


def test_a_target_without_its_key_is_refused(spark):
    with pytest.raises(ValueError, match="no values for the key product_key"):
        schemas.fit(spark.range(1).select(F.lit("a").alias("product_id")), schemas.target("reviews", "dim_product"))
