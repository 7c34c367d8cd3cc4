import datetime as dt

import pytest

from loomstar.operators import merge

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
TARGET = "key string, id string, name string, created_date date, last_updated_date date"


def target(spark):
    return spark.createDataFrame([("k1", "1", "one", D1, None), ("k2", "2", "two", D1, None), ("kn", None, "nobody", D1, None)], TARGET)


def test_upsert(spark, rows):
    batch = spark.createDataFrame(
        [("k1", "1", "uno", 1), ("k1", "1", "eins", 2), ("k3", "3", "three", 1), ("k4", "4", "a", 1), ("k4", "4", "b", 2), ("kx", None, "new", 1)],
        "key string, id string, name string, n int",
    )
    out = merge.upsert(target(spark), batch, ["id"], ["name"], "2024-01-02", ["n"])
    assert out.columns == target(spark).columns
    assert rows(out, "id", "name", "created_date", "last_updated_date") == [
        (None, "new", D2, None),
        (None, "nobody", D1, None),
        ("1", "eins", D1, D2),
        ("2", "two", D1, None),
        ("3", "three", D2, None),
        ("4", "b", D2, D2),
    ]


def test_upsert_twice_changes_nothing_more(spark, rows):
    batch = spark.createDataFrame([("k1", "1", "uno"), ("k2", "2", "dos")], "key string, id string, name string")
    once = merge.upsert(target(spark), batch, ["id"], ["name"], "2024-01-02")
    assert rows(merge.upsert(once, batch, ["id"], ["name"], "2024-01-02")) == rows(once)
    assert rows(merge.upsert(target(spark), batch, ["id"], ["name"], "2024-01-02", unique=True)) == rows(once)


def test_small_batch_moves_none_of_the_target(spark, plan, tmp_path):
    target(spark).write.parquet(f"{tmp_path}/t")
    spark.createDataFrame([("k1", "1", "uno")], "key string, id string, name string").write.parquet(f"{tmp_path}/b")
    out = merge.upsert(spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/b"), ["id"], ["name"], "2024-01-02", unique=True)
    text = plan(out)
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text and text.count("BroadcastHashJoin") == 3


def test_strict_merge(spark, rows):
    stamps = merge.stamp_today("2024-01-02")
    twice_new = spark.createDataFrame([("k9", "9", "a"), ("k9", "9", "b")], "key string, id string, name string")
    out = merge.merge(target(spark), twice_new, ["id"], ["name"], *stamps)
    assert [r for r in rows(out, "id", "name") if r[0] == "9"] == [("9", "a"), ("9", "b")]
    twice_old = spark.createDataFrame([("k1", "1", "a"), ("k1", "1", "b")], "key string, id string, name string")
    with pytest.raises(Exception, match="several source rows for target row 1"):
        merge.merge(target(spark), twice_old, ["id"], ["name"], *stamps).collect()
    lax = merge.merge(target(spark), twice_old, ["id"], ["name"], *stamps, strict=False, order=["name"])
    assert [r for r in rows(lax, "id", "name", "last_updated_date") if r[0] == "1"] == [("1", "b", D2)]


def test_merge_that_carries_the_source_stamp(spark, rows):
    batch = spark.createDataFrame([("k1", "1", "uno", D2), ("k3", "3", "tres", D2)], "key string, id string, name string, created_date date")
    out = merge.merge(target(spark), batch, ["id"], ["name"], *merge.stamp_from_source())
    assert rows(out, "id", "created_date", "last_updated_date") == [(None, D1, None), ("1", D2, D2), ("2", D1, None), ("3", D2, None)]


def test_insert_ignore(spark, rows):
    batch = spark.createDataFrame([("x", "1", "other", D2), ("y", "5", "b", D2), ("z", "5", "a", D2)], "key string, id string, name string, created_date date")
    out = merge.insert_ignore(target(spark), batch, ["id"], ["name"])
    assert rows(out, "id", "name") == [(None, "nobody"), ("1", "one"), ("2", "two"), ("5", "a")]
