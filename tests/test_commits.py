"""One commit for all tables of a batch; dimensions in buckets."""

import re

import pytest
from pyspark.sql import functions as F

from loomstar.operators.lookup import lookup_key
from loomstar.plans.commits import Commits, Conflict
from loomstar.sources.bucketed import BucketedDim


def test_a_batch_is_seen_whole_or_not_at_all(spark, tmp_path):
    commits, n = Commits(spark, f"{tmp_path}/w"), lambda s: {t: s.table(t).count() for t in ("dim", "fact") if t in s}
    assert commits.snapshot().number == 0 and n(commits.snapshot()) == {}
    with commits.batch("first") as batch:
        assert batch.put("dim", spark.range(3)) == 3
        assert n(commits.snapshot()) == {}
        batch.put("fact", batch.table("dim").crossJoin(spark.range(2).toDF("x")))
    pinned = commits.snapshot()
    assert n(pinned) == {"dim": 3, "fact": 6}
    with pytest.raises(ZeroDivisionError):  # a failure between two tables
        with commits.batch("second") as batch:
            batch.put("dim", spark.range(100))
            1 / 0
    assert commits.snapshot().number == 1 and n(commits.snapshot()) == {"dim": 3, "fact": 6} and len(list((tmp_path / "w" / "dim").iterdir())) == 1
    with commits.batch("third") as batch:
        batch.put("dim", spark.range(5).withColumn("name", F.lit("n")))
    assert n(commits.snapshot()) == {"dim": 5, "fact": 6} and n(pinned) == {"dim": 3, "fact": 6} and commits.snapshot().table("dim").columns == ["id", "name"]
    assert commits.roll_back(1) == 3 and n(commits.snapshot()) == {"dim": 3, "fact": 6} and n(commits.snapshot(2)) == {"dim": 5, "fact": 6}
    with pytest.raises(ValueError):
        commits.snapshot(9)
    with pytest.raises(KeyError):
        pinned.table("other")
    assert commits.vacuum(1) == 1 and commits.numbers() == [3] and n(commits.snapshot()) == {"dim": 3, "fact": 6}


def test_of_two_batches_on_one_commit_the_first_is_taken(spark, tmp_path):
    commits = Commits(spark, f"{tmp_path}/w")
    with pytest.raises(Conflict):
        with commits.batch("slow") as slow:
            slow.put("t", spark.range(1))
            with Commits(spark, f"{tmp_path}/w").batch("fast") as fast:
                fast.put("t", spark.range(2))
    assert commits.snapshot().table("t").count() == 2 and len(list((tmp_path / "w" / "t").iterdir())) == 1
    assert [p.name for p in (tmp_path / "w" / "_commits").iterdir() if not p.name.startswith(".")] == ["000000000001"]


@pytest.fixture
def no_broadcast(spark):
    wanted = {"spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.shuffle.partitions": 23}  # more partitions than buckets
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def exchanges_above_scan(text, table):
    """Whether a scan of the table has an exchange between it and the join above it."""
    lines, found = text.splitlines(), []
    for i, line in enumerate(lines):
        if "FileScan" in line and table in line:
            k, depth = i, len(re.match(r"[\s:+\-*()\d]*", line)[0])
            while k and "Join" not in lines[k]:
                k -= 1
                here = len(re.match(r"[\s:+\-*()\d]*", lines[k])[0])
                if here < depth:
                    depth = here
                    found += ["Exchange"] if "Exchange" in lines[k] else []
    return found


def test_only_the_batch_moves(spark, tmp_path, plan, rows, no_broadcast):
    dim = BucketedDim(spark, "dim_in_buckets", ["code", "part"], 6)
    try:
        members = spark.range(200).select(F.col("id").alias("member_key"), F.concat(F.lit("c"), "id").alias("code"), (F.col("id") % 3).cast("int").alias("part"), F.lit(None).cast("date").alias("created_date"), F.lit(None).cast("date").alias("last_updated_date"), F.lit("old").alias("name"))
        dim.write(members, f"{tmp_path}/d1")
        staging = spark.createDataFrame([("c7", 1, "x"), ("c7", 2, "y"), (None, 1, "z"), ("c9", 0, "w")], "c string, p int, v string")
        found = dim.lookup(staging, "member_key", {"p": "part", "c": "code"})
        assert rows(found, "v", "member_key") == [("w", 9), ("x", 7), ("y", None), ("z", None)]
        assert "dim_in_buckets" in plan(found) and exchanges_above_scan(plan(found), "dim_in_buckets") == []
        batch = spark.createDataFrame([("c7", 1, "new", 7), ("n", 1, "new", 999)], "code string, part int, name string, member_key bigint")
        members.write.saveAsTable("dim_plain", path=f"{tmp_path}/plain")
        assert exchanges_above_scan(plan(lookup_key(staging, spark.table("dim_plain"), "member_key", {"c": "code", "p": "part"})), "dim_plain") == ["Exchange"]
        assert exchanges_above_scan(plan(dim.upserted(batch, ["name"], "2024-01-02", ["name"])), "dim_in_buckets") == []
        after = dim.upserted(batch, ["name"], "2024-01-02", unique=True)
        assert exchanges_above_scan(plan(after), "dim_in_buckets") == []
        dim.write(after, f"{tmp_path}/d2")
        assert dim.read().count() == 201 and rows(dim.read().where("name = 'new'"), "member_key") == [(7,), (999,)]
        with pytest.raises(ValueError):
            dim.lookup(staging, "member_key", {"c": "code"})
    finally:
        spark.sql("DROP TABLE IF EXISTS dim_in_buckets")
        spark.sql("DROP TABLE IF EXISTS dim_plain")
