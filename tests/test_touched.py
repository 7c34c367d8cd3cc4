"""Upserts that write only the files that hold keys of the batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomstar.operators.merge import upsert
from loomstar.plans.commits import Commits
from loomstar.sources import touched

DAY, SCHEMA = "2024-01-02", "id long, name string, created_date date, last_updated_date date"


@pytest.fixture
def dim(spark, tmp_path):
    """A table of 800 members in 8 files, and its commits (in a folder whose name has a space)."""
    commits = Commits(spark, f"{tmp_path}/a store")
    old = spark.range(800).select("id", F.lit("old").alias("name"), F.lit("2024-01-01").cast("date").alias("created_date"), F.lit(None).cast("date").alias("last_updated_date"))
    with commits.batch("first") as batch:
        batch.put("dim", old, ["id"], 8)
    return commits


def load(commits, rows, **more):
    incoming = commits.spark.createDataFrame(rows, "id long, name string")
    expected = upsert(commits.snapshot().table("dim"), incoming, ["id"], ["name"], DAY, ["name"])
    expected = commits.spark.createDataFrame(expected.collect(), SCHEMA)
    with commits.batch("load") as batch:
        counts = batch.upsert("dim", incoming, ["id"], ["name"], DAY, ["name"], **more)
    return counts, expected


@pytest.mark.parametrize("listed", [touched.LISTED, 1])
def test_only_files_with_keys_of_the_batch_are_replaced(dim, rows, monkeypatch, listed):
    monkeypatch.setattr(touched, "LISTED", listed)
    first = dim.snapshot()
    files = set(dim.files_in(first.record["tables"]["dim"]["path"]))
    assert len(files) == 8
    # one old member, twice; one new; one without a key
    counts, expected = load(dim, [(5, "a"), (5, "b"), (9000, "new"), (None, "none")])
    assert counts == (1, 7)
    now = dim.snapshot()
    assert rows(now.table("dim")) == rows(expected) and now.table("dim").count() == 802
    assert len(files & set(now.record["tables"]["dim"]["files"])) == 7
    assert rows(now.table("dim").where("id = 5")) == [(5, "b", dt.date(2024, 1, 1), dt.date(2024, 1, 2))]
    # again, from a table that is already a list of files; keys at both ends touch the first and the last old file
    counts, expected = load(dim, [(0, "x"), (799, "y")], files=2)
    assert counts[0] == 2 and rows(dim.snapshot().table("dim")) == rows(expected)
    assert rows(first.table("dim").groupBy("name").count()) == [("old", 800)]  # readers of the first commit see what they saw


def test_new_members_and_empty_batches_replace_no_file(dim, rows):
    counts, expected = load(dim, [(1000 + i, "new") for i in range(5)])
    assert counts == (0, 8) and rows(dim.snapshot().table("dim")) == rows(expected)
    counts, expected = load(dim, [])
    assert counts[0] == 0 and rows(dim.snapshot().table("dim")) == rows(expected)


def test_vacuum_drops_replaced_files_and_keeps_the_others(dim, rows):
    _, expected = load(dim, [(5, "b")])
    path = dim.snapshot(1).record["tables"]["dim"]["path"]
    assert dim.vacuum(2) == 0 and len(dim.files_in(path)) == 8
    assert dim.vacuum(1) == 0 and len(dim.files_in(path)) == 7
    assert rows(dim.snapshot().table("dim")) == rows(expected)


def test_a_failed_upsert_changes_nothing(dim):
    with pytest.raises(ZeroDivisionError):
        with dim.batch("load") as batch:
            batch.upsert("dim", dim.spark.createDataFrame([(5, "b")], "id long, name string"), ["id"], ["name"], DAY)
            1 / 0
    assert dim.snapshot().number == 1 and dim.snapshot().table("dim").where("name = 'old'").count() == 800


def test_keys_reach_the_scan(dim, plan):
    target = dim.snapshot().table("dim")
    assert "In(id, [5" in plan(target.where(F.col("id").isin([5, 7]))) and "ReadSchema: struct<id:bigint>" in plan(target.select("id"))
