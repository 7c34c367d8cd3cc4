import random

import pytest
from pyspark.sql import functions as F

from loomstar.operators import dedup, integrity, lookup, ordering
from loomstar.operators.keys import with_dense_key, with_serial
from loomstar.operators.skew import hot_keys, split_join


def skewed(spark, n=600, seed=3):
    """A third of the rows share one key, some keys are null, rows repeat."""
    draw = random.Random(seed)
    data = [(None if draw.random() < 0.1 else 1 if draw.random() < 0.35 else draw.randrange(2, 60), draw.randrange(4), i) for i in range(n)]
    return data, spark.createDataFrame(data, "k int, v int, i int")


@pytest.mark.parametrize("parts", [1, 7])
def test_first_and_last_row_do_not_depend_on_layout(spark, rows, parts):
    data, df = skewed(spark)
    first, last = {}, {}
    for k, v, i in data:
        first[k] = min(first.get(k, (v, i)), (v, i))
        last[k] = max(last.get(k, (v, i)), (v, i))
    df = df.repartition(parts)
    assert {r.k: (r.v, r.i) for r in dedup.keep_first(df, ["k"], ["v", "i"]).collect()} == first
    assert {r.k: (r.v, r.i) for r in dedup.keep_last(df, ["k"], ["v", "i"]).collect()} == last


def test_keep_first_cuts_groups_before_the_shuffle(spark, plan):
    _, df = skewed(spark)
    assert plan(dedup.keep_first(df, ["k"], ["v", "i"])).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("hot_rows", [1, 50, 10**9])
def test_ties_and_duplicates_with_and_without_hot_keys(spark, rows, hot_rows):
    data, df = skewed(spark)
    top, count = {}, {}
    for k, v, _ in data:
        top[k] = max(top.get(k, v), v)
        count[k, v] = count.get((k, v), 0) + 1
    ties = sorted(i for k, v, i in data if v == top[k])
    assert sorted(r.i for r in dedup.latest_ties(df, ["k"], "v", hot_rows).collect()) == ties
    repeats = sorted(i for k, v, i in data if count[k, v] > 1)
    assert sorted(r.i for r in dedup.duplicates(df, ["k", "v"], hot_rows).collect()) == repeats


def test_the_hot_branch_costs_nothing_without_hot_keys(spark, plan, tmp_path):
    skewed(spark)[1].write.parquet(f"{tmp_path}/t")
    ties = dedup.latest_ties(spark.read.parquet(f"{tmp_path}/t"), ["k"], "v")
    assert "Union" in plan(ties)
    ties.collect()
    assert "Union" not in plan(ties).split("Initial Plan")[0]


def test_latest_ties_when_all_values_are_null(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (2, 5)], "k int, v int")
    assert rows(dedup.latest_ties(df, ["k"], "v")) == [(1, None), (1, None), (2, 5)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_join(spark, rows, how):
    _, df = skewed(spark)
    right = spark.createDataFrame([(k, f"n{k}") for k in range(0, 40, 2)] + [(1, "one"), (None, "none")], "k int, name string")
    split = split_join(df, right, ["k"], how, hot_keys(df, ["k"], 40))
    theirs = right.withColumnRenamed("k", "rk")
    plain = df.join(theirs, F.col("k").eqNullSafe(F.col("rk")), how).drop("rk")
    assert hot_keys(df, ["k"], 40).count() >= 1
    assert rows(split) == rows(plain)


def test_dense_keys_follow_the_business_key_and_stay(spark, rows):
    names = [(f"n{i:03d}",) for i in range(200)] + [(None,)]
    first = with_dense_key(spark.createDataFrame(names[::2], "name string").repartition(5), "key", ["name"])
    expected = {n: i + 1 for i, (n,) in enumerate(sorted(names[::2], key=lambda r: (r[0] is not None, r[0])))}
    assert {r.name: r.key for r in first.collect()} == expected
    again = with_dense_key(spark.createDataFrame(names, "name string").repartition(3), "key", ["name"], existing=first)
    fresh = sorted(n for (n,) in names[1::2])
    assert {r.name: r.key for r in again.collect()} == {n: len(expected) + i + 1 for i, n in enumerate(fresh)}
    assert with_dense_key(first.select("name"), "key", ["name"], existing=first).count() == 0


def test_serial_is_dense(spark):
    keyed = with_serial(spark.range(1000).repartition(7), "key")
    assert sorted(r.key for r in keyed.collect()) == list(range(1, 1001))
    more = with_serial(spark.range(10), "key", existing=keyed)
    assert sorted(r.key for r in more.collect()) == list(range(1001, 1011))


def test_running_total_with_a_key_over_many_chunks(spark):
    data, df = skewed(spark, 2000)
    out = ordering.running_total(df.repartition(6), ["k"], ["v", "i"], "i", "total")
    seen = {}
    expected = {}
    for k, v, i in sorted(data, key=lambda r: (r[0] is not None, r[0], r[1], r[2])):
        seen[k] = seen.get(k, 0) + i
        expected[i] = seen[k]
    assert {r.i: r.total for r in out.collect()} == expected


def test_running_total_over_equal_rows(spark):
    """Half of the rows are the same; their totals must still be spread over chunks and add up."""
    copies = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("o"), F.lit(1).alias("v"))
    out = ordering.running_total(copies.withColumn("k", F.lit("a")), ["k"], ["o"], "v", "total", unique_order=False)
    assert out.columns == ["o", "v", "k", "total"]
    assert sorted(r.total for r in out.collect()) == list(range(1, 3001))
    assert out.where("o = 0").agg(F.max("total")).first()[0] == 1500


def test_lookup_null_and_unmatched(spark, rows):
    staging = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (2, "a")], "id int, name string")
    dim = spark.createDataFrame([(1, "a", 10), (2, "a", 20), (None, "a", 30)], "pid int, pname string, key int")
    expected = [(None, "a", None), (1, "a", 10), (1, "b", None), (2, "a", 20)]
    on = {"id": "pid", "name": "pname"}
    assert rows(lookup.lookup_key(staging, dim, "key", on)) == expected
    assert rows(lookup.lookup_key(staging, dim, "key", on, hot_rows=2)) == expected
    assert rows(lookup.lookup_key(staging.withColumn("key", F.lit(None).cast("int")), dim, "key", on)) == expected


def test_a_hot_key_is_split_at_run_time(spark, plan, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k")
    spark.range(0, 200_000, 1, 8).select(hot, F.xxhash64("id").alias("filler")).write.parquet(f"{tmp_path}/rows")
    spark.range(200_000).selectExpr("id AS dk", "id * 2 AS key").write.parquet(f"{tmp_path}/dim")
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        keyed = lookup.lookup_key(spark.read.parquet(f"{tmp_path}/rows"), spark.read.parquet(f"{tmp_path}/dim"), "key", {"k": "dk"})
        sums = keyed.agg(F.sum("key").alias("s"), F.count("key").alias("n"), F.max("filler"))
        got = sums.collect()[0]
        assert got.n == 200_000 and got.s == sum(14 if i % 3 == 0 else 2 * i for i in range(200_000))
        assert "skew=true" in plan(sums)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_push_key(spark, rows):
    dim = spark.createDataFrame([("r1", 1), ("r2", 2), ("r3", 3)], "rid string, pk int")
    source = spark.createDataFrame([("r1", 9, 2), ("r1", 8, 1), ("r2", None, 1)], "review string, pk int, n int")
    out = lookup.push_key(dim, source, "pk", {"rid": "review"}, ["n"])
    assert rows(out, "rid", "pk") == [("r1", 8), ("r2", None), ("r3", 3)]
    with pytest.raises(Exception, match="several pk values for r1"):
        lookup.push_key(dim, source, "pk", {"rid": "review"}, ["n"], strict=True).collect()
    same = source.where("n = 1")
    assert rows(lookup.push_key(dim, same, "pk", {"rid": "review"}, ["n"], strict=True), "rid", "pk") == [("r1", 8), ("r2", None), ("r3", 3)]


def test_bridges_leave_out_null_keys(spark, rows):
    staging = spark.createDataFrame([(1, 2), (1, 2), (1, None)], "a int, b int")
    assert rows(lookup.bridge(staging, "a", "b")) == [(1, 2)]
    assert rows(lookup.bridge_null_rows(staging, "a", "b")) == [(1,)]


def test_integrity(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (2, None), (3, 3)], "a int, b int")
    assert rows(integrity.unique_violations(df, ["a", "b"])) == [(1, 1, 2)]
    assert rows(integrity.primary_key_violations(df, ["a", "b"])) == [(1, 1, 2), (2, None, 2)]
    dim = spark.createDataFrame([(1,)], "k int")
    assert rows(integrity.foreign_key_violations(df, dim, "b", "k")) == [(3, 3)]
