"""Contents against each other by brute force, and discovered keys and lists."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from loomstar.operators import discover, reconcile


def kinds(left, right):
    a, b = Counter(left), Counter(right)
    out = {}
    for key in {r[0] for r in left + right}:
        mine, theirs = [Counter({r: n for r, n in c.items() if r[0] == key}) for c in (a, b)]
        if mine != theirs:
            m, t = sum(mine.values()), sum(theirs.values())
            out[key] = (m, t, "missing" if not t else "extra" if not m else "count" if m != t else "changed")
    return out


@pytest.mark.parametrize("ranges", [1, 3, reconcile.RANGES])
def test_against_counted_rows(spark, ranges):
    rng = random.Random(ranges)
    value = lambda: (rng.choice([None, *range(8)]), rng.choice([None, "", "a", "b"]), rng.choice([None, 0.5]))
    left = [value() for _ in range(60)]
    right = rng.sample(left, 55) + [value() for _ in range(3)] + left[:2]
    schema = "k int, t string, v double"
    found = reconcile.differences(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], ranges=ranges)
    assert {r.k: (r.left_rows, r.right_rows, r.kind) for r in found.collect()} == kinds(left, right)


def test_counts_agree_and_contents_do_not(spark, rows):
    schema = "k int, v string, n array<int>, `_rows` int"
    left = spark.createDataFrame([(1, "a", [1], 1), (1, "a", [1], 1), (2, "b", [None, 1], 1), (3, None, None, 1), (4, "", [], 1)], schema)
    right = spark.createDataFrame([(1, "a", [1], 1), (1, "b", [1], 1), (2, "b", [1, None], 1), (3, "", None, 1), (4, "", [], 1)], schema)
    assert rows(reconcile.differences(left, right, ["k"], ["k", "v", "n"]), "k", "kind") == [(1, "changed"), (2, "changed"), (3, "changed")]
    assert reconcile.differences(left, left.repartition(3), ["k"]).count() == 0
    audit = reconcile.content_audit(left, right, ["k"], "t", ["k", "v"]).first()
    assert tuple(audit) == ("t", 5, 5, 2, "FAIL") and reconcile.content_audit(left.limit(0), right.limit(0), ["k"], "t").first().status == "PASS"


def test_a_fingerprint_reads_its_columns_once(spark, tmp_path, plan):
    spark.range(1000).select("id", (F.col("id") * 2).alias("v"), F.lit("x").alias("wide")).write.parquet(f"{tmp_path}/t")
    text = plan(reconcile.fingerprint(spark.read.parquet(f"{tmp_path}/t"), ["id"], ["id", "v"]))
    assert text.count("FileScan") == 1 and "wide" not in text and "partial_sum" in text


def test_unique_sets_against_every_set(spark):
    rng = random.Random(8)
    for _ in range(6):
        data = [(rng.choice([None, 1, 2]), rng.randrange(4), rng.choice("ab"), i // 2) for i in range(rng.choice([0, 1, 6, 14]))]
        names, found = ["a", "b.c", "d", "e"], []
        for size in (1, 2, 3):
            for s in combinations(range(4), size):
                if not any(set(u) <= set(s) for u in found) and len({tuple(r[i] for i in s) for r in data}) == len(data):
                    found.append(s)
        df = spark.createDataFrame(data, "a int, `b.c` int, d string, e int")
        assert discover.unique_sets(df) == [tuple(names[i] for i in s) for s in found]


def test_list_groups(spark):
    df = spark.createDataFrame([("1,2", "a,b", "x", "p,q"), (None, "", "y", "r"), ("3", "c", "z,z", None)], "a string, b string, c string, d string")
    assert discover.list_groups(df, ["a", "b", "c", "d"]) == [["a", "b", "d"], ["c"]]
    assert discover.list_groups(df, ["a"]) == [["a"]] and discover.list_groups(df.limit(0), ["a", "c"]) == [["a", "c"]]
    arrays = df.select(F.split("a", ",").alias("a"), F.split("c", ",").alias("c"))
    assert discover.list_groups(arrays, ["a", "c"], sep=None) == [["a"], ["c"]]


def test_sets_that_are_not_unique_are_not_grouped_in_full(spark, monkeypatch):
    whole, refuted = [], discover._refuted

    def seen(rows, sets, slices=1):
        whole.extend(sets if slices == 1 else ())
        return refuted(rows, sets, slices)

    monkeypatch.setattr(discover, "_refuted", seen)
    df = spark.range(20000).selectExpr("id", "id - if(id % 20 = 0, 1, 0) AS nearly")
    assert discover.unique_sets(df, most=2) == [("id",)]
    assert whole == [("id",)]
