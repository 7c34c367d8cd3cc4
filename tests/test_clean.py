import pytest
from pyspark.sql import functions as F

from loomstar.functions import clean
from loomstar.functions.keys import hash_key
from loomstar.operators import conform

TEXTS = ["o'neil-smith", "mCaDAM x", "straße", "ßa", "élan vital", "x1y a_b", "", " lead", "ÀÉ", "don't-STOP", "a\tb\nc"]


def apply(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.select("i", column.alias("o")).orderBy("i").select("o").collect()]


def test_title_case_and_capitalize_agree_with_python(spark):
    assert apply(spark, TEXTS, clean.title_case("c")) == [t.title() for t in TEXTS]
    assert apply(spark, TEXTS, clean.capitalize("c")) == [t.capitalize() for t in TEXTS]


def test_strip_removes_every_kind_of_blank(spark):
    texts = [" a ", "\tb\n", " c　", "d e", None]
    assert apply(spark, texts, clean.strip("c")) == ["a", "b", "c", "d e", None]


def test_currency(spark):
    assert apply(spark, ["₹1,099", "₹12,34,567.50", None], clean.currency("c")) == [1099.0, 1234567.5, None]
    assert apply(spark, ["free", "₹5"], clean.currency("c", strict=False)) == [None, 5.0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(spark, ["free"], clean.currency("c"))


def test_whole_numbers(spark):
    texts = ["1994", "PG", "8.0", "1e3", "7.5", "5d", "", None, "9007199254740993", "-3"]
    assert apply(spark, texts, clean.to_whole("c")) == [1994, None, 8, 1000, None, None, None, None, 9007199254740993, -3]
    assert apply(spark, ["7.5", "5d", "x", "1f"], clean.to_number("c")) == [7.5, None, None, None]


def test_days(spark):
    import datetime as dt

    texts = ["2020-03-02T00:00:00.000Z", "2020-03-02", "2025-02-30", None]
    assert apply(spark, texts, clean.to_day("c", strict=False)) == [dt.date(2020, 3, 2), dt.date(2020, 3, 2), None, None]
    assert apply(spark, ["2020-02-29"], clean.day_after("c")) == [dt.date(2020, 3, 1)]


def test_rounding_is_half_away_from_zero(spark):
    assert apply(spark, ["3.9", "2.5", "-2.5"], clean.round_to_int(F.col("c").cast("double"))) == [4, 3, -3]


def test_pieces_take_any_separator_literally(spark):
    assert apply(spark, ["a.b", "a|b", "a,b,", None], clean.pieces("c", ".")) == [["a", "b"], ["a|b"], ["a,b,"], None]
    assert apply(spark, ["a||b"], clean.pieces("c", "||")) == [["a", "b"]]
    assert apply(spark, ["a,b,", ""], clean.pieces("c")) == [["a", "b", ""], [""]]


def test_coercion_fills_and_reports(spark, rows):
    schema = {"year": "bigint", "score": "double", "title": "string", "seen": "date"}
    raw = spark.createDataFrame(
        [("PG", "8.1", "A", "2025-02-30"), ("1994", "bad", None, "2024-01-31"), (None, None, "B", None)],
        "year string, score string, title string, seen string",
    )
    assert rows(conform.misfits(raw, schema)) == [("score", 1), ("seen", 1), ("title", 0), ("year", 1)]
    filled = conform.fill_by_type(conform.coerce(raw, schema).withColumn("ok", F.lit(None).cast("boolean")))
    assert rows(filled, "year", "score", "title", "ok") == [(0, 0.0, "B", False), (0, 8.1, "A", False), (1994, 0.0, "NA", False)]


def test_date_rules(spark, rows):
    raw = spark.createDataFrame(
        [("2025-02-30", "2025-03-01"), ("2024-01-05", "2024-01-01"), ("1990-01-01", "1990-01-01"), (None, None)], "s string, e string"
    )
    out = conform.date_rules(raw, {"s": ("2000-01-01", "2030-01-01")}, {"end_after_start": ("s", "e")})
    assert rows(out) == [("end_after_start", 1), ("s_in_range", 1), ("s_valid", 1)]


def test_hash_key_keeps_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("", "a")], "x string, y string")
    assert df.select(hash_key("t", "x", "y").alias("k")).distinct().count() == 3
