import pytest

from loomstar.operators import reshape


def lists(spark):
    return spark.createDataFrame(
        [(1, "a,b", "x,y"), (2, None, "z"), (3, None, None), (4, "q", "w")], "id int, a string, b string"
    )


def test_parallel_explode(spark, rows):
    df = reshape.explode_parallel(reshape.split_columns(lists(spark), ["a", "b"]), ["a", "b"])
    assert df.columns == ["id", "a", "b"]
    assert rows(df) == [(1, "a", "x"), (1, "b", "y"), (2, None, "z"), (3, None, None), (4, "q", "w")]


def test_lists_of_unequal_length(spark, rows):
    ragged = reshape.split_columns(spark.createDataFrame([(1, "a,b", "x"), (2, "c", "y"), (3, None, "u,v")], "id int, a string, b string"), ["a", "b"])
    with pytest.raises(Exception, match="list lengths differ in a, b: 2, 1|list lengths differ in a, b: 1, 2"):
        reshape.explode_parallel(ragged, ["a", "b"]).collect()
    padded = reshape.explode_parallel(ragged, ["a", "b"], mode="pad")
    assert rows(padded) == [(1, "a", "x"), (1, "b", None), (2, "c", "y"), (3, None, "u"), (3, None, "v")]
    good, bad = reshape.split_ragged(ragged, ["a", "b"])
    assert rows(good, "id") == [(2,)] and rows(bad, "id") == [(1,), (3,)]
    with pytest.raises(ValueError):
        reshape.explode_parallel(ragged, ["a"], mode="other")


def test_explode_trim_keeps_null_rows(spark, rows):
    df = spark.createDataFrame([(1, "Drama, Crime"), (2, None)], "id int, g string")
    assert rows(reshape.explode_trim(df, "g")) == [(1, "Crime"), (1, "Drama"), (2, None)]


def test_flatten_names_and_nulls(spark, rows):
    kind = "id int, address struct<city: string, geolocation: struct<lat: string, long: string>>"
    df = spark.createDataFrame([(1, ("Kyiv", ("50", "30"))), (2, None)], kind)
    dotted = reshape.flatten_struct(df, "address", ".")
    assert dotted.columns == ["id", "city", "geolocation.lat", "geolocation.long"]
    assert reshape.flatten_struct(df, "address", "_").columns == ["id", "city", "geolocation_lat", "geolocation_long"]
    assert rows(dotted) == [(1, "Kyiv", "50", "30"), (2, None, None, None)]


def test_cart_without_products_is_kept(spark, rows):
    df = spark.createDataFrame([(1, [(7, 2), (8, 1)]), (2, []), (3, None)], "id int, products array<struct<productId: int, quantity: int>>")
    assert rows(reshape.explode_structs(df, "products")) == [(1, 7, 2), (1, 8, 1), (2, None, None), (3, None, None)]


def test_melt_keeps_nulls(spark, rows):
    df = spark.createDataFrame([(1, "a", None)], "id int, s1 string, s2 string")
    assert rows(reshape.melt(df, ["s1", "s2"], "var", "val")) == [(1, "s1", "a"), (1, "s2", None)]
