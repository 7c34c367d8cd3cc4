"""Types that grow with each drop, and a dimension kept by state."""

import datetime as dt

import pytest
from pyspark.sql.types import StructType

from loomstar.plans.warehouse import Warehouse
from loomstar.sources.evolve import ABOVE, GrowingTable, detect, join_types
from loomstar.streaming.upsert import newest_rows, upsert_stream


def test_types_are_a_lattice():
    for a in ABOVE:
        for b in ABOVE:
            top = join_types(a, b)
            assert top == join_types(b, a) and top in ABOVE[a] and top in ABOVE[b] and (a != b or top == a)
            assert all(join_types(top, c) == join_types(a, join_types(b, c)) for c in ABOVE)


def test_detect(spark):
    columns = {
        "a": (["1", " -2 ", None, ""], "bigint"), "b": (["1", "2.5", "1e3", None], "double"), "c": (["true", "FALSE", "", None], "boolean"), "d": (["2024-02-29", None, "", "1999-01-01"], "date"),
        "e": (["2024-01-01 10:00:00", "2024-01-02", None, None], "timestamp"), "f": (["x", "1", None, ""], "string"), "g": ([None, "", " ", None], "void"), "h": (["1", "2024-01-01", None, None], "string"),
        "i": (["99999999999999999999", "1", None, None], "double"), "j": (["2024-13-01", None, None, None], "string"),
    }
    df = spark.createDataFrame(list(zip(*[v for v, _ in columns.values()])), ", ".join(f"{c} string" for c in columns))
    assert detect(df) == {c: t for c, (_, t) in columns.items()}
    assert set(detect(df.limit(0)).values()) == {"void"}


def test_drops_widen_the_table(spark, tmp_path):
    drop = lambda schema, *data: spark.createDataFrame(list(data), schema)
    table = GrowingTable(spark, f"{tmp_path}/t")
    with pytest.raises(ValueError, match="no drop"):
        table.read()
    assert table.append(drop("id string, v string", ("1", "5"), ("2", "")), "a") == {"id": "bigint", "v": "bigint"}
    assert table.append(drop("v string, id string, w string", ("2.5", "3", None)), "b") == {"id": "bigint", "v": "double", "w": "void"}
    assert table.append(drop("id string, w string", ("x", "2024-01-01")), "c") == {"id": "string", "v": "double", "w": "date"}
    assert table.append(drop("id string, v string", ("4", "1")), "d") == table.versions()[-1]
    day = dt.date(2024, 1, 1)
    assert {r.id: (r.v, r.w) for r in table.read().collect()} == {"1": (5.0, None), "2": (None, None), "3": (2.5, None), "x": (None, day), "4": (1.0, None)}
    assert len(table.versions()) == 3
    # the same label again replaces its rows; a narrower declaration is refused and changes nothing
    table.append(drop("id string, v string", ("5", "1")), "d")
    assert sorted(r.id for r in table.read().collect()) == ["1", "2", "3", "5", "x"]
    for narrow in ({"id": "bigint", "v": "double", "w": "date"}, {"id": "string", "v": "double"}):
        with pytest.raises(ValueError, match="narrower"):
            table.append(drop("id string", ("9",)), "e", declared=narrow)
    assert table.append(drop("id string, v string, w string", ("6", "1", "soon")), "e", declared={"id": "string", "v": "string", "w": "string"})["w"] == "string"
    assert {r.id: r.v for r in table.read().collect()} == {"1": "5", "2": None, "3": "2.5", "5": "1.0", "x": None, "6": "1"}  # each drop from what it held


def test_stream_upsert_equals_the_batch(spark, tmp_path, rows):
    schema = StructType.fromDDL("k string, member string, v int")
    wh, lake, state = Warehouse(spark, f"{tmp_path}/wh"), f"{tmp_path}/lake", f"{tmp_path}/state"
    full = "k string, member string, v int, at int"
    runs = [
        [("a", "A", 1, 5), ("b", "B", 1, 5), (None, None, 9, 9)],
        [("a", "A", 2, 6), ("b", "B", 0, 4), ("c", "C", None, 1)],
        [("a", "A", 1, 5), ("b", "B", 1, 5), ("c", "C", 3, 1), ("c", "C", 2, 1)],
        [],
    ]
    written = []
    for run in runs:
        if run:
            spark.createDataFrame(run, full).coalesce(1).write.mode("append").parquet(lake)
        upsert_stream(spark.readStream.schema(full).parquet(lake), wh, "dim", schema, ["at"], state)
        written.append([rows(wh.day("dim", schema, d)) for d in wh.versions("dim")])
    batch = newest_rows(spark.createDataFrame(sum(runs, []), full), "member", ["at"]).select("k", "member", "v")
    assert rows(wh.snapshot("dim", schema)) == rows(batch) == [("a", "A", 2), ("b", "B", 1), ("c", "C", 3)]
    # only changes are written, and a run without new files writes nothing
    assert written[-1] == written[-2] == [[("a", "A", 1), ("b", "B", 1)], [("a", "A", 2), ("c", "C", None)], [("c", "C", 3)]]
