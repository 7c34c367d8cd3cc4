"""Records over line breaks: many tasks, the same rows as one task, bad records apart."""

import json
import random

import pytest

from loomstar.sources import readers, records

SCHEMA = "id bigint, t string, v double"


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def value(rng):
    return "".join(rng.choice(["a", "b", '"', "\n", ",", " ", "é", "\\", "{", "}", "[", "]", "\r\n", "'", "\n\n", ""]) for _ in range(rng.choice([0, 3, 12, 60])))


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def test_csv(spark, tmp_path, small_splits):
    rng = random.Random(1)
    wanted = []
    for n in range(3):
        lines = ["id,t,v"]
        for i in range(80):
            wanted.append((n * 100 + i, value(rng) + "x", i / 2))
            lines.append(f"{wanted[-1][0]},{quoted(wanted[-1][1])},{wanted[-1][2]}" + ("\n" if i % 17 == 3 else ""))
        (tmp_path / f"{n}.csv").write_text("\n".join(lines) + ("\n" if n else ""), newline="")
    path = str(tmp_path)
    good, bad = records.csv_records(spark, path, SCHEMA)
    assert records._pieces(spark, path, "\n").rdd.getNumPartitions() > 10
    assert ordered(good.collect()) == ordered(wanted) and bad.count() == 0
    assert ordered(readers.read_csv(spark, path, SCHEMA, multiline=True).collect()) == ordered(wanted)


def test_bad_csv_records_are_set_apart(spark, tmp_path, small_splits):
    body = "".join(f'{i},"line\n{i}",1.5\n' for i in range(50))
    (tmp_path / "a.csv").write_text("id,t,v\n" + body + 'x,"two\nlines",2.0\n7,"short\n"\n' + body + '9,"never closed\n1,2,3\n')
    good, bad = records.csv_records(spark, str(tmp_path), SCHEMA)
    assert good.count() == 100
    assert ordered(bad.collect()) == ordered([('x,"two\nlines",2.0',), ('7,"short\n"',), ('9,"never closed\n1,2,3',)])
    with pytest.raises(ValueError, match="does not name"):
        records.csv_records(spark, str(tmp_path), "id bigint, v double, t string")
    with pytest.raises(ValueError, match="does not name"):
        records.csv_records(spark, str(tmp_path), "id bigint, t string")


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays(spark, tmp_path, small_splits, indent):
    rng, wanted = random.Random(2), []
    for n in range(3):
        rows = [{"id": n * 100 + i, "t": value(rng), "v": i / 4, "deep": {"a": [{"b": value(rng)}, {}], "c": {}}} for i in range([0, 1, 60][n])]
        wanted += [(r["id"], r["t"], r["v"], [x.get("b") for x in r["deep"]["a"]]) for r in rows]
        (tmp_path / f"{n}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=n == 1))
    schema = SCHEMA + ", deep struct<a: array<struct<b: string>>, c: struct<d: int>>"
    good, bad = records.json_array_records(spark, str(tmp_path), schema)
    assert bad.collect() == []
    assert ordered((r.id, r.t, r.v, [x.b for x in r.deep.a]) for r in good.collect()) == ordered(wanted)
    one = readers.read_json_array(spark, str(tmp_path), schema)
    assert ordered((r.id, r.t, r.v) for r in one.collect()) == ordered(w[:3] for w in wanted)
    assert records._pieces(spark, str(tmp_path), "}").rdd.getNumPartitions() > 5


def test_bad_json_elements_are_set_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "t": "}{", "v": 1}, {"id": "zz", "t": "x", "v": 2},\n {"id": 3, "t": "\\"]", "v": 3}, {"id": 4, "t')
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text("")
    good, bad = records.json_array_records(spark, str(tmp_path), SCHEMA)
    assert ordered(good.collect()) == [(1, "}{", 1.0), (3, '"]', 3.0)]
    assert ordered(bad.collect()) == ordered([('{"id": "zz", "t": "x", "v": 2}',), ('{"id": 4, "t',)])
