"""Every registered query beside its SQL on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry
from catalog.registry import QUERIES, SQL
from tools.compare import SAME_TYPE, sorted_rows, sql_rows, table_connection

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    return table_connection(SF)


def pairs_everything(text):
    return "CartesianProduct" in text or "BroadcastNestedLoopJoin" in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, plan, name):
    df = QUERIES[name](spark, SF)
    assert not pairs_everything(plan(df))
    mine = [tuple(r) for r in df.collect()]
    if name in SQL:
        names, theirs, types = sql_rows(con, SQL[name])
        assert {n: SAME_TYPE.get(t, t) for n, t in df.dtypes} == dict(zip(names, types))
        assert sorted_rows(df.columns, mine) == sorted_rows(names, theirs)


def test_entry(spark):
    assert entry(spark).count() > 0
