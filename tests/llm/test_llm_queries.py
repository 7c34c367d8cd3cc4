"""The registered queries on the smallest tables: beside their SQL, and held-out accuracy of the classifiers."""

from pathlib import Path

import pytest

import corpus_pipeline
from loomstar.llm.queries import QUERIES, SQL
from tools.compare import SAME_TYPE, sorted_rows, sql_rows, table_connection

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")


@pytest.mark.parametrize("name", sorted(SQL))
def test_beside_sql(spark, name):
    df = QUERIES[name](spark, SF)
    names, theirs, types = sql_rows(table_connection(SF), SQL[name])
    assert {n: SAME_TYPE[t] for n, t in df.dtypes} == dict(zip(names, types))
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == sorted_rows(names, theirs)


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    lang = QUERIES["op2_language_id"](spark, SF).where("held_out").join(docs, "doc_id").toPandas()
    assert (lang["lang"] == lang["lang_pred"]).mean() > 0.97
    good = QUERIES["op4_quality"](spark, SF).where("held_out").join(labels, "doc_id").toPandas()
    assert (good["predicted"] == good["quality"]).mean() > 0.95
    bad = QUERIES["op5_toxicity"](spark, SF).where("held_out").join(labels, "doc_id").toPandas()
    hit = bad[bad["predicted"] == 1]
    assert bad[bad["toxic"] == 1]["predicted"].mean() >= 0.6 and (not len(hit) or hit["toxic"].mean() >= 0.8)


def test_lm_score_tells_good_from_bad(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    mean = {r.quality: r.s for r in QUERIES["op3_lm_score"](spark, SF).join(labels, "doc_id").groupBy("quality").agg({"score": "avg"}).toDF("quality", "s").collect()}
    assert mean[1] < mean[0]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, n = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, SF).collect(), docs.schema)
        assert kept.columns == docs.columns
        n.append(kept.count())
    assert n[0] - n[1] < 0.01 * n[0] and n[1] > n[2] > n[3] >= n[4] > 0
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == n[4]
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` <> 4096").count() <= 1
