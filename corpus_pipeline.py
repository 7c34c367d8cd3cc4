"""From a table of documents to packed token sequences: each stage reads what the one before it kept.

Every stage decides by row: ids may repeat or be null. Texts of any length are read whole, an empty table gives no rows, and
columns beside those of documents stay as they are, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomstar.llm import decontaminate, exact_dedup, langid, near_dup, packing
from loomstar.session import stored, tune


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence. Null, empty and letterless texts go; equal rows fare alike."""
    return langid.keep_known(docs)


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space runs counting as one space: the one with the smallest id, then the first by place."""
    return exact_dedup.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): the one with the smallest id, then the first by place. Texts without a word all stay."""
    return near_dup.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with the benchmark; one that is a passage as a whole goes. Texts without a passage, nulls among them, stay."""
    return decontaminate.remove_benchmark(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, with their ids; a null or empty text is its end id alone."""
    made = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return made.select(F.col("id").alias("doc_id"), "start", F.col("size").alias("length"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_exact_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Trained models, hashing and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    tune(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
