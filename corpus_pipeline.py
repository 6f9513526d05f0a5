"""Corpus pipeline: language ID, one document of each group of near copies, repeated passages out,
benchmark out, packing.  Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ontime.llm import queries
from ontime.session import shared_dir

STAGES = [
    ("language_id", queries.identified_documents),
    ("ngram_join", queries.one_of_each_group),
    ("substring_dedup", queries.without_repeated_passages),
    ("decontamination", queries.without_benchmark),
    ("packing", queries.packed),
]

#: Learned models and tokenizer ids are beyond SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
