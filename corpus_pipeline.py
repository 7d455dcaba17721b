"""A corpus pipeline of five stages over ``documents``.

language ID -> near-duplicates -> decontamination -> secrets -> mixing. Every
stage takes (spark, docs, sf_dir) and works on all that its predecessor kept:

- ``language_id`` drops the documents that the classifier rejects;
- ``near_duplicates`` keeps one document of each group (shingles of five words);
- ``decontaminate`` drops the documents that hold a window of the benchmark;
- ``secrets`` masks secrets in the texts;
- ``mix_sources`` returns, per document, the words that the mix takes.

All but the last return the columns of ``documents``. Nulls, empty texts,
repeated rows and extra columns follow the operators' docstrings; a row repeated
with the same id and text is one document and stays as often as it came.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from payledger.llm import decontaminate, language_id, minhash_dedup, mixing, secret_scan
from payledger.session import checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.keep_one(docs, width=5)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminated),
    ("secrets", without_secrets),
    ("mix_sources", mix_sources),
]

#: SQL cannot express the centroids of the first stage; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet to the
    shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
