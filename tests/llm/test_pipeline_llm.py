"""The pipeline's stages against brute force, each on its own input."""

import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
import cases  # noqa: E402

import corpus_pipeline  # noqa: E402
from payledger.llm import common, language_id, secret_scan  # noqa: E402

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple((x is None, x) for x in r) for r in df.collect()))


def check(spark, docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, docs, SF), "stage")
        texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if name != "mix_sources":
            assert out.columns == docs.columns
        if name == "language_id":
            bad = {(r["doc_id"], r["th"]) for r in language_id.predict(docs).where("rejected").collect()}
            expected = docs.withColumn("th", F.xxhash64("text")).collect()
            assert out.count() == sum((r["doc_id"], r["th"]) not in bad for r in expected)
        elif name == "near_duplicates":
            expected = [t for t, b in zip(texts, brute.near(texts, width=5)) if b[0] == b[2]]
            assert rows(out.select("doc_id", "text")) == sorted(tuple((x is None, x) for x in t) for t in expected)
        elif name == "decontaminate":
            expected = [t for t, b in zip(texts, brute.contaminated(texts, items)) if not b[5]]
            assert rows(out.select("doc_id", "text")) == sorted(tuple((x is None, x) for x in t) for t in expected)
        elif name == "secrets":
            expected = [(d, secret_scan.masked(t)) for d, t in texts]
            assert rows(out.select("doc_id", "text")) == sorted(tuple((x is None, x) for x in t) for t in expected)
        else:
            sized, target = brute.targets([(r["doc_id"], r["source"], r["text"]) for r in docs.collect()])
            got = out.collect()
            assert len(got) == len(texts)
            for s in sized:
                assert abs(sum(r["taken"] for r in got if r["source"] == s) - target[s]) <= 1
        docs = out


def test_stages_on_tables(spark):
    check(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_stages_on_odd_rows(spark):
    check(spark, spark.createDataFrame(cases.odd_documents(), cases.DOC_SCHEMA))


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], cases.DOC_SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF), "stage")
    assert docs.count() == 0


def test_registration():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and len([n for n in names if n.startswith("op")]) == 13
    assert set(entry.oracle_sql()) <= set(names)


def test_sql_agrees(spark):
    import duckdb

    import __spark_entry__ as entry
    from payledger.llm import queries

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        expected = con.sql(sql)
        got = entry.queries()[name](spark, SF).select(*expected.columns).collect()
        assert sorted(map(tuple, got)) == sorted(expected.fetchall())
