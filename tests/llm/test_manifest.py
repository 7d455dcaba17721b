"""The Merkle manifest against brute force and its SQL."""

import os
import sys

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
import cases  # noqa: E402

from payledger.llm import merkle_manifest as M  # noqa: E402
from payledger.llm.queries import OP13_SQL  # noqa: E402

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def key(row):
    return tuple((x is None, x) for x in row)


def sized(spark):
    """Sources of 1, 15, 16, 17, 257 and 300 documents, and 20 more of one each."""
    rows = []
    for name, n in (("a", 1), ("b", 15), ("c", 16), (None, 17), ("é", 257), ("Z", 300), *((f"one{i}", 1) for i in range(20))):
        rows += [(len(rows) + i, f"Text {i}", "en", name, i) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module", params=["odd", "sized", "sf0.001"])
def docs(request, spark):
    if request.param == "odd":
        return spark.createDataFrame(cases.odd_documents(), cases.DOC_SCHEMA)
    return sized(spark) if request.param == "sized" else spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_manifest(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    want = sorted(brute.manifest(rows), key=key)
    got = M.verify(M.manifest(docs)).collect()
    assert list(got[0].asDict()) == COLUMNS
    assert sorted(map(tuple, got), key=key) == want
    with duckdb.connect() as con:
        con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64", "n_chars": "Int64"}))
        assert sorted(con.sql(OP13_SQL).fetchall(), key=key) == want


def test_proofs_find_an_altered_document(spark):
    """A stored proof verifies its document only; an altered one folds to another root."""
    proofs = M.manifest(sized(spark)).cache()
    assert proofs.select("root").distinct().count() == 1
    swapped = proofs.withColumn("changed", F.sha2(F.col("leaf").cast("binary"), 256))
    assert M.verify(swapped).where("verified").count() == 0
    assert M.verify(proofs.withColumn("changed", F.lit(None).cast("string"))).where("not verified").count() == 0


def test_repeated_rows_spread_and_partitions_do_not_matter(spark):
    copies = spark.createDataFrame([(7, "Same", "en", "s", 4)] * 600, "doc_id long, text string, lang string, source string, n_chars long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = M.ranged(copies, ["source", "doc_id"], "copies")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranged.groupBy("part").count().agg(F.max("count")).first()[0] <= 300
    one, many = (sorted(map(tuple, M.verify(M.manifest(copies.repartition(n))).collect()), key=key) for n in (1, 5))
    assert one == many == sorted(brute.manifest([(7, "Same", "en", "s", 4)] * 600), key=key)


def test_empty(spark):
    none = spark.createDataFrame([], cases.DOC_SCHEMA)
    assert M.verify(M.manifest(none)).count() == 0
