"""End-to-end: driver contract, oracle agreement at sf0.001, plan shape."""

import collections
import contextlib
import io
import os
import re
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from payledger.operators.describe import attach_descriptions
from payledger.plans.model import LedgerModel
from payledger.plans.payables import OUTPUT_COLUMNS
from payledger.sources.holidays import load_counts, load_holiday_csv, write_holiday_csv

# the training-data queries have their own tests
OTHER = set(E.LLM.queries()) if E.LLM else set()
ORACLE = {name: sql for name, sql in E.oracle_sql().items() if name not in OTHER}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["nation", "customer", "supplier", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _bag(rows, idx=None):
    return collections.Counter(
        tuple(None if v is None else str(v) for v in (r if idx is None else [r[i] for i in idx])) for r in rows
    )


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(res.columns)
    idx = [res.columns.index(c) for c in df.columns]
    assert _bag(df.collect()) == _bag(res.fetchall(), idx)


def test_every_query_has_an_oracle():
    assert set(E.queries()) - OTHER == set(ORACLE)


def test_entry_flagship_schema(spark):
    df = E.entry(spark)
    assert df.columns == OUTPUT_COLUMNS and len(OUTPUT_COLUMNS) == 83
    assert df.count() > 0


def test_flagship_plan_shape(spark, erp, cfg):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        LedgerModel(spark, erp, cfg).accounts_payable.explain()
    plan = buf.getvalue()
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastHashJoin" in plan
    assert "PushedFilters: [IsNotNull(o_orderkey)" in plan


def test_descriptions_attached(spark, erp, cfg):
    ap = LedgerModel(spark, erp, cfg).accounts_payable
    described, missing = attach_descriptions(ap, [{"name": "NAME1", "description": "Vendor name"},
                                                  {"name": "NAME1", "description": "second entry ignored"}])
    meta = {f.name: f.metadata.get("comment") for f in described.schema.fields}
    assert meta["NAME1"] == "Vendor name" and meta["IsLegal"] == "IsLegal"
    assert "NAME1" not in missing and "IsLegal" in missing


def test_holiday_csv_roundtrip_dedupes(spark):
    folder = tempfile.mkdtemp(prefix="hol-")
    df = spark.createDataFrame([("2001-01-01",), ("2001-04-21",)], "d string").selectExpr(
        "to_date(d) AS HolidayDate")
    write_holiday_csv(df, folder)
    write_holiday_csv(df, folder)  # loads append
    loaded, count = load_holiday_csv(spark, folder)
    assert count == 2 and os.path.isdir(folder)
    assert load_counts(spark, folder) == {"read": 4, "unreadable": 0, "kept": 2, "duplicate": 2}


def test_bucketed_staging_removes_header_line_shuffle(spark, erp, cfg):
    from payledger.sources.erp import stage_tables
    from payledger.sources.fixtures import ERP_TABLES

    spark.sql("CREATE DATABASE IF NOT EXISTS ledger_plan_test")
    res = stage_tables(erp, tempfile.mkdtemp(prefix="erp-"), buckets=4, database="ledger_plan_test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = LedgerModel(spark, res.tables(spark, ERP_TABLES), cfg)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            m.accounting_documents.select("AccountingDocumentNumber_BELNR", "AmountInLocalCurrency_DMBTR").explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert not any("belnr" in line for line in exchanges), exchanges
        assert "PushedFilters" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _physical(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().splitlines()


def test_flagship_joins_and_exchanges(spark, erp, cfg):
    """The static plan over staged tables: every lookup is a broadcast of its
    measured size, the invoice lines are merged once, and the shuffles left are
    those of the two fact-to-fact joins and of the parked rank."""
    from payledger.sources.erp import stage_tables
    from payledger.sources.fixtures import ERP_TABLES

    spark.sql("CREATE DATABASE IF NOT EXISTS ledger_shape_test")
    res = stage_tables(erp, tempfile.mkdtemp(prefix="erp-"), buckets=4, database="ledger_shape_test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        model = LedgerModel(spark, res.tables(spark, ERP_TABLES), cfg)
        plan = _physical(model.accounts_payable)
        merges = [x for x in plan if "SortMergeJoin" in x]
        exchanges = [x for x in plan if "Exchange hashpartitioning" in x]
        assert len(merges) <= 8 and len(exchanges) <= 9, (merges, exchanges)
        assert not any("FullOuter" in x for x in merges)  # merged in the stored lines, once
        assert sum("FullOuter" in x for x in _physical(model.invoices)) == 1
        # no lookup key is a shuffle key
        lookups = ("__f_periv", "__v_lifnr", "__kf_", "__vc_id", "__r_fcurr", "__c_bukrs", "__bd_date", "__fix")
        assert not [x for x in merges + exchanges if any(k in x for k in lookups)]
        # header joins of the shared lines read buckets: no exchange on the invoice key alone
        assert not [x for x in exchanges if "hashpartitioning(mandt" in x and "belnr" in x and "gjahr" in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_fact_reads_the_stored_invoice_flow_and_sorts_by_documents(spark, erp, cfg):
    """Headers are joined to the invoice lines before these are stored, not again in either
    branch, and every sort-merge join leads with a document number: rows sorted by a company
    first (five of them here) would all be compared field by field."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _physical(LedgerModel(spark, erp, cfg).accounts_payable)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    leading = [m.group(1) for x in plan if (m := re.search(r"SortMergeJoin \[.*?\], \[(\w+)#", x))]
    assert sorted(k for k in leading if k != "o_orderkey") == ["__i_belnr", "__p_ebeln", "belnr"], leading


def test_currency_values_replace_joins_and_change_nothing(spark, erp, cfg):
    import dataclasses

    values = LedgerModel(spark, erp, cfg)
    joined = LedgerModel(spark, erp, dataclasses.replace(cfg, currency_values=0))
    for name, roles in (("accounting_documents", 5), ("invoices", 1), ("purchase_history", 1)):
        plain, by_join = getattr(values, name), getattr(joined, name)
        joins = [sum("Join" in x.split("(")[0] for x in _physical(df)) for df in (plain, by_join)]
        assert joins[1] - joins[0] >= roles, (name, joins)
        assert plain.schema == by_join.schema and plain.count() == by_join.count() > 0
        assert plain.exceptAll(by_join).count() == 0 and by_join.exceptAll(plain).count() == 0


def test_materialized_dimension_is_as_large_as_its_rows(spark):
    """A dimension that a join made: the planner's bound for the join is a product
    of its sides, the stored leaf's bound its own bytes, and no less than the data
    where few distinct values would compress away."""
    from payledger.operators.joins import is_small, materialize

    left = spark.range(20_000).select((F.col("id") % 50).alias("k"), F.lit("one value of forty characters, repeated").alias("v"))
    joined = left.join(spark.range(50).select(F.col("id").alias("k"), F.lit("x").alias("w")), "k").where("k < 500")
    assert not is_small(joined, 100 << 20)
    leaf = materialize(joined)
    assert is_small(leaf, 4 << 20) and not is_small(leaf, 20_000 * 40)


def test_shared_invoice_lines_change_nothing(spark, erp, cfg):
    import dataclasses

    shared = LedgerModel(spark, erp, cfg).accounts_payable
    apart = LedgerModel(spark, erp, dataclasses.replace(cfg, share_invoice_lines=False, materialize_dimensions=False)).accounts_payable
    assert shared.count() == apart.count() > 0
    assert shared.exceptAll(apart).count() == 0 and apart.exceptAll(shared).count() == 0


def test_stored_fact_is_the_single_plan_and_shuffles_for_one_join(spark, erp, cfg):
    """A large fact is stored between its joins: the same rows, for all columns and for some;
    what is left to run shuffles for the PO history only, and not the rows without a PO."""
    import dataclasses

    plain = LedgerModel(spark, erp, cfg).accounts_payable
    model = LedgerModel(spark, erp, dataclasses.replace(cfg, store_fact_bytes=0))
    some = ["AccountingDocumentNumber_BELNR", "NAME1", "PotentialPenaltyInTargetCurrency", "AmountOfReturnInLocalCurrency",
            "InvoiceDocumenttype_BLART", "KeyFiscPeriod"]
    for got, want in ((model.payables(some), plain.select(*some)), (model.accounts_payable, plain)):
        assert got.schema.simpleString() == want.schema.simpleString() and got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    narrow, whole = model._stored_rows.values()
    assert "TermsOfPaymentKey_ZTERM" in whole.columns and "TermsOfPaymentKey_ZTERM" not in narrow.columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _physical(model.payables())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    leading = [m.group(1) for x in plan if (m := re.search(r"SortMergeJoin \[(\w+)#", x))]
    assert sorted(leading) == ["PurchasingDocumentNumber_EBELN", "l_orderkey"], leading
    assert not any("Window" in x for x in plan)


def test_stored_fact_with_hot_keys_and_stored_documents(spark, erp, cfg):
    import dataclasses

    plain = LedgerModel(spark, erp, cfg)
    stored = {"accounting_documents": plain.accounting_documents, "invoices": plain.invoices}
    for changes, given in (({"hot_key_share": 0.0002}, None), ({}, stored)):
        got = LedgerModel(spark, erp, dataclasses.replace(cfg, store_fact_bytes=0, **changes), given).accounts_payable
        assert got.exceptAll(plain.accounts_payable).count() == 0 and plain.accounts_payable.exceptAll(got).count() == 0


def test_written_frame_leaves_no_shuffle_files(spark):
    """The shuffle files of a stored frame go when it is written, the frame of a block at its end."""
    import time

    from payledger.operators.joins import write_once, written

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}

    before = shuffled()
    df = spark.range(10_000).repartition(4, "id")
    leaf = write_once(df, "test")
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left and leaf.count() == 10_000, left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    with written(df, "test") as leaf:
        folder = leaf.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")
        assert leaf.count() == 10_000 and os.path.isdir(folder)
    assert not os.path.exists(folder)
