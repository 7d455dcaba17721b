"""Deploy pipeline (sinks, versioned upsert, views) and the streaming holiday feed."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from payledger.plans.calendar import calendar_date_dim
from payledger.plans.model import LedgerModel
from payledger.plans.pipeline import VIEW_NAMES, deploy, latest_version, read_business_days, upsert_table
from payledger.sources.holidays import write_holiday_csv
from payledger.streaming.holiday_feed import start_holiday_feed


def test_deploy_writes_tables_and_registers_views(spark, erp, cfg):
    out_root = tempfile.mkdtemp(prefix="deploy-")
    out = deploy(spark, erp, cfg, out_root)
    assert spark.read.parquet(out["currency_decimal"]).count() == 5
    conv = spark.read.parquet(out["currency_conversion"])
    assert "conv_year" in conv.columns and conv.count() > 0
    for view in VIEW_NAMES.values():
        assert spark.table(view).columns
    ap = spark.table("AccountsPayableGenAI")
    assert ap.schema["NAME1"].metadata.get("comment")
    # a second deploy upserts BusinessDays into a new version with the same rows
    deploy(spark, erp, cfg, out_root, datasets=["VendorConfig"])
    assert latest_version(spark, out["BusinessDays"]) == 1
    assert read_business_days(spark, out["BusinessDays"]).count() == \
        spark.read.parquet(out["BusinessDays"]).where("version = 0").count()


def test_versioned_upsert(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="ups-"), "t")
    upsert_table(spark, root, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"])
    upsert_table(spark, root, spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), ["k"])
    got = sorted(tuple(r) for r in spark.read.parquet(root).where(f"version = {latest_version(spark, root)}")
                 .drop("version").collect())
    assert got == [(1, "a"), (2, "B"), (3, "c")]


def test_streaming_holiday_feed_dedupes_across_batches(spark):
    base = tempfile.mkdtemp(prefix="feed-")
    inbox, table, ckpt = (os.path.join(base, x) for x in ("inbox", "table", "ckpt"))
    days = spark.createDataFrame([("2001-01-01",), ("2001-12-25",)], "d string").select(
        F.to_date("d").alias("HolidayDate"))
    write_holiday_csv(days, inbox)
    start_holiday_feed(spark, inbox, table, ckpt).awaitTermination()
    write_holiday_csv(days.union(spark.createDataFrame([("2002-01-01",)], "d string").select(
        F.to_date("d").alias("HolidayDate"))), inbox)
    start_holiday_feed(spark, inbox, table, ckpt).awaitTermination()
    assert sorted(r.HolidayDate.isoformat() for r in spark.read.parquet(table).collect()) == [
        "2001-01-01", "2001-12-25", "2002-01-01"]


def test_calendar_created_once_in_catalog_and_comments(spark, erp, cfg):
    from payledger.operators.describe import comment_table_columns

    out_root = tempfile.mkdtemp(prefix="deploy-db-")
    spark.sql("CREATE DATABASE IF NOT EXISTS ledger_test")
    out = deploy(spark, erp, cfg, out_root, database="ledger_test", datasets=["CompaniesMD"])
    assert spark.catalog.tableExists(out["calendar_date_dim"])
    deploy(spark, erp, cfg, out_root, database="ledger_test", datasets=["CompaniesMD"])  # second run keeps the table
    missing = comment_table_columns(spark, out["calendar_date_dim"], [{"name": "Date", "description": "Day"}])
    assert "CalYear" in missing and "Date" not in missing
    comments = {c.name: c.description for c in spark.catalog.listColumns(out["calendar_date_dim"])}
    assert comments["Date"] == "Day" and comments["CalYear"] == "CalYear"


def test_passthrough_keeps_unnamed_fields(spark, erp, cfg):
    from payledger.plans.currency import currency_decimal
    from payledger.plans.documents import accounting_documents
    from payledger.plans.masterdata import companies_md, customers_md, vendors_md

    assert "ZZ" not in companies_md(erp, passthrough=True).columns
    vend = vendors_md(erp, passthrough=True).columns
    assert len(vend) == len(set(c.lower() for c in vend))
    cust = customers_md(erp, cfg, passthrough=True)
    assert cust.count() == customers_md(erp, cfg).count()
    # a replicated field without a business name keeps its code
    tables = dict(erp, bseg=erp["bseg"].withColumn("xblnr", F.lit("REF")))
    ad = accounting_documents(tables, currency_decimal(erp), None, cfg, passthrough=True)
    assert "XBLNR" in ad.columns and "XBLNR" not in accounting_documents(tables, currency_decimal(erp), None, cfg).columns
    assert len(ad.columns) == len({c.lower() for c in ad.columns})
    assert ad.where("XBLNR = 'REF'").count() == erp["bseg"].count()


def test_invoice_passthrough(spark, erp, cfg):
    from payledger.plans.currency import currency_decimal
    from payledger.plans.documents import invoice_documents_flow

    tables = dict(erp, rseg=erp["rseg"].withColumn("matnr", F.lit("M1")),
                  rbco=erp["rbco"].withColumn("matnr", F.lit("M2")).withColumn("kostl", F.lit("CC")),
                  rbkp=erp["rbkp"].withColumn("usnam", F.lit("USER")))
    flow = invoice_documents_flow(tables, currency_decimal(erp), None, cfg, passthrough=True)
    base = invoice_documents_flow(tables, currency_decimal(erp), None, cfg)
    assert {"MATNR", "KOSTL", "USNAM"} <= set(flow.columns) and "MATNR" not in base.columns
    assert flow.count() == base.count()
    # a field of both tables takes the line value where the line exists
    assert flow.where("MATNR = 'M2'").count() == flow.where("InvoiceAmountinDocumentCurrencyofSupplierInvoice_RBWWR IS NULL").count()


def test_command_line_deploy(spark, erp, cfg):
    from payledger.__main__ import main
    from payledger.sources.erp import stage_tables

    root = tempfile.mkdtemp(prefix="erp-cli-")
    stage_tables(erp, root)
    out = main(["deploy", "--root", root, "--out", tempfile.mkdtemp(prefix="cli-out-"), "--as-of", "2001-06-30",
                "--calendar-start", "1994-12-01", "--calendar-end", "2002-12-31"], spark=spark)
    fresh = spark.newSession()  # the outputs outlive the session that wrote them
    stored = fresh.read.parquet(out["AccountsPayableGenAI"])
    assert stored.count() == LedgerModel(spark, erp, cfg).accounts_payable.count() > 0
    assert len(stored.columns) == 83 and os.path.isdir(out["currency_conversion"])


def test_holiday_csv_reaches_the_business_days_and_catalog_tables_stay(spark, erp, cfg):
    """One command: CSV to holiday table to business days to datasets, as catalog
    tables with comments that a new session reads; a corrected calendar counts."""
    import datetime as dt

    from payledger.__main__ import main
    from payledger.sources.erp import stage_tables

    root, folder, result = (tempfile.mkdtemp(prefix=p) for p in ("erp-csv-", "csv-", "out-csv-"))
    stage_tables({k: v for k, v in erp.items() if k != "febraban_holiday"}, root)
    with open(f"{folder}/a.csv", "w") as f:
        f.write("HolidayDate;Name\n03/01/1996;Odd Wednesday\n03/01/1996;again\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS ledger_csv")
    corrected = calendar_date_dim(spark, cfg.calendar_start, cfg.calendar_end).withColumn("CalWeek", F.lit(99).cast("long"))
    spark.sql("DROP TABLE IF EXISTS ledger_csv.calendar_date_dim")
    corrected.write.option("path", f"{result}/calendar_date_dim").saveAsTable("ledger_csv.calendar_date_dim")
    args = ["deploy", "--root", root, "--out", result, "--as-of", "2001-06-30", "--calendar-start", "1994-12-01",
            "--calendar-end", "2002-12-31", "--holiday-csv", folder, "--target-database", "ledger_csv"]
    out = main(args, spark=spark)
    fresh = spark.newSession()
    assert [r[0] for r in fresh.table("ledger_csv.FebrabanHoliday").collect()] == [dt.date(1996, 1, 3)]
    days = {r["date"]: r for r in fresh.table("ledger_csv.BusinessDays").where("date BETWEEN '1996-01-01' AND '1996-01-04'").collect()}
    assert days[dt.date(1996, 1, 1)]["is_business_day"] and not days[dt.date(1996, 1, 3)]["is_business_day"]
    assert days[dt.date(1996, 1, 2)]["next_business_day"] == dt.date(1996, 1, 4)
    for view in VIEW_NAMES.values():
        assert fresh.table(out[view]).columns
    weeks = fresh.table(out["AccountingDocuments"]).select("WeekOfPostingDateInTheDocument_BUDAT").distinct().collect()
    assert [r[0] for r in weeks] == [99]
    comments = {c.name: c.description for c in fresh.catalog.listColumns(out["AccountsPayableGenAI"])}
    assert comments["NAME1"] and out["missing_descriptions"] == ""
    clients = [r[0] for r in fresh.table(out["CustomersMD"]).select("Client_MANDT").collect()]
    assert clients == sorted(clients)


def test_today_is_fixed_when_the_model_is_made(spark, erp, cfg):
    import dataclasses
    import datetime as dt

    model = LedgerModel(spark, erp, dataclasses.replace(cfg, as_of=None))
    assert isinstance(model.cfg.as_of, dt.date)


def test_unreadable_version_is_an_error(spark):
    """A version that cannot be read is not taken for an absent table."""
    from payledger.plans.pipeline import upsert_table

    root = tempfile.mkdtemp(prefix="upsert-broken-") + "/t"
    os.makedirs(f"{root}/version=0")
    with open(f"{root}/version=0/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):  # noqa: B017
        upsert_table(spark, root, spark.createDataFrame([(1, "a")], "k int, v string"), ["k"])
    assert sorted(n for n in os.listdir(root) if n.startswith("version=")) == ["version=0"]


def test_duplicate_keys_are_not_published(spark):
    from payledger.plans.pipeline import latest_version, upsert_table

    root = tempfile.mkdtemp(prefix="upsert-twice-") + "/t"
    with pytest.raises(ValueError):
        upsert_table(spark, root, spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), ["k"])
    assert latest_version(spark, root) is None


def test_unreadable_holiday_is_an_error(spark):
    from payledger.sources.holidays import load_holiday_csv

    folder = tempfile.mkdtemp(prefix="holidays-bad-")
    with open(f"{folder}/a.csv", "w") as f:
        f.write("HolidayDate;Name\n01/01/2001;New Year\n12-25-2001;odd\n")
    with pytest.raises(ValueError, match="1 holiday rows"):
        load_holiday_csv(spark, folder)
