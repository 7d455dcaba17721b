"""Deploy: build every dataset in dependency order and persist the tables.

Order: currency_conversion (date-partitioned) and currency_decimal (replaced),
calendar_date_dim (created only when absent), FebrabanHoliday and BusinessDays
(upserted), then the nine datasets, which read those tables back, with
descriptions on the payable one. Every output is a stored table in a shared
folder, and with a database also a catalog table, so a new session finds it.
"""

from __future__ import annotations

import dataclasses
import json
import os
import uuid
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payledger.config import LedgerConfig
from payledger.descriptions import PAYABLE_DESCRIPTIONS
from payledger.operators.describe import attach_descriptions
from payledger.plans import calendar, masterdata
from payledger.plans.model import LedgerModel
from payledger.sources import versioned
from payledger.sources.erp import HOLIDAY_TABLE
from payledger.sources.holidays import load_counts, load_holiday_csv
from payledger.sources.versioned import Partition

# Names of the published views.
VIEW_NAMES = {
    "currency_conversion_view": "CurrencyConversion",
    "companies": "CompaniesMD",
    "customers": "CustomersMD",
    "vendor_config": "VendorConfig",
    "vendors": "VendorsMD",
    "invoices": "InvoiceDocuments_Flow",
    "purchase_history": "PurchaseDocumentsHistory",
    "accounting_documents": "AccountingDocuments",
    "accounts_payable": "AccountsPayableGenAI",
}


# Partitions of the stored helper tables: a year a folder.
RATE_YEARS = Partition("conv_year", "year(conv_date)", "conv_date")
DAY_YEARS = Partition("cal_year", "year(date)", "date")

# Dataset -> the ERP tables and stored tables it is built from.
INPUTS = {
    "CurrencyConversion": ["currency_conversion"],
    "CompaniesMD": ["t001"],
    "CustomersMD": ["kna1", "adrc"],
    "VendorConfig": ["tvarvc"],
    "VendorsMD": ["lfa1", "adrc"],
    "InvoiceDocuments_Flow": ["rseg", "rbco", "rbkp", "prps", "currency_decimal", "calendar_date_dim"],
    "PurchaseDocumentsHistory": ["ekbe", "currency_decimal", "calendar_date_dim"],
    "AccountingDocuments": ["bseg", "bkpf", "currency_decimal", "calendar_date_dim"],
    "AccountsPayableGenAI": ["AccountingDocuments", "InvoiceDocuments_Flow", "PurchaseDocumentsHistory", "CompaniesMD", "VendorsMD",
                             "VendorConfig", "CurrencyConversion", "BusinessDays", "t009", "t009b", "bkpf", "rbkp"],
}

# Datasets that depend on "today" themselves.
DATED = {"AccountingDocuments", "AccountsPayableGenAI"}


def latest_version(spark: SparkSession, root: str) -> int | None:
    found = versioned.versions(spark, root)
    return found[-1] if found else None


def upsert_table(spark: SparkSession, root: str, source: DataFrame, keys: list[str]) -> int:
    """MERGE ``source`` into the versioned table at ``root`` (no delete branch);
    older versions stay readable. Returns the version published."""
    return versioned.upsert_table(spark, root, source, keys).version


def _holidays(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, csv: str | None) -> DataFrame:
    """The stored holiday table: rows of the CSV (or of the replicated table) are
    added to it, then it is read back. With neither, the stored rows count."""
    if csv is not None:
        given = load_holiday_csv(spark, csv)[0]
    elif HOLIDAY_TABLE in tables:
        given = calendar.holidays_from_table(tables).where("HolidayDate IS NOT NULL").distinct()
    else:
        given = None
    if given is not None:
        versioned.upsert_table(spark, root, given, ["HolidayDate"])
    if versioned.current(spark, root) is None:
        raise ValueError(f"no holiday table: give a holiday CSV or a {HOLIDAY_TABLE} table")
    return versioned.read(spark, root)


def deploy(spark: SparkSession, tables: Mapping[str, DataFrame], cfg: LedgerConfig, out_root: str,
           database: str | None = None, holiday_csv: str | None = None,
           datasets: Collection[str] | None = None, states: Mapping[str, str] | None = None,
           keep_versions: int | None = None) -> dict[str, str]:
    """Build and persist the helper tables and the nine datasets; returns where
    each one is, under ``missing_descriptions`` the payable columns that no
    description names, under ``rebuilt`` the datasets that were built anew, and under
    ``holiday_rows`` what became of the rows of a holiday CSV.

    ``datasets`` limits the run to some of ``VIEW_NAMES``. Holidays come from
    ``holiday_csv`` when it is given. With ``database`` every output is a persistent
    catalog view over its newest version as well (the calendar a table, created only
    when the catalog does not have it yet); without one the datasets get session
    views. Rates, decimals, calendar, holidays and business days are read back from
    their tables by whatever follows, and a dataset that builds on another reads
    the stored one.

    ``states`` names the content of the ERP tables (see ``sources.erp.table_states``).
    With it a dataset is built only when a table it builds on, the settings or
    "today" changed since its newest version: a run after a new holiday or rate
    refreshes what depends on it, in order, and leaves the rest. Without it every
    dataset is built. ``keep_versions`` removes older versions at the end."""
    def at(name):
        return os.path.join(out_root, name)

    out = {"FebrabanHoliday": at("FebrabanHoliday")}
    holidays = _holidays(spark, tables, out["FebrabanHoliday"], holiday_csv)
    if holiday_csv is not None:
        out["holiday_rows"] = json.dumps(load_counts(spark, holiday_csv))
    build = LedgerModel(spark, {**tables, HOLIDAY_TABLE: holidays}, cfg)
    stored: dict[str, DataFrame] = {}
    state: dict[str, str] = dict(states or {})

    out["currency_conversion"] = at("currency_conversion")
    kept = versioned.replace_table(spark, at("currency_conversion"), build.currency_conversion, RATE_YEARS)
    stored["currency_conversion"], state["currency_conversion"] = versioned.read(spark, at("currency_conversion"), kept), kept.state()

    kept = _whole_if_changed(spark, at("currency_decimal"), build.currency_decimal.coalesce(1))  # a row per currency
    out["currency_decimal"] = os.path.join(at("currency_decimal"), kept.folders[versioned.WHOLE])
    stored["currency_decimal"], state["currency_decimal"] = versioned.read(spark, at("currency_decimal"), kept), kept.state()

    days = calendar.calendar_date_dim(spark, cfg.calendar_start, cfg.calendar_end)
    if database is not None:
        name = f"{database}.calendar_date_dim"
        if not spark.catalog.tableExists(name):  # create only when absent
            days.write.option("path", at("calendar_date_dim")).saveAsTable(name)
        out["calendar_date_dim"], stored["calendar"] = name, spark.table(name)
    else:
        out["calendar_date_dim"] = at("calendar_date_dim")
        if not versioned.exists(spark, out["calendar_date_dim"]):  # create only when absent
            days.write.parquet(out["calendar_date_dim"])
        stored["calendar"] = spark.read.parquet(out["calendar_date_dim"])
    # a row per day of the configured range, and no more: cheap to compare
    state["calendar_date_dim"] = _content(stored["calendar"])

    out["BusinessDays"] = at("BusinessDays")
    kept = versioned.upsert_table(spark, out["BusinessDays"], build.business_days, ["date"], DAY_YEARS)
    stored["business_days"], state["BusinessDays"] = read_business_days(spark, out["BusinessDays"]), kept.state()
    helpers = {"currency_conversion": RATE_YEARS, "currency_decimal": None, "BusinessDays": DAY_YEARS, "FebrabanHoliday": None}

    settings, rebuilt = build.cfg, []
    for attr, view in VIEW_NAMES.items():
        if datasets is not None and view not in datasets:
            continue
        inputs = {name: state.get(name, uuid.uuid4().hex) for name in INPUTS[view]}
        inputs["settings"] = repr(settings if view in DATED else dataclasses.replace(settings, as_of=None))
        kept = versioned.current(spark, at(view))
        if kept is None or dict(kept.inputs) != inputs:
            model = LedgerModel(spark, build.tables, build.cfg, stored)
            df = getattr(model, attr)
            if attr == "customers":
                df = masterdata.customers_md(model.tables, model.cfg, ordered=True)
            elif attr == "accounts_payable":
                df, missing = attach_descriptions(df, PAYABLE_DESCRIPTIONS)
                out["missing_descriptions"] = ",".join(missing)
            kept = versioned.replace_table(spark, at(view), df, inputs=inputs)
            rebuilt.append(view)
        frame = versioned.read(spark, at(view), kept)
        state[view] = kept.state()
        if attr not in ("customers", "accounts_payable"):
            stored[attr] = frame
        if database is not None:
            out[view] = versioned.catalog_view(spark, database, view, at(view), kept)
        else:
            frame.createOrReplaceTempView(view)
            out[view] = os.path.join(at(view), kept.folders[versioned.WHOLE])
    for name in helpers:
        if database is not None:
            versioned.catalog_view(spark, database, name, at(name), versioned.current(spark, at(name)))
    if keep_versions is not None:
        for name in [*helpers, *(VIEW_NAMES.values() if datasets is None else datasets)]:
            versioned.retain(spark, at(name), keep_versions)
    out["rebuilt"] = ",".join(rebuilt)
    return out


def _content(df: DataFrame) -> str:
    """A digest of the rows of a small table that does not depend on their order."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("h")).first()
    return f"{r['n']}:{r['h']}"


def _whole_if_changed(spark: SparkSession, root: str, df: DataFrame) -> versioned.Commit:
    """Publish a small table anew unless its newest version has the same rows."""
    content = {"rows": _content(df)}
    newest = versioned.current(spark, root)
    if newest is not None and dict(newest.inputs) == content:
        return newest
    return versioned.replace_table(spark, root, df, inputs=content)


def read_business_days(spark: SparkSession, root: str) -> DataFrame:
    return versioned.read(spark, root).select("date", "is_business_day", "previous_business_day", "next_business_day")
