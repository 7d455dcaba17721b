"""

``entry(spark)`` runs the flagship accounts-payable dataset on sf0.001.
the driver tables of ``sf_dir``; ``oracle_sql()`` gives, for the same keys, an
independent DuckDB formulation (payledger.oracle). Oracle-checked queries
return their columns as canonical text (``for_oracle``), the same rendering the
SQL ends with, so the value comparison is exact across engines.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payledger import oracle as O
from payledger.config import FIXTURE_CONFIG
from payledger.functions.amounts import debit_credit_label, sign_flip_columns
from payledger.operators.describe import attach_descriptions
from payledger.operators.upsert import upsert
from payledger.plans import calendar as C
from payledger.plans import currency as CUR
from payledger.plans.documents import LINE_AMOUNTS
from payledger.plans.fiscal import fiscal_period_lookup
from payledger.plans.model import LedgerModel
from payledger.plans.payables import OUTPUT_COLUMNS
from payledger.sources.fixtures import erp_tables
from payledger.sources.holidays import load_holiday_csv, write_holiday_csv
from payledger.session import checkpoint_dir

try:  # the training-data operators are optional: the library works without them
    from payledger.llm import queries as LLM
except ImportError as absent:
    if absent.name != "payledger.llm":  # the package is there, something that it needs is not
        raise
    LLM = None

CFG = FIXTURE_CONFIG


def for_oracle(df: DataFrame) -> DataFrame:
    """Every column as canonical text (dates yyyy-MM-dd, decimals at their scale)."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


_MODELS: dict[tuple[str, str], LedgerModel] = {}


def _model(spark: SparkSession, sf_dir: str) -> LedgerModel:
    """One model per Spark context and data folder: the queries share its
    lazily built datasets and its materialised dimensions."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        _MODELS[key] = LedgerModel(spark, erp_tables(spark, sf_dir), CFG)
    return _MODELS[key]


def entry(spark: SparkSession) -> DataFrame:
    return _model(spark, "/root/testdata/sf0.001").accounts_payable


# ----------------------------------------------------------------- queries

FLIP_KEYS = ["mandt", "bukrs", "belnr", "gjahr", "buzei", "shkzg"]
FLIP_COLS = ["dmbtr", "wrbtr", "kzbtr", "skfbt", "nebtr", "dmbe2", "dmbe3", "pswbt", "rewrt"]


def q_sign_flip_lines(spark, sf_dir):
    bseg = _model(spark, sf_dir).tables["bseg"]
    flipped = sign_flip_columns(bseg, [code for code, _, _ in LINE_AMOUNTS])
    return for_oracle(flipped.select(*FLIP_KEYS, debit_credit_label(F.col("shkzg")).alias("dr_cr_flag"), *FLIP_COLS))


DOC_KEYS = ["Client_MANDT", "CompanyCode_BUKRS", "AccountingDocumentNumber_BELNR", "FiscalYear_GJAHR",
            "NumberOfLineItemWithinAccountingDocument_BUZEI"]
SCALED = ["CurrencyKey_WAERS", "LocalCurrency_HWAER", "AmountInLocalCurrency_DMBTR", "AmountInDocumentCurrency_WRBTR",
          "OriginalReductionAmountInLocalCurrency_KZBTR", "AmountForUpdatingInGeneralLedger_PSWBT",
          "AmountEligibleForCashDiscountInDocumentCurrency_SKFBT", "NetPaymentAmount_NEBTR",
          "AmountInSecondLocalCurrency_DMBE2", "AmountInThirdLocalCurrency_DMBE3",
          "InvoiceValueEntered_inLocalCurrency_REWRT"]


def q_currency_decimal_fix(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).accounting_documents.select(*DOC_KEYS, *SCALED))


def q_rate_intervals(spark, sf_dir):
    return for_oracle(CUR.rate_intervals(_model(spark, sf_dir).tables, CFG))


def q_rate_factor_containment(spark, sf_dir):
    return for_oracle(CUR.rate_factor_containment(_model(spark, sf_dir).tables, CFG))


def q_currency_conversion_daily(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).currency_conversion_view)


def q_calendar_dim(spark, sf_dir):
    m = _model(spark, sf_dir)
    posted = m.tables["bkpf"].select(F.col("budat").alias("Date"))
    return for_oracle(m.calendar.join(posted, "Date", "left_semi"))


def q_business_days(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).business_days)


def q_business_day_lookup(spark, sf_dir):
    m = _model(spark, sf_dir)
    docs = m.tables["bkpf"].select("mandt", "bukrs", "belnr", "gjahr", "budat")
    out = C.add_next_business_day(docs, m.business_days, F.col("budat"), "next_business_day", CFG)
    out = C.add_previous_business_day(out, m.business_days, F.col("budat"), "previous_business_day", CFG)
    return for_oracle(out)


UPSERT_SPLIT = dt.date(1999, 12, 31)


def q_business_days_upsert(spark, sf_dir):
    m = _model(spark, sf_dir)
    hol = C.holidays_from_table(m.tables)
    target = C.business_days(spark, hol, CFG.calendar_start, UPSERT_SPLIT, CFG)
    source = C.business_days(spark, hol, UPSERT_SPLIT - dt.timedelta(days=10), CFG.calendar_end, CFG)
    return for_oracle(upsert(target, source, ["date"]))


def q_net_due_dates(spark, sf_dir):
    ad = _model(spark, sf_dir).accounting_documents
    return for_oracle(ad.select(*DOC_KEYS, "AccountType_KOART", "NetDueDateCalc", "Sk1DtCalc", "Sk2DtCalc"))


def q_fiscal_periods(spark, sf_dir):
    m = _model(spark, sf_dir)
    hdr = m.tables["bkpf"].select("mandt", "bukrs", "belnr", "gjahr", F.col("budat").alias("date"))
    comp = m.tables["t001"].select("mandt", "bukrs", "periv")
    keyed = hdr.join(comp, ["mandt", "bukrs"], "inner")
    periods = fiscal_period_lookup(keyed.select("mandt", "periv", "date").distinct(), m.tables["t009"], m.tables["t009b"])
    out = keyed.join(periods, ["mandt", "periv", "date"], "left")
    return for_oracle(out.select("mandt", "bukrs", "belnr", "gjahr", "date", "periv", "fiscal_case", "fiscal_period"))


def q_companies_md(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).companies)


def q_customers_md(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).customers)


def q_vendors_md(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).vendors)


def q_vendor_config(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).vendor_config)


def q_invoice_flow(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).invoices.drop("AccountNumber_LIFNR", "Accounttype_KOART"))


def q_purchase_history(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).purchase_history.drop(
        "PurchaseOrderHistoryCategory_BEWTP", "QuantityInPurchaseOrderPriceUnit_BPMNG"))


ACC_COLS = ["DocumentType_BLART", "DocumentDateInDocument_BLDAT", "PostingDateInTheDocument_BUDAT",
            "FiscalPeriod_MONAT", "ObjectKey_AWKEY", "ClearingDate_AUGDT", "DocumentNumberOfTheClearingDocument_AUGBL",
            "PostingKey_BSCHL", "AccountType_KOART", "SpecialGlIndicator_UMSKZ", "DebitcreditIndicator_SHKZG",
            "TransactionKey_KTOSL", "AccountNumberOfVendorOrCreditor_LIFNR", "BaselineDateForDueDateCalculation_ZFBDT",
            "TermsOfPaymentKey_ZTERM", "CashDiscountDays1_ZBD1T", "CashDiscountDays2_ZBD2T",
            "NetPaymentTermsPeriod_ZBD3T", "CashDiscountPercentage1_ZBD1P", "PaymentBlockKey_ZLSPR",
            "PurchasingDocumentNumber_EBELN", "ItemNumberOfPurchasingDocument_EBELP",
            "YearOfPostingDateInTheDocument_BUDAT", "MonthOfPostingDateInTheDocument_BUDAT",
            "WeekOfPostingDateInTheDocument_BUDAT", "QuarterOfPostingDateInTheDocument_BUDAT",
            "YearOfDocumentDateInDocument_BLDAT", "MonthOfDocumentDateInDocument_BLDAT",
            "WeekOfDocumentDateInDocument_BLDAT", "QuarterOfDocumentDateInDocument_BLDAT"]


def q_accounting_documents(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).accounting_documents.select(*DOC_KEYS, *ACC_COLS))


MEASURES = ["WrittenOffAmount_DMBTR", "BadDebt_DMBTR", "AmountInLocalCurrencyClearingDate_DMBTR", "OpenAndNotDue",
            "ClearedAfterDueDate", "ClearedOnOrBeforeDueDate", "OpenAndOverdue", "DoubtfulReceivables",
            "DaysInArrear", "AccountsReceivable", "Sales"]


def q_receivable_measures(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).accounting_documents.select(*DOC_KEYS, *MEASURES))


def q_parked_invoices(spark, sf_dir):
    from payledger.plans.payables import parked_invoices

    return for_oracle(parked_invoices(_model(spark, sf_dir).invoices, CFG))


def q_payable_union(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).accounting_invoices)


AP_KEYS = ["Client_MANDT", "CompanyCode_BUKRS", "AccountingDocumentNumber_BELNR", "FiscalYear_GJAHR",
           "NumberOfLineItemWithinAccountingDocument_BUZEI", "AccountNumberOfVendorOrCreditor_LIFNR"]
DUE_COLS = ["CompanyText_BUTXT", "PostingDateInTheDocument_BUDAT", "DocFiscPeriod", "KeyFiscPeriod", "NetDueDate"]
STATUS_COLS = [c for c in OUTPUT_COLUMNS if c.startswith(("Overdue", "OutstandingButNotOverdue", "PartialPayments",
                                                          "LatePayments", "UpcomingPayments"))]
OTHER_COLS = ["NAME1", "VendorAccountGroup_KTOKK", "MovementType__inventoryManagement___BWART", "ExchangeRate_UKURS",
              "TargetCurrency_TCURR", "AmountInTargetCurrency_WRBTR"] + [
    c for c in OUTPUT_COLUMNS if c.startswith(("PotentialPenalty", "PurchaseIn", "CashDiscountReceived",
                                               "TargetCashDiscount", "AmountOfOpenDebitItems", "AmountOfReturn",
                                               "POOrderHistory_"))]
FLAG_COLS = ["IsInvoice", "IsManualPayment", "IsAutomaticPayment", "IsInvoiceMaterialService", "IsHardBlocked",
             "IsLegal", "IsParkedInvoice", "IsBlockedInvoice"]


def q_payable_due_date(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).accounting_invoices_kpi.select(*AP_KEYS, *DUE_COLS))


def q_payable_kpi_status(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).payable_plan.select(*AP_KEYS, "NetDueDate", *STATUS_COLS))


def q_payable_kpi_other(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).payables([*AP_KEYS, *OTHER_COLS]))


def q_payable_flags(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).payable_plan.select(*AP_KEYS, *FLAG_COLS))


def q_accounts_payable(spark, sf_dir):
    return for_oracle(_model(spark, sf_dir).accounts_payable)


def q_described_schema(spark, sf_dir):
    from payledger.descriptions import PAYABLE_DESCRIPTIONS

    described, _missing = attach_descriptions(_model(spark, sf_dir).accounts_payable, PAYABLE_DESCRIPTIONS)
    return for_oracle(described)


def q_holiday_csv(spark, sf_dir):
    m = _model(spark, sf_dir)
    folder = os.path.join(checkpoint_dir(spark), f"holiday-csv-{uuid.uuid4().hex}")
    write_holiday_csv(C.holidays_from_table(m.tables), folder)
    loaded, _count = load_holiday_csv(spark, folder)
    return for_oracle(loaded)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "sign_flip_lines": q_sign_flip_lines,
        "currency_decimal_fix": q_currency_decimal_fix,
        "rate_intervals": q_rate_intervals,
        "rate_factor_containment": q_rate_factor_containment,
        "currency_conversion_daily": q_currency_conversion_daily,
        "calendar_dim": q_calendar_dim,
        "business_days": q_business_days,
        "business_day_lookup": q_business_day_lookup,
        "business_days_upsert": q_business_days_upsert,
        "net_due_dates": q_net_due_dates,
        "fiscal_periods": q_fiscal_periods,
        "companies_md": q_companies_md,
        "customers_md": q_customers_md,
        "vendors_md": q_vendors_md,
        "vendor_config": q_vendor_config,
        "invoice_flow": q_invoice_flow,
        "purchase_history": q_purchase_history,
        "accounting_documents": q_accounting_documents,
        "receivable_measures": q_receivable_measures,
        "parked_invoices": q_parked_invoices,
        "payable_union": q_payable_union,
        "payable_due_date": q_payable_due_date,
        "payable_kpi_status": q_payable_kpi_status,
        "payable_kpi_other": q_payable_kpi_other,
        "payable_flags": q_payable_flags,
        "accounts_payable": q_accounts_payable,
        "described_schema": q_described_schema,
        "holiday_csv": q_holiday_csv,
        **(LLM.queries() if LLM else {}),
    }


def oracle_sql() -> dict[str, str]:
    return {**O.oracle_queries(
        doc_keys=DOC_KEYS, scaled=SCALED, acc_cols=ACC_COLS, measures=MEASURES, ap_keys=AP_KEYS,
        due_cols=DUE_COLS, status_cols=STATUS_COLS, other_cols=OTHER_COLS, flag_cols=FLAG_COLS,
        flip_keys=FLIP_KEYS, flip_cols=FLIP_COLS, upsert_split=UPSERT_SPLIT,
    ), **(LLM.oracle_sql() if LLM else {})}
