"""The accounts-payable KPI fact: one row per vendor line item or parked invoice.

Stages (each a DataFrame function):

1. ``posted_vendor_lines``: vendor lines of the accounting documents, left
   joined to supplier-invoice lines on keys derived on both sides.
2. ``parked_invoices``: parked invoices, first line (rank 1, ties kept).
3. ``accounting_invoices``: union of 1 and 2 plus the previous business day.
4. ``accounting_invoices_kpi``: company, fiscal periods, net due date.
5. ``accounts_payable``: vendor, vendor config, PO history, exchange rate,
   flags and the KPI families in local, document and target currency.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StringType

from payledger.config import LedgerConfig
from payledger.functions.amounts import exact_product
from payledger.functions.dates import days_to_int
from payledger.functions.text import last_token, left, strip_leading_zeros
from payledger.operators.joins import (
    HotKeys, broadcast_if_small, frequent_keys, left_join_nulls_apart, left_join_salted_nulls, lookup_left_join,
)
from payledger.operators.ranking import keep_first_rank
from payledger.plans.calendar import add_next_business_day, add_previous_business_day
from payledger.plans.fiscal import fiscal_period_lookup
from payledger.types import AMOUNT, NUMERIC, RATE, zero

# The union's columns and types (the parked branch fills the rest with NULLs).
UNION_COLUMNS: list[tuple[str, object]] = [
    ("Client_MANDT", StringType()),
    ("CompanyCode_BUKRS", StringType()),
    ("AccountingDocumentNumber_BELNR", StringType()),
    ("FiscalYear_GJAHR", StringType()),
    ("AccountingDocumenttype_BLART", StringType()),
    ("InvoiceDocumenttype_BLART", StringType()),
    ("DocumentDateInDocument_BLDAT", DateType()),
    ("PostingDateInTheDocument_BUDAT", DateType()),
    ("PostingDate_BUDAT", DateType()),
    ("FiscalPeriod_MONAT", StringType()),
    ("PurchasingDocumentNumber_EBELN", StringType()),
    ("NumberOfLineItemWithinAccountingDocument_BUZEI", StringType()),
    ("ClearingDate_AUGDT", DateType()),
    ("NetPaymentAmount_NEBTR", AMOUNT),
    ("AmountInLocalCurrency_DMBTR", AMOUNT),
    ("AmountInDocumentCurrency_WRBTR", AMOUNT),
    ("AccountType_KOART", StringType()),
    ("TransactionKey_KTOSL", StringType()),
    ("PostingKey_BSCHL", StringType()),
    ("CashDiscountDays1_ZBD1T", DecimalType(3, 0)),
    ("BaselineDateForDueDateCalculation_ZFBDT", DateType()),
    ("AmountEligibleForCashDiscountInDocumentCurrency_SKFBT", AMOUNT),
    ("AccountNumberOfVendorOrCreditor_LIFNR", StringType()),
    ("PaymentBlockKey_ZLSPR", StringType()),
    ("SpecialGlIndicator_UMSKZ", StringType()),
    ("ItemNumberOfPurchasingDocument_EBELP", StringType()),
    ("FollowOnDocumentType_REBZT", StringType()),
    ("DocumentNumberOfTheClearingDocument_AUGBL", StringType()),
    ("TermsOfPaymentKey_ZTERM", StringType()),
    ("ReasonCodeForPayments_RSTGR", StringType()),
    ("CashDiscountPercentage1_ZBD1P", DecimalType(5, 3)),
    ("NetPaymentTermsPeriod_ZBD3T", DecimalType(3, 0)),
    ("CashDiscountDays2_ZBD2T", DecimalType(3, 0)),
    ("DebitcreditIndicator_SHKZG", StringType()),
    ("InvoiceToWhichTheTransactionBelongs_REBZG", StringType()),
    ("CurrencyKey_WAERS", StringType()),
    ("SupplyingCountry_LANDL", StringType()),
    ("ObjectKey_AWKEY", StringType()),
    ("InvStatus_RBSTAT", StringType()),
    ("YearOfPostingDateInTheDocument_BUDAT", "long"),
    ("MonthOfPostingDateInTheDocument_BUDAT", "long"),
    ("WeekOfPostingDateInTheDocument_BUDAT", "long"),
    ("QuarterOfPostingDateInTheDocument_BUDAT", "long"),
]

_ZERO_DEFAULT = {
    "NetPaymentAmount_NEBTR",
    "AmountInLocalCurrency_DMBTR",
    "AmountInDocumentCurrency_WRBTR",
    "AmountEligibleForCashDiscountInDocumentCurrency_SKFBT",
}


# The union's columns that parked invoices fill, from the invoice flow.
PARKED_SOURCE = {
    "AccountingDocumentNumber_BELNR": "InvoiceDocNum_BELNR",
    "DocumentDateInDocument_BLDAT": "DocumentDate_BLDAT",
    "PostingDateInTheDocument_BUDAT": "PostingDate_BUDAT",
    "PostingDate_BUDAT": "PostingDate_BUDAT",
    "AmountInLocalCurrency_DMBTR": "GrossInvAmnt_RMWWR",
    "AmountInDocumentCurrency_WRBTR": "AmountinDocumentCurrency_WRBTR",
    "AccountNumberOfVendorOrCreditor_LIFNR": "InvoicingParty_LIFNR",
    "CurrencyKey_WAERS": "Currency_WAERS",
    "InvStatus_RBSTAT": "Invstatus_RBSTAT",
    "Client_MANDT": "Client_MANDT",
    "CompanyCode_BUKRS": "CompanyCode_BUKRS",
    "FiscalYear_GJAHR": "FiscalYear_GJAHR",
    "YearOfPostingDateInTheDocument_BUDAT": "YearOfPostingDate_BUDAT",
    "MonthOfPostingDateInTheDocument_BUDAT": "MonthOfPostingDate_BUDAT",
    "WeekOfPostingDateInTheDocument_BUDAT": "WeekOfPostingDate_BUDAT",
    "QuarterOfPostingDateInTheDocument_BUDAT": "QuarterOfPostingDate_BUDAT",
}
# The columns of the invoice flow that the fact reads, in either branch.
INVOICE_FLOW_COLUMNS = sorted({*PARKED_SOURCE.values(), "InvoiceDocLineNum_BUZEI", "Documenttype_BLART"})


def _typed(c: Column, t) -> Column:
    return c.cast(t)


def join_keys() -> dict[str, list[Column]]:
    """The keys of the two fact-to-fact joins, as expressions over accounting lines,
    document numbers first (see ``documents.HEADER_KEYS``)."""
    client, year = F.col("Client_MANDT"), F.col("FiscalYear_GJAHR")
    return {
        "invoice": [left(F.col("ObjectKey_AWKEY"), 10), strip_leading_zeros(F.col("NumberOfLineItemWithinAccountingDocument_BUZEI")),
                    year, F.col("CompanyCode_BUKRS"), client],
        "purchase": [F.col("PurchasingDocumentNumber_EBELN"), F.col("ItemNumberOfPurchasingDocument_EBELP"),
                     F.col("ObjectKey_AWKEY"), year, client],
    }


def hot_join_keys(acc_docs: DataFrame, cfg: LedgerConfig, partitions: int) -> dict[str, HotKeys]:
    """The invoices and purchase-order items that hold ``cfg.hot_key_share`` of the
    vendor lines or more: one pass over the key columns of the lines."""
    lines = acc_docs.where(F.col("AccountType_KOART") == cfg.vendor_account_type)
    return frequent_keys(lines, join_keys(), cfg.hot_key_share, partitions)


def vendor_lines(acc_docs: DataFrame, cfg: LedgerConfig) -> DataFrame:
    """The accounting lines that ``posted_vendor_lines`` reads, and their columns that it reads."""
    names = ["DocumentType_BLART" if name == "AccountingDocumenttype_BLART" else name for name, _ in UNION_COLUMNS
             if name not in ("InvoiceDocumenttype_BLART", "PostingDate_BUDAT", "InvStatus_RBSTAT")]
    return acc_docs.where(F.col("AccountType_KOART") == cfg.vendor_account_type).select(*names)


def posted_vendor_lines(acc_docs: DataFrame, invoices: DataFrame, cfg: LedgerConfig, hot: HotKeys | None = None,
                        nulls_apart: bool = False) -> DataFrame:
    """Vendor ('K') lines joined to the invoice lines they were posted from.

    Keys: client, company, first 10 characters of the object key = invoice
    number, fiscal year, and the line number without leading zeros on both
    sides. Several invoice lines can match one posting line (kept, as in the
    source model). NULL-key rows are salted so they do not pile up in one task, or
    pass by the join (``nulls_apart``, for stored lines).
    """
    ad = acc_docs.where(F.col("AccountType_KOART") == cfg.vendor_account_type)
    inv = invoices.select(
        F.col("Client_MANDT").alias("__i_mandt"),
        F.col("CompanyCode_BUKRS").alias("__i_bukrs"),
        F.col("InvoiceDocNum_BELNR").alias("__i_belnr"),
        F.col("FiscalYear_GJAHR").alias("__i_gjahr"),
        strip_leading_zeros(F.col("InvoiceDocLineNum_BUZEI")).alias("__i_buzei"),
        F.col("Documenttype_BLART").alias("InvoiceDocumenttype_BLART"),
        F.col("PostingDate_BUDAT"),
    )
    pairs = list(zip(join_keys()["invoice"], ["__i_belnr", "__i_buzei", "__i_gjahr", "__i_bukrs", "__i_mandt"]))
    join = left_join_nulls_apart if nulls_apart else left_join_salted_nulls
    joined = join(
        ad, inv, pairs, ["AccountingDocumentNumber_BELNR", "NumberOfLineItemWithinAccountingDocument_BUZEI"], hot
    )
    cols = []
    for name, t in UNION_COLUMNS:
        if name == "AccountingDocumenttype_BLART":
            c = F.col("DocumentType_BLART")
        elif name == "InvStatus_RBSTAT":
            c = F.lit(None)
        elif name in _ZERO_DEFAULT:
            c = F.coalesce(F.col(name).cast(t), zero(t))
        else:
            c = F.col(name)
        cols.append(_typed(c, t).alias(name))
    return joined.select(*cols)


def parked_invoices(invoices: DataFrame, cfg: LedgerConfig) -> DataFrame:
    """Parked invoices (status 'A'): the lowest line number of each
    (client, company, invoice number), ties kept; fiscal year is not part of
    the grouping, as in the source model."""
    parked = keep_first_rank(
        invoices.where(F.col("Invstatus_RBSTAT") == cfg.parked_status),
        ["InvoiceDocNum_BELNR", "CompanyCode_BUKRS", "Client_MANDT"],
        F.col("InvoiceDocLineNum_BUZEI").asc_nulls_first(),
    )
    cols = [
        _typed(F.col(PARKED_SOURCE[name]) if name in PARKED_SOURCE else F.lit(None), t).alias(name) for name, t in UNION_COLUMNS
    ]
    return parked.select(*cols)


def payable_rows(
    acc_docs: DataFrame, invoices: DataFrame, cfg: LedgerConfig,
    parked_flow: DataFrame | None = None, hot: HotKeys | None = None, nulls_apart: bool = False,
) -> DataFrame:
    """Posted vendor lines UNION ALL parked invoices. ``parked_flow`` is an invoice
    flow already limited to parked headers (cheaper than filtering the full flow a
    second time)."""
    parked = parked_invoices(parked_flow if parked_flow is not None else invoices, cfg)
    return posted_vendor_lines(acc_docs, invoices, cfg, hot, nulls_apart).unionByName(parked)


def accounting_invoices(rows: DataFrame, bdays: DataFrame, cfg: LedgerConfig) -> DataFrame:
    """``payable_rows`` plus the previous business day of the posting date."""
    return add_previous_business_day(
        rows, bdays, F.col("PostingDateInTheDocument_BUDAT"), "PreviousBusinessDay_BUDAT", cfg
    )


def fiscal_keys_from_headers(tables: Mapping[str, DataFrame], companies: DataFrame) -> DataFrame:
    """(mandt, periv, date) for every posting date of the document headers.

    Reading three narrow header columns is cheaper than a second pass over
    the joined fact, and it covers every posting date the fact can hold.
    """
    dates = tables["bkpf"].select("mandt", "bukrs", F.col("budat").alias("date")).unionByName(
        tables["rbkp"].select("mandt", "bukrs", F.col("budat").alias("date"))
    ).distinct()
    comp = companies.select(
        F.col("Client_MANDT").alias("mandt"), F.col("CompanyCode_BUKRS").alias("bukrs"),
        F.col("FiscalyearVariant_PERIV").alias("periv"),
    )
    return dates.join(comp, ["mandt", "bukrs"], "inner").select(
        "mandt", "periv", "date"
    ).distinct()


def fiscal_period_dimension(
    companies: DataFrame, fiscal_keys: DataFrame, t009: DataFrame, t009b: DataFrame, cfg: LedgerConfig,
) -> DataFrame:
    """One fiscal dimension for both lookups: the posting dates of the documents
    and the key date (last day of the month before ``today``)."""
    key_keys = companies.select(
        F.col("Client_MANDT").alias("mandt"), F.col("FiscalyearVariant_PERIV").alias("periv"),
        cfg.previous_month_end().alias("date"),
    )
    return fiscal_period_lookup(fiscal_keys.unionByName(key_keys), t009, t009b)


def company_dimension(companies: DataFrame, fiscal_dim: DataFrame, cfg: LedgerConfig) -> DataFrame:
    """One row per company: name, fiscal variant, and the period of the key date.

    The key period depends on the company's (client, variant) only, so it is
    looked up here, in a table of a few rows, and not once per document line: the
    fact has no join on the handful of (client, variant) values at all."""
    key = fiscal_dim.where(F.col("date") == cfg.previous_month_end()).select(
        F.col("mandt").alias("__kf_mandt"), F.col("periv").alias("__kf_periv"),
        F.col("fiscal_period").alias("KeyFiscPeriod"),
    )
    return companies.select(
        F.col("Client_MANDT").alias("__c_mandt"), F.col("CompanyCode_BUKRS").alias("__c_bukrs"),
        "CompanyText_BUTXT", F.col("FiscalyearVariant_PERIV").alias("__periv"),
    ).join(
        key, (F.col("__c_mandt") == F.col("__kf_mandt")) & (F.col("__periv") == F.col("__kf_periv")), "left"
    ).drop("__kf_mandt", "__kf_periv")


def accounting_invoices_kpi(
    ai: DataFrame, companies: DataFrame, bdays: DataFrame, fiscal_dim: DataFrame, cfg: LedgerConfig,
) -> DataFrame:
    """Company name, fiscal period of the posting date and of the last day of
    the previous month, and the net due date moved to the next business day.
    ``companies`` comes from ``company_dimension``, ``fiscal_dim`` from
    ``fiscal_period_dimension``."""
    comp = broadcast_if_small(companies, cfg.broadcast_bytes)
    df = ai.join(
        comp, (F.col("Client_MANDT") == F.col("__c_mandt")) & (F.col("CompanyCode_BUKRS") == F.col("__c_bukrs")),
        "inner",
    ).drop("__c_mandt", "__c_bukrs")

    periods = fiscal_dim.select(
        F.col("mandt").alias("__f_mandt"), F.col("periv").alias("__f_periv"),
        F.col("date").alias("__f_date"), F.col("fiscal_period").alias("__f_period"),
    )
    df = lookup_left_join(
        df, periods,
        [(F.col("Client_MANDT"), "__f_mandt"), (F.col("__periv"), "__f_periv"),
         (F.col("PostingDateInTheDocument_BUDAT"), "__f_date")],
        ["AccountingDocumentNumber_BELNR", "NumberOfLineItemWithinAccountingDocument_BUZEI"],
        cfg.broadcast_bytes,
    ).withColumnRenamed("__f_period", "DocFiscPeriod").drop("__f_mandt", "__f_periv", "__f_date", "__periv")

    vendor_line = F.col("AccountType_KOART") == cfg.vendor_account_type
    base = F.when(vendor_line & F.col("BaselineDateForDueDateCalculation_ZFBDT").isNull(),
                  F.col("DocumentDateInDocument_BLDAT")).otherwise(F.col("BaselineDateForDueDateCalculation_ZFBDT"))
    days = days_to_int(F.coalesce(F.col("CashDiscountDays1_ZBD1T"), F.lit(0).cast("decimal(3,0)")))
    df = df.withColumn("__due_raw", F.date_add(base, days))
    return add_next_business_day(df, bdays, F.col("__due_raw"), "NetDueDate", cfg).drop("__due_raw")


def _kpi(cond: Column, local: Column, doc: Column, target: Column, prefix: str) -> dict[str, Column]:
    """Three currencies of one KPI. The amounts arrive as NUMERIC columns
    computed once per row (``measure_inputs``), so each KPI is a plain choice
    between that value and a NUMERIC zero."""
    return {
        f"{prefix}InLocalCurrency": F.when(cond, local).otherwise(zero()),
        f"{prefix}InDocumentCurrency": F.when(cond, doc).otherwise(zero()),
        f"{prefix}InTargetCurrency": F.when(cond, target).otherwise(zero()),
    }


# Output order of the flagship (83 columns).
OUTPUT_COLUMNS = [
    "Client_MANDT", "CompanyCode_BUKRS", "CompanyText_BUTXT", "AccountNumberOfVendorOrCreditor_LIFNR", "NAME1",
    "VendorAccountGroup_KTOKK", "AmountInLocalCurrency_DMBTR", "AmountInDocumentCurrency_WRBTR",
    "AccountingDocumentNumber_BELNR", "IsInvoice", "IsManualPayment", "IsAutomaticPayment",
    "IsInvoiceMaterialService", "IsHardBlocked", "IsLegal", "NumberOfLineItemWithinAccountingDocument_BUZEI",
    "DocumentNumberOfTheClearingDocument_AUGBL", "TermsOfPaymentKey_ZTERM", "AccountType_KOART",
    "ReasonCodeForPayments_RSTGR", "PaymentBlockKey_ZLSPR", "ClearingDate_AUGDT", "PostingDateInTheDocument_BUDAT",
    "FiscalYear_GJAHR", "FiscalPeriod_MONAT", "DocFiscPeriod", "KeyFiscPeriod", "NetDueDate", "InvStatus_RBSTAT",
    "PostingDate_BUDAT", "PurchasingDocumentNumber_EBELN", "CurrencyKey_WAERS", "SupplyingCountry_LANDL",
    "AccountingDocumenttype_BLART", "InvoiceDocumenttype_BLART", "MovementType__inventoryManagement___BWART",
    "POOrderHistory_AmountInLocalCurrency_DMBTR", "POOrderHistory_AmountInDocumentCurrency_WRBTR",
    "POOrderHistory_AmountInTargetCurrency_WRBTR", "YearOfPostingDateInTheDocument_BUDAT",
    "MonthOfPostingDateInTheDocument_BUDAT", "WeekOfPostingDateInTheDocument_BUDAT",
    "QuarterOfPostingDateInTheDocument_BUDAT", "AmountInTargetCurrency_WRBTR", "ExchangeRate_UKURS",
    "TargetCurrency_TCURR",
    "OverdueAmountInLocalCurrency", "OverdueAmountInDocumentCurrency", "OverdueAmountInTargetCurrency",
    "OutstandingButNotOverdueInLocalCurrency", "OutstandingButNotOverdueInDocumentCurrency",
    "OutstandingButNotOverdueInTargetCurrency",
    "OverdueOnPastDateInLocalCurrency", "OverdueOnPastDateInDocumentCurrency", "OverdueOnPastDateInTargetCurrency",
    "PartialPaymentsInLocalCurrency", "PartialPaymentsInDocumentCurrency", "PartialPaymentsInTargetCurrency",
    "LatePaymentsInLocalCurrency", "LatePaymentsInDocumentCurrency", "LatePaymentsInTargetCurrency",
    "UpcomingPaymentsInLocalCurrency", "UpcomingPaymentsInDocumentCurrency", "UpcomingPaymentsInTargetCurrency",
    "PotentialPenaltyInLocalCurrency", "PotentialPenaltyInDocumentCurrency", "PotentialPenaltyInTargetCurrency",
    "PurchaseInLocalCurrency", "PurchaseInDocumentCurrency", "PurchaseInTargetCurrency",
    "IsParkedInvoice", "IsBlockedInvoice",
    "CashDiscountReceivedInLocalCurrency", "CashDiscountReceivedInDocumentCurrency",
    "CashDiscountReceivedInTargetCurrency",
    "TargetCashDiscountInSourceCurrency", "TargetCashDiscountInTargetCurrency",
    "AmountOfOpenDebitItemsInLocalCurrency", "AmountOfOpenDebitItemsInDocumentCurrency",
    "AmountOfOpenDebitItemsInTargetCurrency",
    "AmountOfReturnInLocalCurrency", "AmountOfReturnInDocumentCurrency", "AmountOfReturnInTargetCurrency",
]


def current_vendors(vendors: DataFrame, cfg: LedgerConfig) -> DataFrame:
    """The vendor attributes of the fact, from the currently valid addresses."""
    return vendors.where(F.col("ValidToDate_DATE_TO") == F.lit(cfg.current_address_until)).select(
        F.col("Client_MANDT").alias("__v_mandt"),
        F.col("AccountNumberOfVendorOrCreditor_LIFNR").alias("__v_lifnr"),
        "NAME1", "VendorAccountGroup_KTOKK",
    )


def add_purchase_history(rows: DataFrame, po_history: DataFrame, hot: HotKeys | None = None,
                         nulls_apart: bool = False) -> DataFrame:
    """Left join to the PO history; ``nulls_apart`` as in ``posted_vendor_lines``."""
    po = po_history.select(
        F.col("Client_MANDT").alias("__p_mandt"),
        F.col("PurchasingDocumentNumber_EBELN").alias("__p_ebeln"),
        F.col("ItemNumberOfPurchasingDocument_EBELP").alias("__p_ebelp"),
        F.col("MaterialDocumentYear_GJAHR").alias("__p_gjahr"),
        F.concat(F.col("NumberOfMaterialDocument_BELNR"), F.col("MaterialDocumentYear_GJAHR")).alias("__p_awkey"),
        "MovementType__inventoryManagement___BWART",
        F.col("AmountInLocalCurrency_DMBTR").alias("__p_dmbtr"),
        F.col("AmountInDocumentCurrency_WRBTR").alias("__p_wrbtr"),
        F.col("Quantity_MENGE").alias("__p_menge"),
    )
    pairs = list(zip(join_keys()["purchase"], ["__p_ebeln", "__p_ebelp", "__p_awkey", "__p_gjahr", "__p_mandt"]))
    join = left_join_nulls_apart if nulls_apart else left_join_salted_nulls
    return join(rows, po, pairs, ["AccountingDocumentNumber_BELNR", "NumberOfLineItemWithinAccountingDocument_BUZEI"], hot)


def enrich(kpi: DataFrame, vendors: DataFrame, vconfig: DataFrame, po_history: DataFrame | None, rates: DataFrame,
           cfg: LedgerConfig, hot: HotKeys | None = None) -> DataFrame:
    """Left joins to current vendors (``current_vendors``), vendor config, PO history (None:
    ``kpi`` has it already) and rates (daily ones, or the intervals of ``target_rate_months``)."""
    salt = ["AccountingDocumentNumber_BELNR", "NumberOfLineItemWithinAccountingDocument_BUZEI"]
    df = lookup_left_join(
        kpi, vendors,
        [(F.col("Client_MANDT"), "__v_mandt"), (F.col("AccountNumberOfVendorOrCreditor_LIFNR"), "__v_lifnr")],
        salt, cfg.broadcast_bytes,
    )
    conf = vconfig.select(
        last_token(F.col("NameOfVariantVariable_NAME"), cfg.vendor_config_separator).alias("__vc_id"),
        F.col("LowField_LOW").alias("__vc_low"),
    )
    df = lookup_left_join(df, conf, [(F.col("__v_lifnr"), "__vc_id")], salt, cfg.broadcast_bytes)
    if po_history is not None:
        df = add_purchase_history(df, po_history, hot)
    names = [
        F.col("Client_MANDT").alias("__r_mandt"), F.col("FromCurrency_FCURR").alias("__r_fcurr"),
        F.col("ExchangeRate_UKURS").cast(RATE).alias("ExchangeRate_UKURS"), F.col("ToCurrency_TCURR").alias("TargetCurrency_TCURR"),
    ]
    day = F.col("PreviousBusinessDay_BUDAT")
    pairs = [(F.col("Client_MANDT"), "__r_mandt"), (F.col("CurrencyKey_WAERS"), "__r_fcurr")]
    if "month" in rates.columns:  # intervals by month
        rt = rates.select(*names, F.col("month").alias("__r_month"), F.col("first_day").alias("__r_from"), F.col("last_day").alias("__r_to"))
        return lookup_left_join(df, rt, [*pairs, (F.trunc(day, "MM"), "__r_month")], salt, cfg.broadcast_bytes,
                                within=(day, "__r_from", "__r_to"))
    rt = rates.select(*names, F.col("ConvDate").alias("__r_date"))
    return lookup_left_join(df, rt, [*pairs, (day, "__r_date")], salt, cfg.broadcast_bytes)


def measures(cfg: LedgerConfig) -> dict[str, Column]:
    today = cfg.today()
    koart = F.col("AccountType_KOART")
    # As a test by ``exists``, which Spark does not compile into the code of a whole stage: the
    # projection of all measures then gets code of its own, in many small methods. In one method
    # with the joins below it is too long (8,000 bytes and more) for the JVM to compile at all.
    vendor = F.exists(F.array(F.lit(cfg.vendor_account_type)), lambda kind: kind == koart)
    due = F.col("NetDueDate")
    augdt = F.col("ClearingDate_AUGDT")
    is_open = augdt < F.lit(cfg.open_item_sentinel)
    rate = F.col("ExchangeRate_UKURS").cast(RATE)
    # computed once per row by ``measure_inputs`` (CASE branches are not
    # shared by subexpression elimination, so they are plain columns here)
    T, L, D = F.col("__T"), F.col("__L"), F.col("__D")
    prefix2 = left(F.col("AccountingDocumentNumber_BELNR"), 2)
    bwart = F.col("MovementType__inventoryManagement___BWART")
    penalty = F.coalesce(_safe_int(F.col("__vc_low")), F.lit(0)).cast("decimal(19,0)")
    late = vendor & (augdt > due)

    out: dict[str, Column] = {
        "AmountInTargetCurrency_WRBTR": T,
        "POOrderHistory_AmountInLocalCurrency_DMBTR": F.col("__p_dmbtr").cast(NUMERIC),
        "POOrderHistory_AmountInDocumentCurrency_WRBTR": F.col("__p_wrbtr").cast(NUMERIC),
        "POOrderHistory_AmountInTargetCurrency_WRBTR": (F.col("__p_wrbtr").cast(AMOUNT) * rate).cast(NUMERIC),
        "IsInvoice": F.when(prefix2.isin(*cfg.payment_doc_prefixes), F.lit(False)).otherwise(F.lit(True)),
        "IsManualPayment": F.when(prefix2 == cfg.manual_payment_prefix, F.lit(True))
        .when(prefix2 == cfg.automatic_payment_prefix, F.lit(False)),
        "IsAutomaticPayment": F.when(prefix2 == cfg.automatic_payment_prefix, F.lit(True))
        .when(prefix2 == cfg.manual_payment_prefix, F.lit(False)),
        "IsInvoiceMaterialService": F.when(
            F.col("AccountingDocumenttype_BLART").isin(*cfg.material_service_doc_types)
            & F.col("VendorAccountGroup_KTOKK").isin(*cfg.material_service_vendor_groups), F.lit(True)
        ).otherwise(F.lit(False)),
        "IsHardBlocked": F.when(F.col("PaymentBlockKey_ZLSPR").isin(*cfg.hard_block_keys), F.lit(True))
        .otherwise(F.lit(False)),
        "IsLegal": F.when(F.col("VendorAccountGroup_KTOKK").isin(*cfg.legal_vendor_groups), F.lit(True))
        .otherwise(F.lit(False)),
        "IsParkedInvoice": F.when(F.col("InvStatus_RBSTAT") == cfg.parked_status, F.lit(True)).otherwise(F.lit(False)),
        "IsBlockedInvoice": F.when(F.col("PaymentBlockKey_ZLSPR") > F.lit(" "), F.lit(True)).otherwise(F.lit(False)),
    }
    out.update(_kpi(vendor & (today > due) & is_open, L, D, T, "OverdueAmount"))
    out.update(_kpi(vendor & (today <= due) & is_open, L, D, T, "OutstandingButNotOverdue"))
    out.update(_kpi(vendor & (F.col("PostingDateInTheDocument_BUDAT") < today) & (due < today) & is_open,
                    L, D, T, "OverdueOnPastDate"))
    out.update(_kpi(F.col("FollowOnDocumentType_REBZT") == cfg.partial_payment_type, L, D, T, "PartialPayments"))
    out.update(_kpi(late, L, D, T, "LatePayments"))
    out.update(_kpi(vendor & due.between(today, F.date_add(today, cfg.upcoming_payment_days)) & is_open,
                    L, D, T, "UpcomingPayments"))
    # the exact product is dear, and most lines are not late or have no penalty
    out.update({
        f"PotentialPenaltyIn{suffix}Currency": F.when(
            late, F.when(penalty != 0, exact_product(v, penalty)).when(v.isNotNull(), zero())).otherwise(zero())
        for suffix, v in (("Local", L), ("Document", D), ("Target", T))
    })
    material = koart == cfg.material_account_type
    receipt = material & bwart.isin(*cfg.receipt_movements)
    reversal = material & bwart.isin(*cfg.reversal_movements)
    for suffix, v in (("Local", L), ("Document", D), ("Target", T)):
        out[f"PurchaseIn{suffix}Currency"] = F.when(receipt, v).when(reversal, -v).otherwise(zero())
    out.update(_kpi(F.col("AccountingDocumenttype_BLART").isin(*cfg.cash_discount_doc_types)
                    & (F.col("TransactionKey_KTOSL") == cfg.cash_discount_transaction_key), L, D, T,
                    "CashDiscountReceived"))
    invoice_31 = F.col("PostingKey_BSCHL") == cfg.vendor_invoice_posting_key
    skfbt = F.col("AmountEligibleForCashDiscountInDocumentCurrency_SKFBT").cast(AMOUNT)
    pct = F.col("CashDiscountPercentage1_ZBD1P").cast("decimal(5,3)")
    skfbt_target = (skfbt * rate).cast("decimal(32,9)")
    percent = F.lit("0.01").cast("decimal(2,2)")
    out["TargetCashDiscountInSourceCurrency"] = F.when(
        invoice_31, ((skfbt * pct).cast("decimal(35,9)") * percent).cast(NUMERIC)
    ).otherwise(zero())
    out["TargetCashDiscountInTargetCurrency"] = F.when(
        invoice_31, ((skfbt_target * pct).cast("decimal(35,9)") * percent).cast(NUMERIC)
    ).otherwise(zero())
    out.update(_kpi(vendor & is_open & ~F.coalesce(prefix2.isin(*cfg.payment_doc_prefixes), F.lit(True)),
                    L, D, T, "AmountOfOpenDebitItems"))
    ret = bwart == cfg.return_movement
    menge = F.col("__p_menge").cast("decimal(13,3)")
    po_l = F.col("__p_dmbtr").cast(AMOUNT)
    po_d = F.col("__p_wrbtr").cast(AMOUNT)
    for suffix, v in (("Local", po_l), ("Document", po_d), ("Target", po_d * rate)):
        out[f"AmountOfReturnIn{suffix}Currency"] = F.when(ret, exact_product(v, menge)).otherwise(zero())
    return out


def _safe_int(c: Column) -> Column:
    """SAFE_CAST(string AS INT64): an optionally signed run of digits, or of
    hexadecimal digits after ``0x``; else, or out of range, NULL."""
    trimmed = F.trim(c)
    digits = F.regexp_extract(trimmed, r"^[+-]?0[xX]0*([0-9a-fA-F]{1,16})$", 1)
    sign = F.when(F.startswith(trimmed, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    return F.when(trimmed.rlike(r"^[+-]?[0-9]+$"), trimmed.try_cast("bigint")).when(
        digits != "", F.concat(sign, F.conv(digits, 16, 10)).try_cast("bigint"))


def measure_inputs() -> dict[str, Column]:
    """Row values the KPI families share: the three amounts as NUMERIC."""
    d_amt = F.col("AmountInDocumentCurrency_WRBTR").cast(AMOUNT)
    return {
        "__L": F.col("AmountInLocalCurrency_DMBTR").cast(AMOUNT).cast(NUMERIC),
        "__D": d_amt.cast(NUMERIC),
        "__T": (d_amt * F.col("ExchangeRate_UKURS").cast(RATE)).cast(NUMERIC),
    }


def accounts_payable(enriched: DataFrame, cfg: LedgerConfig) -> DataFrame:
    out = enriched.withColumns(measure_inputs()).withColumns(measures(cfg))
    casts = {
        "AmountInLocalCurrency_DMBTR": NUMERIC,
        "AmountInDocumentCurrency_WRBTR": NUMERIC,
        "ExchangeRate_UKURS": NUMERIC,
    }
    return out.select(*[(F.col(c).cast(casts[c]) if c in casts else F.col(c)).alias(c) for c in OUTPUT_COLUMNS])
