"""Document datasets: supplier invoices, purchase-order history, accounting documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StringType

from payledger.config import LedgerConfig
from payledger.functions.amounts import scale_amount, scale_amount_sql, sign_flip_columns
from payledger.functions.dates import cash_discount_date_1, cash_discount_date_2, net_due_date
from payledger.operators.joins import broadcast_if_small, lookup_left_join
from payledger.plans.calendar import add_calendar_attributes
from payledger.plans.currency import CurrencyFactors
from payledger.plans.masterdata import pick, pick_sql, unmapped_sql
from payledger.types import AMOUNT, RAW_AMOUNT, zero

CAL = ("CalYear", "CalMonth", "CalWeek", "CalQuarter")


def _calendar_names(kind: str, suffix: str) -> dict[str, str]:
    words = {"CalYear": "Year", "CalMonth": "Month", "CalWeek": "Week", "CalQuarter": "Quarter"}
    return {a: f"{words[a]}Of{kind}_{suffix}" for a in CAL}


def _with_calendar(df, calendar, cfg, date_col, kind, suffix):
    return add_calendar_attributes(
        df, calendar, date_col, _calendar_names(kind, suffix), cfg.broadcast_bytes,
        cfg.calendar_start, cfg.calendar_end,
    )


def _currency_factor(df: DataFrame, decimals: DataFrame | CurrencyFactors, on: Column, out: str, limit: int) -> DataFrame:
    """The factor of a currency as ``out``: an expression when the currency table
    is given as values, else a left join (broadcast after a size check)."""
    if isinstance(decimals, CurrencyFactors):
        return df.withColumn(out, decimals.of(on))
    dec = decimals.select(F.col("CURRKEY").alias(f"{out}_key"), F.col("CURRFIX").alias(out))
    salt = df.columns[:5]
    return lookup_left_join(df, dec, [(on, f"{out}_key")], salt, limit).drop(f"{out}_key")


# ------------------------------------------------------------------ invoices

# Fixed values: (field of the joined invoice line, business name) for the
# invoice-flow columns kept; "h." is the header (RBKP), "l." the merged line.
INVOICE_NAMES = [
    ("h.mandt", "Client_MANDT"),
    ("h.gjahr", "FiscalYear_GJAHR"),
    ("h.belnr", "InvoiceDocNum_BELNR"),
    ("l.buzei", "InvoiceDocLineNum_BUZEI"),
    ("l.cobl_nr", "InvoiceDocAssignmentNum_COBL_NR"),
    ("h.blart", "Documenttype_BLART"),
    ("h.bldat", "DocumentDate_BLDAT"),
    ("h.budat", "PostingDate_BUDAT"),
    ("h.lifnr", "InvoicingParty_LIFNR"),
    ("h.waers", "Currency_WAERS"),
    ("h.rmwwr", "GrossInvAmnt_RMWWR"),
    ("h.rbstat", "Invstatus_RBSTAT"),
    ("l.ebeln", "PoNum_EBELN"),
    ("l.ebelp", "PoLineNum_EBELP"),
    ("l.zekkn", "PoAssignmentNum_ZEKKN"),
    ("l.bnkan", "DeliveryCostsItemSplit_BNKAN"),
    ("l.lifnr", "AccountNumber_LIFNR"),
    ("l.ps_psp_pnr", "WbsElement_PS_PSP_PNR"),
    ("l.koart", "Accounttype_KOART"),
    ("l.werks", "Plant_WERKS"),
    ("l.shkzg", "DebitCreditIndicator_SHKZG"),
    ("l.menge", "Quantity_MENGE"),
]
# Invoice amounts fixed by the document-currency factor.
INVOICE_SCALED = [
    ("rbwwr", "InvoiceAmountinDocumentCurrencyofSupplierInvoice_RBWWR"),
    ("retamt_fc", "RetentionAmount_RETAMT_FC"),
    ("diff_amount", "DifferenceAmount_DIFF_AMOUNT"),
    ("bnkan_fw", "DeliveryCostsDistributionAmount_BNKAN_FW"),
    ("fwbas", "TaxBaseAmount_FWBAS"),
    ("wrbtr", "AmountinDocumentCurrency_WRBTR"),
]
LINE_KEYS = ["belnr", "buzei", "gjahr", "mandt"]
# Fields both line tables share, merged with RSEG first.
MERGED_LINE_FIELDS = ["zekkn", "bukrs", "werks", "wrbtr", "shkzg", "mwskz", "txjcd", "menge", "bpmng",
                      "meins", "spgrs", "sgtxt", "xskrl"]
RSEG_ONLY = ["ebeln", "ebelp", "bnkan", "rbwwr", "lifnr", "retamt_fc", "diff_amount"]
RBCO_ONLY = ["cobl_nr", "gsber", "ps_psp_pnr", "bnkan_fw", "fwbas", "koart"]

_TYPES = {"menge": DecimalType(13, 3), "bpmng": DecimalType(13, 3)}
_AMOUNT_FIELDS = {"wrbtr", "bnkan", "rbwwr", "retamt_fc", "diff_amount", "bnkan_fw", "fwbas", "rmwwr"}


def _t(field: str):
    if field in _AMOUNT_FIELDS:
        return RAW_AMOUNT
    return _TYPES.get(field, StringType())


# The line fields that the payable fact needs of the invoice flow.
PAYABLE_LINE_FIELDS = ["bukrs", "wrbtr", "ps_psp_pnr"]
# Join keys: document numbers first. Rows are sorted by the first bytes of the first key, and
# compared field by field only where these agree (few clients and companies hold all rows).
HEADER_KEYS = ["belnr", "gjahr", "mandt"]


def invoice_lines(tables: Mapping[str, DataFrame], headers: DataFrame | None = None, passthrough: bool = False,
                  limit: int = 64 << 20, fields: Sequence[str] | None = None) -> DataFrame:
    """Invoice lines (RSEG) FULL OUTER JOIN account assignments (RBCO), with
    debit/credit applied to their amounts and shared fields merged.

    ``headers`` (mandt, belnr, gjahr) restricts both sides *before* the full
    join. Exact for a later inner join with those headers: a matched pair has
    equal keys on both sides, an unmatched row keeps its own keys. ``fields``
    names the fields to keep besides the line keys (default: all).
    """
    rseg = sign_flip_columns(tables["rseg"], ["wrbtr", "bnkan"])
    rbco = sign_flip_columns(tables["rbco"], ["wrbtr", "bnkan_fw"])
    if headers is not None:
        # usually few (parked invoices): broadcast after a size check
        keys = broadcast_if_small(headers.select("mandt", "belnr", "gjahr").distinct(), limit)
        rseg = rseg.join(keys, ["mandt", "belnr", "gjahr"], "left_semi")
        rbco = rbco.join(keys, ["mandt", "belnr", "gjahr"], "left_semi")
    s, c = rseg.alias("s"), rbco.alias("c")
    joined = s.join(c, [F.col(f"s.{k}") == F.col(f"c.{k}") for k in LINE_KEYS], "full")
    cols = [F.coalesce(pick(rseg, k, prefix="s"), pick(rbco, k, prefix="c")).alias(k) for k in LINE_KEYS]
    cols += [
        F.coalesce(pick(rseg, f, _t(f), "s"), pick(rbco, f, _t(f), "c")).alias(f) for f in _kept(MERGED_LINE_FIELDS, fields)
    ]
    cols += [pick(rseg, f, _t(f), "s").alias(f) for f in _kept(RSEG_ONLY, fields)]
    cols += [pick(rbco, f, _t(f), "c").alias(f) for f in _kept(RBCO_ONLY, fields)]
    if passthrough:
        # every other replicated field, under its upper-case code; a field of
        # both tables takes the line (RSEG) value first, like the merged keys
        known = {f.lower() for f in LINE_KEYS + MERGED_LINE_FIELDS + RSEG_ONLY + RBCO_ONLY}
        s_cols = {c.lower(): c for c in rseg.columns if c.lower() not in known}
        c_cols = {c.lower(): c for c in rbco.columns if c.lower() not in known}
        for f in sorted(set(s_cols) | set(c_cols)):
            parts = ([F.col(f"s.`{s_cols[f]}`")] if f in s_cols else []) + ([F.col(f"c.`{c_cols[f]}`")] if f in c_cols else [])
            cols.append((F.coalesce(*parts) if len(parts) > 1 else parts[0]).alias(f"__pt_{f.upper()}"))
    return joined.select(*cols)


def _kept(names: Sequence[str], fields: Sequence[str] | None) -> list[str]:
    return [n for n in names if fields is None or n in fields]


def invoice_documents_flow(
    tables: Mapping[str, DataFrame], decimals: DataFrame | CurrencyFactors, calendar: DataFrame | None, cfg: LedgerConfig,
    header_filter: Column | None = None, passthrough: bool = False, lines: DataFrame | None = None,
) -> DataFrame:
    """Supplier invoices at line level: merged lines INNER JOIN headers (RBKP),
    WBS element, document-currency decimal fix and calendar attributes.

    ``header_filter`` (a condition on RBKP columns) limits the flow to those
    invoices, and is applied to the lines before their full outer join. ``lines``
    gives lines that are merged already (stored ones); fields they lack are NULL.
    """
    rbkp = tables["rbkp"]
    if header_filter is not None:
        rbkp = rbkp.where(header_filter)
    if lines is None:
        lines = invoice_lines(tables, rbkp if header_filter is not None else None, passthrough, cfg.broadcast_bytes)
    lines = lines.alias("l")
    hdr = rbkp.alias("h")
    df = lines.join(hdr, [F.col(f"l.{k}") == F.col(f"h.{k}") for k in HEADER_KEYS], "inner")
    df = df.select(
        *[pick(rbkp if s.startswith("h.") else lines, s[2:], _t(s[2:]), s[0]).alias(t) for s, t in INVOICE_NAMES],
        F.coalesce(pick(rbkp, "bukrs", prefix="h"), F.col("l.bukrs")).alias("CompanyCode_BUKRS"),
        F.coalesce(pick(rbkp, "gsber", prefix="h"), pick(lines, "gsber", prefix="l")).alias("BusinessArea_GSBER"),
        *[pick(lines, f, _t(f), "l").alias(f"__amt_{f}") for f, _ in INVOICE_SCALED],
        *_invoice_passthrough(lines, rbkp, passthrough),
    )
    prps = tables["prps"].select(F.col("pspnr").alias("__pspnr"), F.col("posid").alias("WbsElement_POSID"))
    df = lookup_left_join(
        df, prps, [(F.col("WbsElement_PS_PSP_PNR"), "__pspnr")],
        ["InvoiceDocNum_BELNR", "InvoiceDocLineNum_BUZEI"], cfg.broadcast_bytes,
    ).drop("__pspnr")
    df = _currency_factor(df, decimals, F.col("Currency_WAERS"), "__fix", cfg.broadcast_bytes)
    df = _with_calendar(df, calendar, cfg, "PostingDate_BUDAT", "PostingDate", "BUDAT")
    df = _with_calendar(df, calendar, cfg, "DocumentDate_BLDAT", "DocumentDate", "BLDAT")
    df = df.withColumns({t: scale_amount(F.col(f"__amt_{f}"), F.col("__fix")) for f, t in INVOICE_SCALED})
    return df.drop("__fix", *[f"__amt_{f}" for f, _ in INVOICE_SCALED])


def _invoice_passthrough(lines: DataFrame, rbkp: DataFrame, on: bool) -> list[Column]:
    """Unnamed header fields (upper-case code) and the lines' pass-through fields."""
    if not on:
        return []
    named = {s[2:].lower() for s, _ in INVOICE_NAMES if s.startswith("h.")} | {"bukrs", "gsber"}
    taken = {t.lower() for _, t in INVOICE_NAMES}
    out, seen = [], set()
    for c in lines.columns:
        if c.startswith("__pt_"):
            seen.add(c[5:].lower())
            out.append(F.col(f"l.`{c}`").alias(c[5:]))
    for c in rbkp.columns:
        if c.lower() not in named and c.lower() not in seen and c.upper().lower() not in taken:
            out.append(F.col(f"h.`{c}`").alias(c.upper()))
    return out


# -------------------------------------------------------- purchase history

# Business names of the purchase-order history fields kept.
PO_HISTORY_NAMES = [
    ("mandt", "Client_MANDT"),
    ("ebeln", "PurchasingDocumentNumber_EBELN"),
    ("ebelp", "ItemNumberOfPurchasingDocument_EBELP"),
    ("zekkn", "SequentialNumberOfAccountAssignment_ZEKKN"),
    ("vgabe", "TransactioneventType_VGABE"),
    ("gjahr", "MaterialDocumentYear_GJAHR"),
    ("belnr", "NumberOfMaterialDocument_BELNR"),
    ("buzei", "ItemInMaterialDocument_BUZEI"),
    ("bewtp", "PurchaseOrderHistoryCategory_BEWTP"),
    ("bwart", "MovementType__inventoryManagement___BWART"),
    ("budat", "PostingDateInTheDocument_BUDAT"),
    ("menge", "Quantity_MENGE"),
    ("bpmng", "QuantityInPurchaseOrderPriceUnit_BPMNG"),
    ("waers", "CurrencyKey_WAERS"),
    ("bldat", "DocumentDateInDocument_BLDAT"),
]


def purchase_documents_history(
    tables: Mapping[str, DataFrame], decimals: DataFrame | CurrencyFactors, calendar: DataFrame, cfg: LedgerConfig
) -> DataFrame:
    """Goods and invoice receipts of purchase orders (event types 1 and 2)."""
    ekbe = tables["ekbe"]
    types = {"budat": DateType(), "bldat": DateType(), "menge": DecimalType(13, 3), "bpmng": DecimalType(13, 3)}
    df = ekbe.where(F.col("vgabe").isin(*cfg.po_history_event_types)).select(
        *[pick(ekbe, s, types.get(s, StringType())).alias(t) for s, t in PO_HISTORY_NAMES],
        pick(ekbe, "dmbtr", RAW_AMOUNT).alias("__dmbtr"),
        pick(ekbe, "wrbtr", RAW_AMOUNT).alias("__wrbtr"),
    )
    df = _currency_factor(df, decimals, F.col("CurrencyKey_WAERS"), "__fix", cfg.broadcast_bytes)
    df = _with_calendar(df, calendar, cfg, "PostingDateInTheDocument_BUDAT", "PostingDateInTheDocument", "BUDAT")
    df = _with_calendar(df, calendar, cfg, "DocumentDateInDocument_BLDAT", "DocumentDateInDocument", "BLDAT")
    return df.withColumns({
        "AmountInLocalCurrency_DMBTR": scale_amount(F.col("__dmbtr"), F.col("__fix")),
        "AmountInDocumentCurrency_WRBTR": scale_amount(F.col("__wrbtr"), F.col("__fix")),
    }).drop("__fix", "__dmbtr", "__wrbtr")


# ------------------------------------------------------ accounting documents

# The 57 line-item amounts, their currency role and business
# name. Roles: doc = BKPF.WAERS, local = HWAER, local2 = HWAE2,
# local3 = HWAE3, gl = BSEG.PSWSL, none = sign flip only (no decimal fix).
LINE_AMOUNTS = [
    ("DMBTR", "local", "AmountInLocalCurrency_DMBTR"),
    ("WRBTR", "doc", "AmountInDocumentCurrency_WRBTR"),
    ("KZBTR", "local", "OriginalReductionAmountInLocalCurrency_KZBTR"),
    ("PSWBT", "gl", "AmountForUpdatingInGeneralLedger_PSWBT"),
    ("TXBHW", "local", "OriginalTaxBaseAmountInLocalCurrency_TXBHW"),
    ("TXBFW", "doc", "OriginalTaxBaseAmountInDocumentCurrency_TXBFW"),
    ("MWSTS", "local", "TaxAmountInLocalCurrency_MWSTS"),
    ("WMWST", "doc", "TaxAmountInDocumentCurrency_WMWST"),
    ("HWBAS", "local", "TaxBaseAmountInLocalCurrency_HWBAS"),
    ("FWBAS", "doc", "TaxBaseAmountInDocumentCurrency_FWBAS"),
    ("HWZUZ", "local", "ProvisionAmountInLocalCurrency_HWZUZ"),
    ("QSSHB", "doc", "WithholdingTaxBaseAmount_QSSHB"),
    ("GBETR", "local", "HedgedAmountInForeignCurrency_GBETR"),
    ("SKFBT", "doc", "AmountEligibleForCashDiscountInDocumentCurrency_SKFBT"),
    ("SKNTO", "local", "CashDiscountAmountInLocalCurrency_SKNTO"),
    ("WSKTO", "doc", "CashDiscountAmountInDocumentCurrency_WSKTO"),
    ("NEBTR", "doc", "NetPaymentAmount_NEBTR"),
    ("DMBT1", "local", "AmountInLocalCurrencyForTaxDistribution_DMBT1"),
    ("WRBT1", "local", "AmountInForeignCurrencyForTaxBreakdown_WRBT1"),
    ("DMBT2", "local2", "AmountInLocalCurrencyForTaxDistribution_DMBT2"),
    ("WRBT2", "local2", "AmountInForeignCurrencyForTaxBreakdown_WRBT2"),
    ("DMBT3", "local3", "AmountInLocalCurrencyForTaxDistribution_DMBT3"),
    ("WRBT3", "local3", "AmountInForeignCurrencyForTaxBreakdown_WRBT3"),
    ("KLIBT", "local", "CreditControlAmount_KLIBT"),
    ("QBSHB", "doc", "WithholdingTaxAmount__inDocumentCurrency___QBSHB"),
    ("QSFBT", "doc", "WithholdingTaxExemptAmount_QSFBT"),
    ("BONFB", "local", "AmountQualifyingForBonusInLocalCurrency_BONFB"),
    ("DMBE2", "local2", "AmountInSecondLocalCurrency_DMBE2"),
    ("DMBE3", "local3", "AmountInThirdLocalCurrency_DMBE3"),
    ("DMB21", "local2", "AmountInSecondLocalCurrencyForTaxBreakdown_DMB21"),
    ("DMB22", "local2", "AmountInSecondLocalCurrencyForTaxBreakdown_DMB22"),
    ("DMB23", "local2", "AmountInSecondLocalCurrencyForTaxBreakdown_DMB23"),
    ("DMB31", "local3", "AmountInThirdLocalCurrencyForTaxBreakdown_DMB31"),
    ("DMB32", "local3", "AmountInThirdLocalCurrencyForTaxBreakdown_DMB32"),
    ("DMB33", "local3", "AmountInThirdLocalCurrencyForTaxBreakdown_DMB33"),
    ("MWST2", "local2", "TaxAmountInSecondLocalCurrency_MWST2"),
    ("MWST3", "local3", "TaxAmountInThirdLocalCurrency_MWST3"),
    ("NAVH2", "local2", "NonDeductibleInputTaxInSecondLocalCurrency_NAVH2"),
    ("NAVH3", "local3", "NonDeductibleInputTaxInThirdLocalCurrency_NAVH3"),
    ("SKNT2", "local2", "CashDiscountAmountInSecondLocalCurrency_SKNT2"),
    ("SKNT3", "local3", "CashDiscountAmountInThirdLocalCurrency_SKNT3"),
    ("STTAX", "doc", "TaxAmountAsStatisticalInformationInDocumentCurrency_STTAX"),
    ("PENLC1", "local", "PenaltyChargeAmountInFirstLocalCurrency_PENLC1"),
    ("PENLC2", "local2", "PenaltyChargeAmountInSecondLocalCurrency_PENLC2"),
    ("PENLC3", "local3", "PenaltyChargeAmountInThirdLocalCurrency_PENLC3"),
    ("PENFC", "doc", "PenaltyChargeAmountInDocumentCurrency_PENFC"),
    ("FWZUZ", "none", "AdditionalTaxInDocumentCurrency_FWZUZ"),
    ("BDIF2", "none", "ValuationDifferenceForTheSecondLocalCurrency_BDIF2"),
    ("FDWBT", "none", "PlannedAmountInDocumentOrGlAccountCurrency_FDWBT"),
    ("BLNBT", "none", "BaseAmountForDeterminingThePreferenceAmount_BLNBT"),
    ("REWRT", "none", "InvoiceValueEntered_inLocalCurrency_REWRT"),
    ("REWWR", "none", "InvoiceValueInForeignCurrency_REWWR"),
    ("BDIF3", "none", "ValuationDifferenceForTheThirdLocalCurrency_BDIF3"),
    ("RDIF3", "none", "ExchangeRateDifferenceRealizedForThirdLocalCurrency_RDIF3"),
    ("TXBH2", "none", "TaxBaseoriginalTaxBaseInSecondLocalCurrency_TXBH2"),
    ("TXBH3", "none", "TaxBaseoriginalTaxBaseInThirdLocalCurrency_TXBH3"),
    ("PYAMT", "none", "AmountInPaymentCurrency_PYAMT"),
]

# Header (BKPF) and line (BSEG) attributes kept, with business names.
HEADER_NAMES = [
    ("MANDT", "Client_MANDT"),
    ("BUKRS", "CompanyCode_BUKRS"),
    ("BELNR", "AccountingDocumentNumber_BELNR"),
    ("GJAHR", "FiscalYear_GJAHR"),
    ("BLART", "DocumentType_BLART"),
    ("BLDAT", "DocumentDateInDocument_BLDAT"),
    ("BUDAT", "PostingDateInTheDocument_BUDAT"),
    ("MONAT", "FiscalPeriod_MONAT"),
    ("WAERS", "CurrencyKey_WAERS"),
    ("AWKEY", "ObjectKey_AWKEY"),
    ("HWAER", "LocalCurrency_HWAER"),
    ("HWAE2", "CurrencyKeyOfSecondLocalCurrency_HWAE2"),
    ("HWAE3", "CurrencyKeyOfThirdLocalCurrency_HWAE3"),
]
LINE_NAMES = [
    ("BUZEI", "NumberOfLineItemWithinAccountingDocument_BUZEI"),
    ("AUGDT", "ClearingDate_AUGDT"),
    ("AUGBL", "DocumentNumberOfTheClearingDocument_AUGBL"),
    ("BSCHL", "PostingKey_BSCHL"),
    ("KOART", "AccountType_KOART"),
    ("UMSKZ", "SpecialGlIndicator_UMSKZ"),
    ("SHKZG", "DebitcreditIndicator_SHKZG"),
    ("PSWSL", "UpdateCurrencyForGeneralLedgerTransactionFigures_PSWSL"),
    ("KTOSL", "TransactionKey_KTOSL"),
    ("XUMSW", "Indicator_SalesRelatedItem_XUMSW"),
    ("KUNNR", "CustomerNumber_KUNNR"),
    ("LIFNR", "AccountNumberOfVendorOrCreditor_LIFNR"),
    ("ZFBDT", "BaselineDateForDueDateCalculation_ZFBDT"),
    ("ZTERM", "TermsOfPaymentKey_ZTERM"),
    ("ZBD1T", "CashDiscountDays1_ZBD1T"),
    ("ZBD2T", "CashDiscountDays2_ZBD2T"),
    ("ZBD3T", "NetPaymentTermsPeriod_ZBD3T"),
    ("ZBD1P", "CashDiscountPercentage1_ZBD1P"),
    ("ZLSPR", "PaymentBlockKey_ZLSPR"),
    ("REBZG", "InvoiceToWhichTheTransactionBelongs_REBZG"),
    ("REBZT", "FollowOnDocumentType_REBZT"),
    ("LANDL", "SupplyingCountry_LANDL"),
    ("EBELN", "PurchasingDocumentNumber_EBELN"),
    ("EBELP", "ItemNumberOfPurchasingDocument_EBELP"),
    ("RSTGR", "ReasonCodeForPayments_RSTGR"),
]
_LINE_TYPES = {
    "augdt": DateType(), "zfbdt": DateType(), "bldat": DateType(), "budat": DateType(),
    "zbd1t": DecimalType(3, 0), "zbd2t": DecimalType(3, 0), "zbd3t": DecimalType(3, 0), "zbd1p": DecimalType(5, 3),
}
ROLE_CURRENCY = {"doc": "h.WAERS", "local": "h.HWAER", "local2": "h.HWAE2", "local3": "h.HWAE3", "gl": "b.PSWSL"}

DOC_KEYS = ["BELNR", "GJAHR", "BUKRS", "MANDT"]


def accounting_documents(
    tables: Mapping[str, DataFrame], decimals: DataFrame | CurrencyFactors, calendar: DataFrame, cfg: LedgerConfig,
    amount_roles: Sequence[str] = ("doc", "local", "local2", "local3", "gl", "none"),
    passthrough: bool = False,
) -> DataFrame:
    """Accounting line items (BSEG) INNER JOIN headers (BKPF), amounts signed
    by debit/credit and fixed per currency role, plus receivable measures.
    ``passthrough`` also carries every other BSEG / BKPF field under its code."""
    bseg, bkpf = tables["bseg"], tables["bkpf"]
    flips = [code for code, _, _ in LINE_AMOUNTS]
    b = sign_flip_columns(bseg, flips).alias("b")
    h = bkpf.alias("h")
    df = b.join(h, [pick(bseg, k, prefix="b") == pick(bkpf, k, prefix="h") for k in DOC_KEYS], "inner")

    def line(f):
        return pick_sql(bseg, f, _LINE_TYPES.get(f.lower(), StringType()), "b")

    def head(f):
        return pick_sql(bkpf, f, _LINE_TYPES.get(f.lower(), StringType()), "h")

    cols = [f"{head(s)} AS `{t}`" for s, t in HEADER_NAMES[:4]]
    cols += [f"{line(s)} AS `{t}`" for s, t in LINE_NAMES[:1]]
    cols += [f"{head(s)} AS `{t}`" for s, t in HEADER_NAMES[4:]]
    cols += [f"{line(s)} AS `{t}`" for s, t in LINE_NAMES[1:]]
    kept = [a for a in LINE_AMOUNTS if a[1] in amount_roles]
    cols += [f"{pick_sql(bseg, code, RAW_AMOUNT, 'b')} AS `__raw_{code}`" for code, _, _ in kept]
    currencies = {
        role: (head(ROLE_CURRENCY[role][2:]) if ROLE_CURRENCY[role].startswith("h.") else line(ROLE_CURRENCY[role][2:]))
        for role in ROLE_CURRENCY if role in amount_roles or role == "local"
    }
    if passthrough:
        named = [t for _, t in HEADER_NAMES + LINE_NAMES]
        amount_codes = [code for code, _, _ in LINE_AMOUNTS]
        extra = unmapped_sql(bseg, [s for s, _ in LINE_NAMES] + amount_codes + DOC_KEYS, named, "b")
        extra += unmapped_sql(bkpf, [s for s, _ in HEADER_NAMES], named + [e.rsplit(" AS ", 1)[1].strip("`")
                                                                         for e in extra], "h")
        cols += extra
    df = df.selectExpr(*cols, *[f"{src} AS `__cur_{role}`" for role, src in currencies.items()])

    for role in currencies:
        df = _currency_factor(df, decimals, F.col(f"__cur_{role}"), f"__fix_{role}", cfg.broadcast_bytes)
    df = _with_calendar(df, calendar, cfg, "PostingDateInTheDocument_BUDAT", "PostingDateInTheDocument", "BUDAT")
    df = _with_calendar(df, calendar, cfg, "DocumentDateInDocument_BLDAT", "DocumentDateInDocument", "BLDAT")

    amounts = [
        f"CAST(`__raw_{code}` AS {AMOUNT.simpleString()}) AS `{name}`" if role == "none"
        else scale_amount_sql(f"__raw_{code}", f"__fix_{role}", name)
        for code, role, name in kept
    ]
    df = df.selectExpr("*", *amounts)
    df = df.withColumns(receivable_measures(cfg))
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def receivable_measures(cfg: LedgerConfig) -> dict[str, Column]:
    """M1-M12: amounts are the signed local amount (before the decimal fix,
    except the clearing-date amount); "open" means no clearing date."""
    today = cfg.today()
    dmbtr = F.col("__raw_DMBTR").cast(AMOUNT)
    scaled = F.col("AmountInLocalCurrency_DMBTR")
    augdt = F.col("ClearingDate_AUGDT")
    budat = F.col("PostingDateInTheDocument_BUDAT")
    koart = F.col("AccountType_KOART")
    args = [koart, F.col("BaselineDateForDueDateCalculation_ZFBDT"), F.col("DocumentDateInDocument_BLDAT"),
            F.col("DebitcreditIndicator_SHKZG"), F.col("InvoiceToWhichTheTransactionBelongs_REBZG"),
            F.col("NetPaymentTermsPeriod_ZBD3T"), F.col("CashDiscountDays2_ZBD2T"), F.col("CashDiscountDays1_ZBD1T")]
    net = net_due_date(*args, customer_type=cfg.customer_account_type)
    posted_before = budat < today
    ct = cfg.customer_account_type
    if cfg.arrear_mode == "today_minus_due":
        arrear = F.datediff(today, net)
    elif cfg.arrear_mode == "due_minus_today":
        arrear = F.datediff(net, today)
    else:
        raise ValueError(f"unknown arrear_mode {cfg.arrear_mode!r}")

    def amt(cond, value=dmbtr):
        return F.when(cond, value).otherwise(zero(AMOUNT))

    return {
        "WrittenOffAmount_DMBTR": amt(F.col("SpecialGlIndicator_UMSKZ") == "D"),
        "BadDebt_DMBTR": amt(F.col("SpecialGlIndicator_UMSKZ") == "D"),
        "AmountInLocalCurrencyClearingDate_DMBTR": amt(augdt.isNull(), scaled),
        "NetDueDateCalc": net,
        "Sk1DtCalc": cash_discount_date_1(*args, customer_type=ct),
        "Sk2DtCalc": cash_discount_date_2(*args, customer_type=ct),
        "OpenAndNotDue": amt(posted_before & (net > today) & augdt.isNull()),
        "ClearedAfterDueDate": amt(posted_before & (augdt > net) & augdt.isNotNull()),
        "ClearedOnOrBeforeDueDate": amt(posted_before & (augdt <= net) & augdt.isNotNull()),
        "OpenAndOverdue": amt(posted_before & (net < today) & augdt.isNull()),
        "DoubtfulReceivables": amt(posted_before & (arrear > cfg.doubtful_after_days) & augdt.isNull()),
        "DaysInArrear": arrear,
        "AccountsReceivable": amt((koart == ct) & augdt.isNull() & posted_before),
        "Sales": amt((koart == ct) & posted_before & (F.col("Indicator_SalesRelatedItem_XUMSW") == "X")),
    }
