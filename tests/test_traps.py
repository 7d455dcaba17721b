"""Semantic traps Q3, Q8, Q12, Q14, Q15, Q16 (the others are covered next to their operators)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from payledger.config import LedgerConfig
from payledger.plans import currency as C
from payledger.plans.masterdata import vendors_md
from payledger.plans.model import LedgerModel

CFG = LedgerConfig(as_of=dt.date(2001, 6, 30))


def _g(day):
    x = dt.date.fromisoformat(day)
    return str(99999999 - (x.year * 10000 + x.month * 100 + x.day))


def _rates(spark, rows, factors):
    return {
        "tcurr": spark.createDataFrame(
            [("100", k, f, t, _g(day), Decimal(r)) for k, f, t, day, r in rows],
            "mandt string, kurst string, fcurr string, tcurr string, gdatu string, ukurs decimal(14,5)"),
        "tcurf": spark.createDataFrame(
            [("100", k, f, t, _g(day), None, None) for k, f, t, day in factors],
            "mandt string, kurst string, fcurr string, tcurr string, gdatu string, ffact decimal(9,0), "
            "tfact decimal(9,0)"),
    }


def test_q3_same_currency_rate_rows_duplicate_identity(spark):
    t = _rates(spark, [("B", "BRL", "BRL", "2001-06-01", "1")], [("B", "BRL", "BRL", "1990-01-01")])
    daily = C.currency_conversion(t, CFG).where("conv_date = DATE '2001-06-15' AND fcurr = 'BRL' AND tcurr = 'BRL'")
    assert daily.count() == 2


def test_q15_identity_rate_needs_a_row_from_that_currency(spark):
    t = _rates(spark, [("B", "USD", "BRL", "2001-06-01", "5"), ("M", "BRL", "USD", "2001-06-01", "0.2")], [])
    ident = {(r.kurst, r.fcurr) for r in C.identity_rates(t, CFG).collect()}
    assert ("B", "USD") in ident and ("M", "BRL") in ident and ("B", "BRL") not in ident


def test_q16_vendor_without_address_drops_out(spark):
    tables = {
        "lfa1": spark.createDataFrame([("100", "V1", "A", "AD1"), ("100", "V2", "B", "AD2")],
                                      "mandt string, lifnr string, name1 string, adrnr string"),
        "adrc": spark.createDataFrame([("100", "AD1", dt.date(2000, 1, 1), dt.date(9999, 12, 31))],
                                      "client string, addrnumber string, date_from date, date_to date"),
    }
    got = [r.AccountNumberOfVendorOrCreditor_LIFNR for r in vendors_md(tables).collect()]
    assert got == ["V1"]


def test_q8_po_history_fans_out_lines(spark, erp, cfg):
    m = LedgerModel(spark, erp, cfg)
    assert m.accounts_payable.count() > m.accounting_invoices.count()
    keys = ["AccountingDocumentNumber_BELNR", "NumberOfLineItemWithinAccountingDocument_BUZEI", "FiscalYear_GJAHR"]
    fanned = m.accounts_payable.where("MovementType__inventoryManagement___BWART IS NOT NULL").groupBy(*keys).agg(
        F.countDistinct("MovementType__inventoryManagement___BWART").alias("n")).where("n > 1")
    assert fanned.count() > 0


def test_q12_parked_rows_have_no_due_date_measures(spark, erp, cfg):
    parked = LedgerModel(spark, erp, cfg).accounts_payable.where("IsParkedInvoice")
    assert parked.count() > 0
    assert parked.where("NetDueDate IS NOT NULL OR OverdueAmountInLocalCurrency <> 0 "
                        "OR LatePaymentsInLocalCurrency <> 0 OR PotentialPenaltyInLocalCurrency <> 0").count() == 0


def test_q14_names_resolve_case_insensitively(spark, erp, cfg):
    inv = LedgerModel(spark, erp, cfg).invoices
    assert inv.select("AmountInDocumentCurrency_WRBTR", "invstatus_rbstat").columns
