"""Date rules: inverted rate dates, due dates, fiscal period case 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gdatu_to_date(gdatu: Column) -> Column:
    """Rate tables store dates inverted: ``99999999 - yyyymmdd`` as a string."""
    return F.to_date((F.lit(99999999) - gdatu.cast("int")).cast("string"), "yyyyMMdd")


def days_to_int(days: Column) -> Column:
    """NUMERIC day counts become whole days rounding half away from zero."""
    return F.round(days, 0).cast("int")


def net_due_date(koart, zfbdt, bldat, shkzg, rebzg, zbd3t, zbd2t, zbd1t, customer_type: str = "D") -> Column:
    """Net due date of a line item.

    Baseline: the document date for customer lines without a baseline date,
    otherwise the baseline date. Days: 0 for customer credit memos without an
    invoice reference; the first of ZBD3T, ZBD2T, ZBD1T for customer lines;
    0 when ZBD1T is missing; otherwise no rule applies and the date is NULL.
    """
    is_customer = koart == F.lit(customer_type)
    base = F.when(is_customer & zfbdt.isNull(), bldat).otherwise(zfbdt)
    days = (
        F.when(is_customer & (shkzg == F.lit("H")) & rebzg.isNull(), F.lit(0).cast("decimal(3,0)"))
        .when(is_customer & zbd3t.isNotNull(), zbd3t)
        .when(is_customer & zbd2t.isNotNull(), zbd2t)
        .when(is_customer & zbd1t.isNotNull(), zbd1t)
        .when(zbd1t.isNull(), F.lit(0).cast("decimal(3,0)"))
    )
    return F.date_add(base, days_to_int(days))


def cash_discount_date_1(koart, zfbdt, bldat, shkzg, rebzg, zbd3t, zbd2t, zbd1t, customer_type: str = "D") -> Column:
    """First cash-discount date: baseline + ZBD1T when any discount term is set."""
    return F.when(
        zbd1t.isNotNull() | zbd2t.isNotNull(), F.date_add(zfbdt, days_to_int(zbd1t))
    ).otherwise(net_due_date(koart, zfbdt, bldat, shkzg, rebzg, zbd3t, zbd2t, zbd1t, customer_type))


def cash_discount_date_2(koart, zfbdt, bldat, shkzg, rebzg, zbd3t, zbd2t, zbd1t, customer_type: str = "D") -> Column:
    """Second cash-discount date: baseline + ZBD2T when it is set."""
    return F.when(
        zbd2t.isNotNull(), F.date_add(zfbdt, days_to_int(F.coalesce(zbd2t, F.lit(0))))
    ).otherwise(net_due_date(koart, zfbdt, bldat, shkzg, rebzg, zbd3t, zbd2t, zbd1t, customer_type))


def fiscal_case1(d: Column) -> Column:
    """Calendar-year variant: year followed by the month padded to 3 digits."""
    return F.concat(F.year(d).cast("string"), F.lpad(F.month(d).cast("string"), 3, "0"))
