"""Randomised check of the due-date rules against a plain-Python statement of them."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from payledger.functions import cash_discount_date_1, cash_discount_date_2, net_due_date

COLS = ("koart", "zfbdt", "bldat", "shkzg", "rebzg", "zbd3t", "zbd2t", "zbd1t")
SCHEMA = ("koart string, zfbdt date, bldat date, shkzg string, rebzg string, zbd3t decimal(3,0), "
          "zbd2t decimal(3,0), zbd1t decimal(3,0)")


def _days(x):
    return None if x is None else int(Decimal(x).quantize(Decimal(1), rounding=ROUND_HALF_UP))


def _add(d, n):
    return None if d is None or n is None else d + dt.timedelta(days=n)


def py_net(koart, zfbdt, bldat, shkzg, rebzg, zbd3t, zbd2t, zbd1t):
    is_d = koart == "D"
    base = bldat if (is_d and zfbdt is None) else zfbdt
    if is_d and shkzg == "H" and rebzg is None:
        days = 0
    elif is_d and zbd3t is not None:
        days = zbd3t
    elif is_d and zbd2t is not None:
        days = zbd2t
    elif is_d and zbd1t is not None:
        days = zbd1t
    elif zbd1t is None:
        days = 0
    else:
        days = None
    return _add(base, _days(days))


def py_sk1(*a):
    zfbdt, zbd2t, zbd1t = a[1], a[6], a[7]
    return _add(zfbdt, _days(zbd1t)) if (zbd1t is not None or zbd2t is not None) else py_net(*a)


def py_sk2(*a):
    zfbdt, zbd2t = a[1], a[6]
    return _add(zfbdt, _days(zbd2t)) if zbd2t is not None else py_net(*a)


dates = st.one_of(st.none(), st.dates(dt.date(1995, 1, 1), dt.date(2005, 12, 31)))
days = st.one_of(st.none(), st.integers(0, 120).map(Decimal))
rows = st.tuples(st.sampled_from(["D", "K", "M", None]), dates, dates, st.sampled_from(["S", "H", None]),
                 st.sampled_from([None, "0000000001"]), days, days, days)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(rows, min_size=20, max_size=60))
def test_due_dates_match_rule_statement(spark, batch):
    df = spark.createDataFrame(batch, SCHEMA)
    args = [F.col(c) for c in COLS]
    got = df.select(net_due_date(*args).alias("n"), cash_discount_date_1(*args).alias("s1"),
                    cash_discount_date_2(*args).alias("s2")).collect()
    for row, r in zip(batch, got):
        assert (r.n, r.s1, r.s2) == (py_net(*row), py_sk1(*row), py_sk2(*row)), row
