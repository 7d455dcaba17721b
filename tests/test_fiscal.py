"""Fiscal-year variants and periods (cases 1-3, trap Q11, missing variant)."""

import contextlib
import io

import pytest

from conftest import d
from payledger.plans.fiscal import fiscal_period_lookup, variant_cases


def _t009(spark):
    return spark.createDataFrame(
        [("100", "V1", "X", None), ("100", "V2", None, "X"), ("100", "V3", None, None), ("100", "V4", "", "X"),
         ("100", "V5", "", "")],
        "mandt string, periv string, xkale string, xjabh string",
    )


def _t009b(spark):
    rows = [("100", "V2", "2001", "06", "30", "009", "0"), ("100", "V2", "2001", "07", "31", "010", "+1")]
    rows += [("100", "V3", "0000", "03", "31", "012", "0"), ("100", "V3", "0000", "09", "30", "006", "+1")]
    return spark.createDataFrame(rows, "mandt string, periv string, bdatj string, bumon string, butag string, "
                                       "poper string, reljr string")


def test_variant_cases(spark):
    got = {r.periv: r.fiscal_case for r in variant_cases(_t009(spark)).collect()}
    # Q11: an empty XKALE still counts as set (CASE1); both empty -> CASE3
    assert got == {"V1": "CASE1", "V2": "CASE2", "V3": "CASE3", "V4": "CASE1", "V5": "CASE3"}


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_fiscal_periods(spark, limit):
    keys = spark.createDataFrame(
        [("100", "V1", d("2001-06-15")), ("100", "V2", d("2001-07-02")), ("100", "V2", d("2001-08-02")),
         ("100", "V3", d("2001-05-20")), ("100", "V3", d("2001-10-01")), ("100", "NONE", d("2001-01-01"))],
        "mandt string, periv string, date date",
    )
    got = {(r.periv, r.date): r.fiscal_period for r in fiscal_period_lookup(keys, _t009(spark), _t009b(spark), limit).collect()}
    assert got[("V1", d("2001-06-15"))] == "2001006"
    assert got[("V2", d("2001-07-02"))] == "2002010"          # year + relative year, period of the month row
    assert got[("V2", d("2001-08-02"))] is None               # no row for the month
    assert got[("V3", d("2001-05-20"))] == "2002006"          # first period ending on/after the date
    assert got[("V3", d("2001-10-01"))] is None               # no period ends after it in that year
    assert got[("NONE", d("2001-01-01"))] is None             # variant without a T009 row


def test_large_period_table_keeps_variants_apart_by_year(spark):
    """With broadcasts off nothing is keyed by the variant alone but the one-row-a-year
    carry and the year-independent rows, and both forms give the same periods."""
    rows = [("100", "V3", str(y), f"{m:02d}", "28", f"{m:03d}", "0") for y in range(1990, 2010) for m in range(1, 13)]
    rows += [("100", "V3", "0000", f"{m:02d}", "15", f"{m:03d}", "+1") for m in range(1, 7)]
    t009b = spark.createDataFrame(rows, "mandt string, periv string, bdatj string, bumon string, butag string, poper string, reljr string")
    keys = spark.range(5000).selectExpr("'100' AS mandt", "'V3' AS periv", "date_add(DATE'1994-01-01', CAST(id AS INT)) AS date")
    small = fiscal_period_lookup(keys, _t009(spark), t009b)
    large = fiscal_period_lookup(keys, _t009(spark), t009b, 0)
    assert small.count() == 5000 and small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        large.explain()
    sizes = [x for x in buf.getvalue().splitlines() if "Window [min(label" in x]
    assert sizes and all("year" in x for x in sizes)
