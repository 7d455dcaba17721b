"""Calendar dimension, business days (traps Q1, dropped dates) and upsert."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import d
from payledger.config import LedgerConfig
from payledger.operators.upsert import DuplicateKeyError, upsert
from payledger.plans import calendar as C

CFG = LedgerConfig(as_of=dt.date(2001, 6, 30))


def _holidays(spark, days):
    return spark.createDataFrame([(d(x),) for x in days], "HolidayDate date")


def test_calendar_dim_has_47_attributes_and_iso_weeks(spark):
    cal = C.calendar_date_dim(spark, d("2000-12-30"), d("2001-01-02"))
    assert len(cal.columns) == 47
    rows = {r.Date: r for r in cal.collect()}
    sunday = rows[d("2000-12-31")]
    assert (sunday.DayOfWeek, sunday.IsWeekEnd, sunday.CalWeek, sunday.YearWeek) == (1, True, 52, "2000/52")
    monday = rows[d("2001-01-01")]
    assert (monday.CalWeek, monday.IsFirstDayOfYear, monday.WeekStartDate, monday.DayOfQuarter) == (
        1, True, d("2001-01-01"), 1)
    assert rows[d("2000-12-31")].IsLastDayOfYear and rows[d("2000-12-31")].IsLeapYear


def test_business_days_next_and_previous(spark):
    bd = C.business_days(spark, _holidays(spark, ["2001-01-01"]), d("2000-12-29"), d("2001-01-03"), CFG)
    rows = {r.date: r for r in bd.collect()}
    fri = rows[d("2000-12-29")]
    assert fri.is_business_day and fri.next_business_day == d("2001-01-02")
    assert not rows[d("2001-01-01")].is_business_day            # holiday
    assert rows[d("2000-12-30")].next_business_day == d("2001-01-02")
    # Q1: previous is the previous generated date, and NULL on the first date
    assert rows[d("2000-12-29")].previous_business_day is None
    assert rows[d("2001-01-02")].previous_business_day == d("2001-01-01")


def test_business_mode_previous_business_day(spark):
    cfg = dataclasses.replace(CFG, previous_day_mode="business")
    bd = C.business_days(spark, _holidays(spark, ["2001-01-01"]), d("2000-12-28"), d("2001-01-03"), cfg)
    rows = {r.date: r for r in bd.collect()}
    assert rows[d("2001-01-02")].previous_business_day == d("2000-12-29")


def test_dates_without_business_day_within_horizon_are_dropped(spark):
    run = [(dt.date(2001, 3, 1) + dt.timedelta(days=i)).isoformat() for i in range(40)]
    bd = C.business_days(spark, _holidays(spark, run), d("2001-02-20"), d("2001-04-30"), CFG)
    rows = {r.date: r for r in bd.collect()}
    # holidays 03-01 .. 04-09: a date keeps its row only with a business day in the next 30 days
    assert d("2001-02-27") in rows and rows[d("2001-02-27")].next_business_day == d("2001-02-28")
    assert d("2001-02-28") not in rows and d("2001-03-10") not in rows
    assert rows[d("2001-03-11")].next_business_day == d("2001-04-10")
    # the row after a dropped stretch points back to the last kept date (LAG over kept rows)
    assert rows[d("2001-03-11")].previous_business_day == d("2001-02-27")


def test_business_day_lookup_outside_range_is_null(spark):
    bd = C.business_days(spark, _holidays(spark, []), d("2001-01-01"), d("2001-01-10"), CFG)
    df = spark.createDataFrame([(d("2001-01-06"),), (d("2005-01-01"),)], "x date")
    out = C.add_next_business_day(df, bd, F.col("x"), "nxt", dataclasses.replace(
        CFG, calendar_start=d("2001-01-01"), calendar_end=d("2001-01-10")))
    got = {r.x: r.nxt for r in out.collect()}
    assert got == {d("2001-01-06"): d("2001-01-08"), d("2005-01-01"): None}


def test_upsert_replaces_inserts_and_keeps(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    out = sorted((r.k, r.v) for r in upsert(target, source, ["k"]).collect())
    assert out == [(1, "a"), (2, "B"), (3, "C")]
    again = sorted((r.k, r.v) for r in upsert(upsert(target, source, ["k"]), source, ["k"]).collect())
    assert again == out
    with pytest.raises(DuplicateKeyError):
        upsert(target, source.unionByName(source), ["k"], check_unique=True)
