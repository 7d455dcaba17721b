"""Business-day calendar against a brute-force statement of the procedure,
with random holidays including long runs across year ends."""

import dataclasses
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from payledger.config import LedgerConfig
from payledger.plans.calendar import business_days

START, END = dt.date(2000, 11, 1), dt.date(2002, 2, 28)


def brute(holidays, mode):
    hol = set(holidays)

    def is_bd(d):
        return d.isoweekday() < 6 and d not in hol

    rows, d = [], START
    while d <= END:
        nxt = next((d + dt.timedelta(days=k) for k in range(1, 31) if is_bd(d + dt.timedelta(days=k))), None)
        if nxt is not None:
            rows.append([d, is_bd(d), None, nxt])
        d += dt.timedelta(days=1)
    for i, r in enumerate(rows):
        if mode == "calendar":
            r[2] = rows[i - 1][0] if i else None
        else:
            prev = [x[0] for x in rows[:i] if x[1]]
            r[2] = prev[-1] if prev else None
    return [tuple(r) for r in rows]


runs = st.lists(st.tuples(st.dates(dt.date(2000, 10, 1), dt.date(2002, 2, 1)), st.integers(1, 45)), max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(runs, st.sampled_from(["calendar", "business"]))
def test_business_days_match_brute_force(spark, holiday_runs, mode):
    days = sorted({s + dt.timedelta(days=i) for s, n in holiday_runs for i in range(n)})
    hol = spark.createDataFrame([(d,) for d in days], "HolidayDate date")
    cfg = dataclasses.replace(LedgerConfig(as_of=dt.date(2001, 6, 30)), previous_day_mode=mode)
    got = sorted(tuple(r) for r in business_days(spark, hol, START, END, cfg).collect())
    assert got == brute(days, mode)
