"""Fiscal periods against correlated-subquery semantics, stated in Python."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from payledger.plans.fiscal import fiscal_period_lookup

T009 = [("100", "V1", "X", None), ("100", "V2", None, "X"), ("100", "V3", None, None)]


def py_period(periv, date, t009b):
    flags = {p: (k, j) for _, p, k, j in T009}
    if periv not in flags:
        return None
    xkale, xjabh = flags[periv]
    if len(xkale or "") + len(xjabh or "") == 0:
        case = 3
    elif xkale is not None:
        case = 1
    else:
        case = 2
    y = str(date.year)
    rows = [r for r in t009b if r[1] == periv]
    if case == 1:
        return f"{date.year}{date.month:03d}"
    if case == 2:
        hits = [str(int(b) + int(rel)) + pop for _, _, b, mon, _, pop, rel in rows if b == y and mon == f"{date.month:02d}"]
        return min(hits) if hits else None
    hits = []
    for _, _, b, mon, day, pop, rel in rows:
        eff = y if b == "0000" else b
        if eff + mon + day >= date.strftime("%Y%m%d"):
            hits.append(str(int(eff) + int(rel)) + pop)
    return min(hits) if hits else None


period_rows = st.lists(st.tuples(
    st.sampled_from(["V2", "V3"]), st.sampled_from(["0000", "2000", "2001", "2002"]),
    st.integers(1, 12).map(lambda m: f"{m:02d}"), st.sampled_from(["15", "28", "30"]),
    st.integers(1, 16).map(lambda p: f"{p:03d}"), st.sampled_from(["0", "+1", "-1"])), max_size=25)
keys = st.lists(st.tuples(st.sampled_from(["V1", "V2", "V3", "V9"]), st.dates(dt.date(2000, 1, 1), dt.date(2002, 12, 31))),
                min_size=5, max_size=30)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(period_rows, keys)
def test_fiscal_periods_match_subquery_semantics(spark, prows, k):
    t009b = [("100", p, b, m, d, pop, rel) for p, b, m, d, pop, rel in prows]
    t9 = spark.createDataFrame(T009, "mandt string, periv string, xkale string, xjabh string")
    t9b = spark.createDataFrame(t009b, "mandt string, periv string, bdatj string, bumon string, butag string, "
                                       "poper string, reljr string")
    kdf = spark.createDataFrame([("100", p, d) for p, d in k], "mandt string, periv string, date date")
    for limit in (64 << 20, 0):  # broadcast, and carried by windows
        rows = fiscal_period_lookup(kdf, t9, t9b, limit).collect()
        got = {(r.periv, r.date): r.fiscal_period for r in rows}
        assert len(rows) == len(got) == len(set(k))
        for p, d in k:
            assert got.get((p, d)) == py_period(p, d, t009b), (p, d, limit)
