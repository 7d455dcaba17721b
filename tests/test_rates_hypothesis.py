"""Daily rates against a brute-force statement of the model (random rates and factors)."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from payledger.config import LedgerConfig
from payledger.plans.currency import currency_conversion, rate_months

AS_OF = dt.date(2001, 6, 30)
CFG = LedgerConfig(as_of=AS_OF, rate_history_years=1)
Q9 = Decimal("0.000000001")


def gd(d):
    return str(99999999 - (d.year * 10000 + d.month * 100 + d.day))


def intervals(rows):
    """rows: (pair, start, value) -> (pair, start, end, value); end = next start - 1 or as_of."""
    out = []
    for pair in {r[0] for r in rows}:
        rs = sorted((r for r in rows if r[0] == pair), key=lambda r: r[1])
        for i, (p, s, v) in enumerate(rs):
            nxt = next((x[1] for x in rs[i + 1:] if x[1] != s), None)
            out.append((p, s, (nxt - dt.timedelta(days=1)) if nxt else AS_OF, v))
    return out


def brute(rates, factors):
    window = (AS_OF.replace(year=AS_OF.year - 1), AS_OF)
    r_iv = intervals([(p, s, (Decimal(1) / abs(v)).quantize(Q9, ROUND_HALF_UP) if v < 0 else v) for p, s, v in rates])
    f_iv = intervals([(p, s, (ff or 1, tf or 1)) for p, s, ff, tf in factors])
    conv = []
    for p, s, e, v in r_iv:
        for fp, fs, fe, (ff, tf) in f_iv:
            if fp == p and s >= fs and e <= fe:
                ratio = (Decimal(tf) / Decimal(ff)).quantize(Q9, ROUND_HALF_UP)
                conv.append((p, (v * ratio).quantize(Q9, ROUND_HALF_UP), s, e))
    for k, f in {(p[0], p[1]) for p, _, _ in rates}:
        conv.append(((k, f, f), Decimal(1), window[0], window[1]))
    out = []
    for p, v, s, e in conv:
        d = max(s, window[0])
        while d <= min(e, window[1]):
            out.append((p[0], p[1], p[2], v, d))
            d += dt.timedelta(days=1)
    return sorted(out)


pairs = st.sampled_from([("B", "USD", "BRL"), ("B", "JPY", "BRL"), ("M", "BRL", "BRL")])
day = st.dates(dt.date(2000, 1, 1), dt.date(2001, 8, 1))
rate_rows = st.lists(st.tuples(pairs, day, st.integers(-40, 40).filter(bool).map(Decimal)), min_size=1, max_size=8,
                     unique_by=lambda r: (r[0], r[1]))
factor_rows = st.lists(st.tuples(pairs, st.dates(dt.date(1999, 1, 1), dt.date(2001, 3, 1)),
                                 st.sampled_from([None, Decimal(1), Decimal(100)]),
                                 st.sampled_from([None, Decimal(1), Decimal(100)])),
                       max_size=4, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rate_rows, factor_rows)
def test_daily_rates_match_brute_force(spark, rates, factors):
    tables = {
        "tcurr": spark.createDataFrame([("100", p[0], p[1], p[2], gd(s), v) for p, s, v in rates],
                                       "mandt string, kurst string, fcurr string, tcurr string, gdatu string, "
                                       "ukurs decimal(14,5)"),
        "tcurf": spark.createDataFrame([("100", p[0], p[1], p[2], gd(s), ff, tf) for p, s, ff, tf in factors],
                                       "mandt string, kurst string, fcurr string, tcurr string, gdatu string, "
                                       "ffact decimal(9,0), tfact decimal(9,0)"),
    }
    got = sorted((r.kurst, r.fcurr, r.tcurr, r.ukurs, r.conv_date) for r in currency_conversion(tables, CFG).collect())
    assert got == brute(rates, factors)
    # as intervals by month: each interval's days are the daily rows
    by_month = sorted((r.kurst, r.fcurr, r.tcurr, r.ukurs, r.day) for r in rate_months(tables, CFG).selectExpr(
        "*", "explode(sequence(greatest(first_day, month), least(last_day, last_day(month)))) AS day").collect())
    assert by_month == got
