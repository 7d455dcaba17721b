"""Currency decimals, rate intervals, factor containment and daily rates."""

import datetime as dt
from decimal import Decimal

from conftest import d
from payledger.config import LedgerConfig
from payledger.plans import currency as C

CFG = LedgerConfig(as_of=dt.date(2001, 6, 30))


def _gdatu(day: str) -> str:
    x = dt.date.fromisoformat(day)
    return str(99999999 - (x.year * 10000 + x.month * 100 + x.day))


def _tables(spark, rates, factors=None):
    tcurr = spark.createDataFrame(
        [("100", t, f, to, _gdatu(day), Decimal(r)) for t, f, to, day, r in rates],
        "mandt string, kurst string, fcurr string, tcurr string, gdatu string, ukurs decimal(14,5)",
    )
    tcurf = spark.createDataFrame(
        [("100", "B", f, "BRL", _gdatu(day), ff, tf) for f, day, ff, tf in (factors or [])],
        "mandt string, kurst string, fcurr string, tcurr string, gdatu string, ffact decimal(9,0), tfact decimal(9,0)",
    )
    tcurx = spark.createDataFrame([("JPY", 0), ("KWD", 3), ("USD", None), ("JPY", 0)], "currkey string, currdec int")
    return {"tcurr": tcurr, "tcurf": tcurf, "tcurx": tcurx}


def test_currency_decimal_factor(spark):
    rows = {r.CURRKEY: r.CURRFIX for r in C.currency_decimal(_tables(spark, [])).collect()}
    assert rows == {"JPY": Decimal("100.0000"), "KWD": Decimal("0.1000"), "USD": Decimal("100.0000")}


def test_currency_factors_are_values_of_a_small_unique_table(spark):
    factors = lambda rows, most: C.currency_factors(spark.createDataFrame(rows, "CURRKEY string, CURRFIX decimal(12,4)"), most)
    rows = [("JPY", Decimal(100)), ("KWD", Decimal("0.1")), ("CLP", Decimal(100)), (None, Decimal(7)), ("XXX", None)]
    got = factors(rows, 5)
    assert got == C.CurrencyFactors(((Decimal("0.1000"), ("KWD",)), (Decimal("100.0000"), ("CLP", "JPY"))))
    df = spark.createDataFrame([("JPY",), ("KWD",), ("CLP",), ("EUR",), ("XXX",), (None,)], "c string")
    assert [r[0] for r in df.select(got.of(df["c"])).collect()] == [Decimal(100), Decimal("0.1"), Decimal(100), None, None, None]
    assert factors(rows, 4) is None  # too many rows
    assert factors(rows + [("JPY", Decimal(1))], 9) is None  # a join would give two lines
    assert df.select(factors([], 9).of(df["c"]).alias("f")).where("f IS NOT NULL").count() == 0


def test_rate_intervals_lead_and_inversion(spark):
    t = _tables(spark, [("B", "USD", "BRL", "2001-01-01", "5"), ("B", "USD", "BRL", "2001-03-01", "-4")])
    rows = sorted(C.rate_intervals(t, CFG).collect(), key=lambda r: r.start_date)
    assert [(r.start_date, r.end_date, r.ukurs) for r in rows] == [
        (d("2001-01-01"), d("2001-02-28"), Decimal("5.000000000")),
        (d("2001-03-01"), d("2001-06-30"), Decimal("0.250000000")),
    ]


def test_containment_drops_straddling_rate(spark):
    # factor changes on 2001-02-01: the rate valid 2001-01-15 .. 2001-06-30 straddles it (Q2)
    t = _tables(spark, [("B", "JPY", "BRL", "2001-01-15", "2")],
                [("JPY", "2000-01-01", Decimal(100), Decimal(1)), ("JPY", "2001-02-01", Decimal(100), Decimal(1))])
    assert C.rate_factor_containment(t, CFG).count() == 0
    t2 = _tables(spark, [("B", "JPY", "BRL", "2001-03-01", "2")],
                 [("JPY", "2000-01-01", Decimal(100), Decimal(1)), ("JPY", "2001-02-01", Decimal(100), Decimal(1))])
    (row,) = C.rate_factor_containment(t2, CFG).collect()
    assert row.ukurs == Decimal("0.020000000")


def test_daily_rates_identity_duplicates_and_window(spark):
    t = _tables(spark, [("M", "BRL", "BRL", "2001-06-01", "1"), ("B", "USD", "BRL", "2001-07-15", "3")],
                [("USD", "1990-01-01", None, None)])
    daily = C.currency_conversion(t, CFG)
    # future-dated rate (after as_of) produces no day (Q13)
    assert daily.where("fcurr = 'USD' and tcurr = 'BRL'").count() == 0
    # identity rows span 10 years; BRL->BRL under M is not in tcurf, so only identity rows remain
    ident = daily.where("fcurr = tcurr and kurst = 'M'")
    assert ident.count() == (dt.date(2001, 6, 30) - dt.date(1991, 6, 30)).days + 1
    assert daily.agg({"conv_date": "max"}).first()[0] == d("2001-06-30")
