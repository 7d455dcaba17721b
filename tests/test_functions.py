"""Column functions: truth tables worked by hand from the routine definitions."""

from decimal import Decimal

from pyspark.sql import functions as F

from conftest import d
from payledger.functions import (
    cash_discount_date_1,
    cash_discount_date_2,
    days_to_int,
    gdatu_to_date,
    last_token,
    net_due_date,
    scale_amount,
    sign_flip_columns,
    strip_leading_zeros,
)
from payledger.plans.payables import _safe_int

SCHEMA = "koart string, zfbdt date, bldat date, shkzg string, rebzg string, zbd3t decimal(3,0), " \
         "zbd2t decimal(3,0), zbd1t decimal(3,0)"


def _due(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    args = [F.col(c) for c in ("koart", "zfbdt", "bldat", "shkzg", "rebzg", "zbd3t", "zbd2t", "zbd1t")]
    return df.select(
        net_due_date(*args).alias("net"), cash_discount_date_1(*args).alias("sk1"),
        cash_discount_date_2(*args).alias("sk2"),
    ).collect()


def test_gdatu_inverts_dates(spark):
    row = spark.createDataFrame([("79989398",)], "g string").select(gdatu_to_date(F.col("g")).alias("x")).first()
    assert row.x == d("2001-06-01")


def test_sign_flip_only_credit_lines(spark):
    df = spark.createDataFrame(
        [("S", Decimal("5.00")), ("H", Decimal("5.00")), (None, Decimal("5.00")), ("X", Decimal("5.00"))],
        "shkzg string, amt decimal(23,2)",
    )
    out = [r.amt for r in sign_flip_columns(df, ["AMT", "missing"]).collect()]
    assert out == [Decimal("5.00"), Decimal("-5.00"), Decimal("5.00"), Decimal("5.00")]


def test_scale_amount_keeps_amount_without_factor(spark):
    df = spark.createDataFrame([(Decimal("10.00"), Decimal("100")), (Decimal("10.00"), None),
                                (Decimal("10.00"), Decimal("0.1"))], "a decimal(23,2), f decimal(12,4)")
    out = [r.x for r in df.select(scale_amount(F.col("a"), F.col("f")).alias("x")).collect()]
    assert out == [Decimal("1000.0000"), Decimal("10.0000"), Decimal("1.0000")]


def test_net_due_date_rules(spark):
    base, doc = d("2001-01-10"), d("2001-01-01")
    rows = [
        ("D", None, doc, "S", None, Decimal(60), Decimal(30), Decimal(10)),   # customer: ZBD3T first, from BLDAT
        ("D", base, doc, "S", None, None, Decimal(30), Decimal(10)),          # customer: ZBD2T next
        ("D", base, doc, "H", None, Decimal(60), None, None),                 # credit memo w/o invoice ref: 0 days
        ("D", base, doc, "H", "0001", None, None, Decimal(7)),                # credit memo with ref: ZBD1T
        ("K", base, doc, "S", None, None, None, None),                        # vendor, no ZBD1T: 0 days
        ("K", base, doc, "S", None, Decimal(60), None, Decimal(14)),          # vendor with ZBD1T: NULL (Q5)
        ("K", None, doc, "S", None, None, None, None),                        # vendor, no baseline: NULL
    ]
    got = [r.net for r in _due(spark, rows)]
    assert got == [d("2001-03-02"), d("2001-02-09"), base, d("2001-01-17"), base, None, None]


def test_cash_discount_dates(spark):
    base, doc = d("2001-01-10"), d("2001-01-01")
    rows = [
        ("K", base, doc, "S", None, None, Decimal(30), Decimal(10)),
        ("K", base, doc, "S", None, None, Decimal(30), None),   # only ZBD2T: first date is NULL
        ("K", base, doc, "S", None, None, None, None),          # no terms: net due date
    ]
    got = [(r.sk1, r.sk2) for r in _due(spark, rows)]
    assert got == [(d("2001-01-20"), d("2001-02-09")), (None, d("2001-02-09")), (base, base)]


def test_days_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("2.5"),), (Decimal("-2.5"),), (Decimal("2.4"),)], "x decimal(3,1)")
    assert [r.y for r in df.select(days_to_int(F.col("x")).alias("y")).collect()] == [3, -3, 2]


def test_key_helpers(spark):
    df = spark.createDataFrame([("0010", "Z_VENDOR_0000000042"), ("000", "PLAIN")], "b string, n string")
    out = df.select(strip_leading_zeros(F.col("b")).alias("b"), last_token(F.col("n")).alias("t")).collect()
    assert [(r.b, r.t) for r in out] == [("10", "0000000042"), ("", "PLAIN")]


def test_safe_int_matches_strict_integer_parse(spark):
    df = spark.createDataFrame([("2",), ("1.5",), ("abc",), (" 7 ",), ("-3",), (None,)], "s string")
    assert [r.v for r in df.select(_safe_int(F.col("s")).alias("v")).collect()] == [2, None, None, 7, -3, None]


def test_arrear_modes(spark, erp):
    import dataclasses

    from payledger.config import FIXTURE_CONFIG
    from payledger.plans.currency import currency_decimal
    from payledger.plans.documents import accounting_documents

    def arrears(mode):
        cfg = dataclasses.replace(FIXTURE_CONFIG, arrear_mode=mode)
        ad = accounting_documents(erp, currency_decimal(erp), None, cfg)
        return {(r.AccountingDocumentNumber_BELNR, r.NumberOfLineItemWithinAccountingDocument_BUZEI): r.DaysInArrear
                for r in ad.where("NetDueDateCalc IS NOT NULL").limit(50).collect()}

    as_written, corrected = arrears("due_minus_today"), arrears("today_minus_due")
    assert as_written and all(corrected[k] == -v for k, v in as_written.items() if k in corrected)


def test_exact_product_keeps_nine_decimals(spark):
    from decimal import ROUND_HALF_UP, Context

    from payledger.functions.amounts import exact_product

    amounts = ["0.01234", "-0.700000000", "123456789012345678.123456789", "-99.999999999", "0.000000001"]
    factors = ["5000000000.000", "0.500", "0.001", "-3.333", "9999999999.999"]
    rows = [(Decimal(a), Decimal(f)) for a in amounts for f in factors]
    df = spark.createDataFrame(rows, "a decimal(28,9), f decimal(13,3)")
    got = df.select("a", "f", exact_product(F.col("a"), F.col("f")).alias("p")).collect()
    wide = Context(prec=60)
    for r in got:
        assert r.p == wide.multiply(r.a, r.f).quantize(Decimal("1e-9"), ROUND_HALF_UP, wide)


def test_safe_int_takes_hexadecimal_and_nineteen_digits(spark):
    from payledger.plans.payables import _safe_int

    texts = ["0x1F", "-0Xff", "9223372036854775807", "9223372036854775808", "0x8000000000000000", "0x", "1.5", "5000000000"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r[0] for r in df.select(_safe_int(F.col("s"))).collect()] == [31, -255, 9223372036854775807, None, None, None, None, 5000000000]
