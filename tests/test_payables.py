"""Payable stages on hand-made rows: traps Q4, Q7, Q9, null-key joins, flags."""

import contextlib
import datetime as dt
import io
import re
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import d
from payledger.config import LedgerConfig
from payledger.operators.joins import broadcast_if_small, is_small, left_join_salted_nulls
from payledger.operators.ranking import keep_first_rank
from payledger.plans.payables import measure_inputs, measures

CFG = LedgerConfig(as_of=dt.date(2001, 6, 30))

ROW_SCHEMA = (
    "AccountType_KOART string, NetDueDate date, ClearingDate_AUGDT date, AmountInLocalCurrency_DMBTR decimal(23,4), "
    "AmountInDocumentCurrency_WRBTR decimal(23,4), ExchangeRate_UKURS decimal(18,9), "
    "PostingDateInTheDocument_BUDAT date, AccountingDocumentNumber_BELNR string, "
    "MovementType__inventoryManagement___BWART string, FollowOnDocumentType_REBZT string, "
    "AccountingDocumenttype_BLART string, TransactionKey_KTOSL string, VendorAccountGroup_KTOKK string, "
    "PaymentBlockKey_ZLSPR string, InvStatus_RBSTAT string, PostingKey_BSCHL string, "
    "AmountEligibleForCashDiscountInDocumentCurrency_SKFBT decimal(23,4), CashDiscountPercentage1_ZBD1P decimal(5,3), "
    "__vc_low string, __p_dmbtr decimal(23,4), __p_wrbtr decimal(23,4), __p_menge decimal(13,3)"
)


def _row(**kw):
    base = dict(
        AccountType_KOART="K", NetDueDate=d("2001-06-01"), ClearingDate_AUGDT=d("0001-01-01"),
        AmountInLocalCurrency_DMBTR=Decimal("100"), AmountInDocumentCurrency_WRBTR=Decimal("10"),
        ExchangeRate_UKURS=Decimal("2.5"), PostingDateInTheDocument_BUDAT=d("2001-05-01"),
        AccountingDocumentNumber_BELNR="1900000001", MovementType__inventoryManagement___BWART=None,
        FollowOnDocumentType_REBZT=None, AccountingDocumenttype_BLART="RE", TransactionKey_KTOSL="KBS",
        VendorAccountGroup_KTOKK="1000", PaymentBlockKey_ZLSPR=" ", InvStatus_RBSTAT=None, PostingKey_BSCHL="31",
        AmountEligibleForCashDiscountInDocumentCurrency_SKFBT=Decimal("200"), CashDiscountPercentage1_ZBD1P=Decimal("2.5"),
        __vc_low="2", __p_dmbtr=None, __p_wrbtr=None, __p_menge=None,
    )
    base.update(kw)
    return base


def _eval(spark, rows):
    names = [f.split(" ")[0] for f in ROW_SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ROW_SCHEMA)
    return df.withColumns(measure_inputs()).withColumns(measures(CFG)).collect()


def test_overdue_needs_sentinel_clearing_date(spark):
    # Q4: open means a clearing date before 1900; a NULL clearing date is not open here
    open_row, null_row = _eval(spark, [_row(), _row(ClearingDate_AUGDT=None)])
    assert open_row.OverdueAmountInLocalCurrency == Decimal("100")
    assert open_row.OverdueAmountInTargetCurrency == Decimal("25")
    assert null_row.OverdueAmountInLocalCurrency == 0


def test_no_rate_gives_null_target_only_when_condition_holds(spark):
    r_true, r_false = _eval(spark, [_row(ExchangeRate_UKURS=None), _row(ExchangeRate_UKURS=None, AccountType_KOART="D")])
    assert r_true.OverdueAmountInTargetCurrency is None and r_true.OverdueAmountInLocalCurrency == 100
    assert r_false.OverdueAmountInTargetCurrency == 0


def test_purchase_rule_on_material_lines(spark):
    # Q7: never hit by the pipeline (posted branch keeps only vendor lines); the rule itself:
    rows = _eval(spark, [_row(AccountType_KOART="M", MovementType__inventoryManagement___BWART="101"),
                         _row(AccountType_KOART="M", MovementType__inventoryManagement___BWART="502"),
                         _row(AccountType_KOART="K", MovementType__inventoryManagement___BWART="101")])
    assert [r.PurchaseInLocalCurrency for r in rows] == [Decimal("100"), Decimal("-100"), 0]
    assert rows[1].PurchaseInTargetCurrency == Decimal("-25")


def test_penalty_and_late_payment(spark):
    late = _row(ClearingDate_AUGDT=d("2001-06-10"), NetDueDate=d("2001-06-01"))
    rows = _eval(spark, [late, dict(late, __vc_low="1.5"), dict(late, __vc_low=None)])
    assert [r.PotentialPenaltyInLocalCurrency for r in rows] == [Decimal("200"), 0, 0]
    assert rows[0].LatePaymentsInDocumentCurrency == Decimal("10")


def test_flags_and_cash_discount(spark):
    (r,) = _eval(spark, [_row(AccountingDocumentNumber_BELNR="1500000001", PaymentBlockKey_ZLSPR="P")])
    assert (r.IsInvoice, r.IsManualPayment, r.IsAutomaticPayment, r.IsHardBlocked, r.IsBlockedInvoice) == (
        False, True, False, True, True)
    assert r.IsInvoiceMaterialService and not r.IsLegal and not r.IsParkedInvoice
    assert r.TargetCashDiscountInSourceCurrency == Decimal("5")
    assert r.TargetCashDiscountInTargetCurrency == Decimal("12.5")


def test_rank_keeps_ties_and_ignores_year(spark):
    # Q9: same invoice number in two fiscal years competes; ties are all kept
    df = spark.createDataFrame(
        [("A", "2000", "0001"), ("A", "2001", "0001"), ("A", "2001", "0002"), ("B", "2001", "0003")],
        "belnr string, gjahr string, buzei string",
    )
    got = sorted((r.belnr, r.gjahr) for r in keep_first_rank(df, ["belnr"], F.col("buzei").asc()).collect())
    assert got == [("A", "2000"), ("A", "2001"), ("B", "2001")]


def test_salted_left_join_keeps_null_keys(spark):
    left = spark.createDataFrame([("k1", 1), (None, 2), (None, 3)], "k string, id int")
    right = spark.createDataFrame([("k1", "x"), ("k1", "y")], "rk string, v string")
    out = left_join_salted_nulls(left, right, [(F.col("k"), "rk")], ["id"])
    got = sorted((r.id, r.v) for r in out.collect())
    assert got == [(1, "x"), (1, "y"), (2, None), (3, None)]


def test_size_checked_broadcast(spark):
    small = spark.range(10)
    assert is_small(small, 100) and not is_small(spark.range(1000), 100)  # 8 bytes a row
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        spark.range(1000).join(broadcast_if_small(small, 100), "id").explain()
    assert "BroadcastHashJoin" in buf.getvalue()


def test_null_key_rows_spread_over_partitions(spark):
    """A plain shuffle join sends every NULL-key row to one partition; the
    salted join spreads them (and still matches nothing for them)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(4000).select(
            F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).alias("k"), F.col("id").alias("doc"))
        right = spark.range(0, 4000, 10).select(F.col("id").cast("string").alias("rk"), F.lit("x").alias("v"))
        salted = left_join_salted_nulls(left, right, [(F.col("k"), "rk")], ["doc"])
        plain = left.join(right, F.col("k") == F.col("rk"), "left")

        def null_parts(df):
            return df.where("k IS NULL").select(F.spark_partition_id().alias("p")).distinct().count()

        assert null_parts(plain) == 1
        assert null_parts(salted) > 1
        assert salted.count() == 4000 and salted.where("v IS NOT NULL").count() == 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_key_partition_is_split_by_aqe(spark):
    """One key holding a third of the left rows: the salted left join stays a
    plain sort-merge join on the key, so AQE's skew handling splits the hot
    partition (thresholds lowered to test size)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 997).cast("string")).alias("k"),
            F.col("id").alias("doc"))
        right = spark.range(1000).select((F.col("id") % 997).cast("string").alias("rk"), F.col("id").alias("v")) \
            .union(spark.range(2).select(F.lit("HOT").alias("rk"), F.col("id").alias("v")))
        out = left_join_salted_nulls(left, right, [(F.col("k"), "rk")], ["doc"])
        rows = out.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain()
        assert "SortMergeJoin(skew=true)" in buf.getvalue()
        assert len(rows) == 10000 * 2 + 20000 + sum(1 for r in rows if r.k in ("0", "1", "2")) // 2
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_lookup_join_paths_agree(spark, erp, cfg):
    """The broadcast path (dimension under the limit) and the salted shuffle
    path (over it) give the same rows."""
    import dataclasses

    from payledger.plans.model import LedgerModel

    small = LedgerModel(spark, erp, cfg).accounts_payable
    large = LedgerModel(spark, erp, dataclasses.replace(cfg, broadcast_bytes=0)).accounts_payable
    assert small.count() == large.count()
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0


def test_hot_keys_are_split_without_aqe(spark):
    """One document with a third of the lines, AQE and broadcasts off: a plain join
    puts its rows in one task, the split join over as many as its share is worth,
    with the same result."""
    from payledger.operators.joins import frequent_keys

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 30 != 1, (F.col("id") % 997).cast("string")).alias("k"),
            F.lit("100").alias("client"), F.col("id").alias("doc")).cache()
        right = spark.range(1000).select(
            F.lit("100").alias("rc"), (F.col("id") % 500).cast("string").alias("rk"), F.col("id").alias("v")).union(
            spark.range(3).select(F.lit("100"), F.lit("HOT"), F.col("id")))
        pairs = [(F.col("client"), "rc"), (F.col("k"), "rk")]
        found = frequent_keys(left, {"key": [F.col("client"), F.col("k")], "doc": [F.col("doc")]}, 0.05, 24)
        assert len(found["key"].hashes) == 1 and found["key"].pieces == 8 and found["doc"].hashes == ()
        plain = left_join_salted_nulls(left, right, pairs, ["doc"])
        split = left_join_salted_nulls(left, right, pairs, ["doc"], found["key"])

        def largest(df):
            return df.where("k = 'HOT'").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        assert largest(plain) == 30000 and largest(split) <= 30000 // 3
        assert split.columns == plain.columns and split.count() == plain.count()
        assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_fact_with_split_keys_is_the_same(spark, erp, cfg):
    import dataclasses

    from payledger.plans.model import LedgerModel

    # a document that holds most lines, on both joins
    hot = dict(erp)
    doc = hot["bseg"].limit(1).collect()[0]
    for t in ("bseg",):
        hot[t] = hot[t].withColumns({c: F.when(F.xxhash64("belnr", "buzei") % 2 == 0, F.lit(doc[c])).otherwise(F.col(c)) for c in ("ebeln", "ebelp")})
    plain, split = (LedgerModel(spark, hot, dataclasses.replace(cfg, hot_key_share=s)) for s in (None, 0.0002))
    assert plain.hot_keys == {} and all(k.hashes for k in split.hot_keys.values())
    a, b = plain.accounts_payable, split.accounts_payable
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rates_by_interval_are_the_daily_rates(spark, erp, cfg):
    """The fact with rates from monthly intervals, broadcast and as a shuffle join,
    against the fact with daily rates."""
    import dataclasses

    from payledger.plans.model import LedgerModel

    daily = LedgerModel(spark, erp, cfg)
    keys = ["AccountingDocumentNumber_BELNR", "NumberOfLineItemWithinAccountingDocument_BUZEI", "PreviousBusinessDay_BUDAT",
            "CurrencyKey_WAERS", "ExchangeRate_UKURS", "TargetCurrency_TCURR"]
    want = daily.enriched_payables.select(keys)
    assert want.where("ExchangeRate_UKURS IS NOT NULL").count() > 0
    for changes in ({}, {"broadcast_bytes": 0}):
        got = LedgerModel(spark, erp, dataclasses.replace(cfg, rate_lookup="interval", **changes))
        assert got.target_rates.count() < daily.target_rates.count()
        rows = got.enriched_payables.select(keys)
        assert rows.exceptAll(want).count() == 0 and want.exceptAll(rows).count() == 0


def test_measures_compile(spark, erp, cfg):
    """No generated method of the fact is too long for the JVM to compile (8,000 bytes)."""
    from payledger.plans.model import LedgerModel

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact = LedgerModel(spark, erp, cfg).accounts_payable
        fact = fact.select(*[F.col(c).cast("string").alias(c) for c in fact.columns])
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            fact.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000, sizes
