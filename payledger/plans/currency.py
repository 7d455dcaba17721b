"""Currency helpers: decimal-place factors and daily exchange rates."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payledger.config import LedgerConfig
from payledger.functions.dates import gdatu_to_date
from payledger.operators.intervals import explode_days, validity_interval
from payledger.types import FACTOR, RATE

PAIR_KEYS = ["mandt", "kurst", "fcurr", "tcurr"]


def currency_decimal(tables: Mapping[str, DataFrame]) -> DataFrame:
    """CURRKEY -> CURRFIX = 10^(2 - decimals); a missing decimal count counts as 0."""
    tcurx = tables["tcurx"]
    return tcurx.select(
        F.col("currkey").alias("CURRKEY"),
        F.pow(F.lit(10.0), F.lit(2) - F.coalesce(F.col("currdec"), F.lit(0))).cast(FACTOR).alias("CURRFIX"),
    ).distinct()


@dataclass(frozen=True)
class CurrencyFactors:
    """The currency-decimal table as values: the currencies of every factor."""

    keys: tuple[tuple[Decimal, tuple[str, ...]], ...]

    def of(self, currency: Column) -> Column:
        """The factor of ``currency``; NULL for NULL or a currency without an entry.
        One set of currencies per factor, of which there are as many as decimal counts."""
        found = F.lit(None).cast(FACTOR)
        for factor, names in self.keys:
            found = F.when(currency.isin(*names), F.lit(factor).cast(FACTOR)).otherwise(found)
        return found


def currency_factors(decimals: DataFrame, most: int) -> CurrencyFactors | None:
    """``decimals`` as values, if it holds at most ``most`` rows and every currency
    once; else None: a join then gives a line per row of its currency."""
    rows = decimals.select("CURRKEY", "CURRFIX").limit(most + 1).collect()
    names = [r["CURRKEY"] for r in rows if r["CURRKEY"] is not None]
    if len(rows) > most or len(set(names)) < len(names):
        return None
    groups: dict[Decimal, list[str]] = {}
    for r in rows:
        if r["CURRKEY"] is not None and r["CURRFIX"] is not None:
            groups.setdefault(r["CURRFIX"], []).append(r["CURRKEY"])
    return CurrencyFactors(tuple((f, tuple(sorted(groups[f]))) for f in sorted(groups)))


def rate_intervals(tables: Mapping[str, DataFrame], cfg: LedgerConfig) -> DataFrame:
    """Exchange rates with their validity interval.

    Negative rates are stored inverted (1/|rate|). A rate holds from its date
    to the day before the next rate of the same pair; the latest to ``today``.
    """
    tcurr = tables["tcurr"]
    ukurs = F.col("ukurs")
    inverse = F.try_divide(F.lit(1).cast("decimal(20,9)"), F.abs(ukurs))
    df = tcurr.select(
        *PAIR_KEYS,
        "gdatu",
        F.when(ukurs < 0, inverse).otherwise(ukurs).cast(RATE).alias("ukurs"),
        gdatu_to_date(F.col("gdatu")).alias("start_date"),
    )
    return validity_interval(df, PAIR_KEYS, "gdatu", "start_date", cfg.today()).drop("gdatu")


def factor_intervals(tables: Mapping[str, DataFrame], cfg: LedgerConfig) -> DataFrame:
    """Unit factors (from/to ratio) with validity intervals; missing factors count as 1."""
    tcurf = tables["tcurf"]
    df = tcurf.select(
        *PAIR_KEYS,
        "gdatu",
        gdatu_to_date(F.col("gdatu")).alias("start_date"),
        F.coalesce(F.col("ffact"), F.lit(1)).alias("ffact"),
        F.coalesce(F.col("tfact"), F.lit(1)).alias("tfact"),
    )
    return validity_interval(df, PAIR_KEYS, "gdatu", "start_date", cfg.today()).drop("gdatu")


def rate_factor_containment(tables: Mapping[str, DataFrame], cfg: LedgerConfig) -> DataFrame:
    """Rates adjusted by the unit factor whose interval contains the rate interval.

    An equi-join on the currency pair with the containment test as residual
    condition: a pair has few factor rows, so each rate meets only those.
    """
    r = rate_intervals(tables, cfg).alias("r")
    f = factor_intervals(tables, cfg).alias("f")
    cond = [F.col(f"r.{k}") == F.col(f"f.{k}") for k in PAIR_KEYS]
    cond += [F.col("r.start_date") >= F.col("f.start_date"), F.col("r.end_date") <= F.col("f.end_date")]
    ratio = F.try_divide(F.col("f.tfact").cast("decimal(20,9)"), F.col("f.ffact").cast("decimal(20,9)")).cast(RATE)
    return r.join(f, cond, "inner").select(
        *[F.col(f"r.{k}") for k in PAIR_KEYS],
        (F.col("r.ukurs") * ratio).cast(RATE).alias("ukurs"),
        F.col("r.start_date"),
        F.col("r.end_date"),
    )


def identity_rates(tables: Mapping[str, DataFrame], cfg: LedgerConfig) -> DataFrame:
    """Same-currency rows (rate 1 over the whole history window), one per
    (client, rate type, from-currency) present in the rate table."""
    return tables["tcurr"].select(
        "mandt", "kurst", "fcurr", F.col("fcurr").alias("tcurr")
    ).distinct().select(
        *PAIR_KEYS,
        F.lit(1).cast(RATE).alias("ukurs"),
        cfg.rate_window_start().alias("start_date"),
        cfg.today().alias("end_date"),
    )


def currency_conversion(tables: Mapping[str, DataFrame], cfg: LedgerConfig) -> DataFrame:
    """Daily rate table: one row per pair and day of the last ``rate_history_years``.

    The rows stay bounded by (pairs x days in the window) whatever the size
    of the documents, which is what makes it a broadcastable dimension.
    """
    rates = rate_factor_containment(tables, cfg).unionByName(identity_rates(tables, cfg))
    daily = explode_days(
        rates, F.col("start_date"), F.col("end_date"), "conv_date",
        clip_from=cfg.rate_window_start(), clip_to=cfg.today(),
    )
    return daily.select(*PAIR_KEYS, "ukurs", "start_date", "end_date", "conv_date")


# Business names of the rate view.
CONVERSION_NAMES = [
    ("mandt", "Client_MANDT"),
    ("kurst", "ExchangeRateType_KURST"),
    ("fcurr", "FromCurrency_FCURR"),
    ("tcurr", "ToCurrency_TCURR"),
    ("ukurs", "ExchangeRate_UKURS"),
    ("start_date", "StartDate"),
    ("end_date", "EndDate"),
    ("conv_date", "ConvDate"),
]


def currency_conversion_view(daily: DataFrame) -> DataFrame:
    return daily.select(*[F.col(s).alias(t) for s, t in CONVERSION_NAMES])


def target_rates(daily_view: DataFrame, cfg: LedgerConfig) -> DataFrame:
    """Daily rates into the target currency for the configured rate type."""
    return daily_view.where(
        (F.col("ToCurrency_TCURR") == cfg.target_currency) & (F.col("ExchangeRateType_KURST") == cfg.rate_type)
    ).select("Client_MANDT", "FromCurrency_FCURR", "ToCurrency_TCURR", "ConvDate", "ExchangeRate_UKURS")


def rate_months(tables: Mapping[str, DataFrame], cfg: LedgerConfig) -> DataFrame:
    """The rates of ``currency_conversion`` as intervals instead of days: one row per
    rate and month that its interval touches, with the days ``first_day`` to
    ``last_day`` on which it holds (over the history window, as the daily table).

    A rate of a date is found by equality on the pair and the month, and a range test
    on the few intervals of that month. A pair whose rate changes monthly has one row
    a month here and one a day in the daily table."""
    rates = rate_factor_containment(tables, cfg).unionByName(identity_rates(tables, cfg))
    lo = F.greatest(F.col("start_date"), cfg.rate_window_start())
    hi = F.least(F.col("end_date"), cfg.today())
    held = rates.select(*PAIR_KEYS, "ukurs", lo.alias("first_day"), hi.alias("last_day")).where("first_day <= last_day")
    month = F.explode(F.sequence(F.trunc("first_day", "MM"), F.trunc("last_day", "MM"), F.expr("INTERVAL 1 MONTH")))
    return held.withColumn("month", month)


def target_rate_months(tables: Mapping[str, DataFrame], cfg: LedgerConfig) -> DataFrame:
    """``rate_months`` into the target currency for the configured rate type."""
    wanted = (F.col("tcurr") == cfg.target_currency) & (F.col("kurst") == cfg.rate_type)
    return rate_months(tables, cfg).where(wanted).select(
        F.col("mandt").alias("Client_MANDT"), F.col("fcurr").alias("FromCurrency_FCURR"), F.col("tcurr").alias("ToCurrency_TCURR"),
        "month", "first_day", "last_day", F.col("ukurs").alias("ExchangeRate_UKURS"))
