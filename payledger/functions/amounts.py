"""Debit/credit signs and the currency-decimal fix of amounts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payledger.types import AMOUNT, NUMERIC


def flipped(amount: Column, indicator: Column) -> Column:
    """Credit lines ('H') become negative; debit ('S') and anything else keep their sign."""
    return F.when(indicator == F.lit("H"), -amount).otherwise(amount)


def sign_flip_columns(df: DataFrame, columns: Iterable[str], indicator: str = "shkzg") -> DataFrame:
    """Flip every listed column that exists in ``df``, in one projection.

    One ``withColumns`` keeps the plan flat however many columns are flipped.
    """
    wanted = {c.lower() for c in columns}
    exprs = [
        f"CASE WHEN `{indicator}` = 'H' THEN -`{c}` ELSE `{c}` END AS `{c}`" if c.lower() in wanted else f"`{c}`"
        for c in df.columns
    ]
    return df.selectExpr(*exprs) if any(c.lower() in wanted for c in df.columns) else df


def debit_credit_label(indicator: Column) -> Column:
    return F.when(indicator == "S", F.lit("debit")).when(indicator == "H", F.lit("credit"))


def scale_amount_sql(amount: str, factor: str, name: str) -> str:
    """SQL text of ``scale_amount`` (for wide ``selectExpr`` projections)."""
    return f"CAST(COALESCE(`{amount}` * `{factor}`, `{amount}`) AS {AMOUNT.simpleString()}) AS `{name}`"


def scale_amount(amount: Column, factor: Column) -> Column:
    """``COALESCE(amount * factor, amount)``: amounts of currencies without a
    decimal entry stay as stored; others are multiplied by 10^(2 - decimals)."""
    return F.coalesce(amount * factor, amount).cast(AMOUNT)


def exact_product(amount: Column, factor: Column) -> Column:
    """``amount * factor`` rounded half-up to 9 decimals, for a factor of at
    most 19 digits and 3 decimals (a count or a quantity).

    Spark gives up decimals when a product needs more than 38 digits. Whole part
    and fraction of the amount are multiplied apart: they have the same sign, and
    only the second product is rounded. Fails from 10^28 on, no earlier.
    """
    a = amount.cast("decimal(37,9)")
    fraction = a % F.lit(1).cast("decimal(1,0)")
    whole = (a - fraction).cast("decimal(28,0)")
    return ((whole * factor).cast("decimal(37,9)") + (fraction * factor).cast("decimal(37,9)")).cast(NUMERIC)
