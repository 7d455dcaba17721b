"""Validity intervals from start dates, and day-by-day expansion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def validity_interval(
    df: DataFrame, keys: Sequence[str], order_col: str, start_col: str, open_end: Column,
    descending: bool = True,
) -> DataFrame:
    """Add ``end_date``: the day before the next start of the same key, or
    ``open_end`` for the latest row. The window is partitioned by the key
    (one currency pair), so it shuffles once and each task holds one pair.
    """
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    nxt = F.lead(start_col).over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("end_date", F.coalesce(F.date_sub(nxt, 1), open_end))


def explode_days(df: DataFrame, start: Column, end: Column, name: str = "conv_date",
                 clip_from: Column | None = None, clip_to: Column | None = None) -> DataFrame:
    """One row per day of ``[start, end]`` (no row when start > end).

    ``clip_from``/``clip_to`` bound the generated range up front, equivalent
    to filtering the exploded days but without generating the discarded ones.
    """
    lo = F.greatest(start, clip_from) if clip_from is not None else start
    hi = F.least(end, clip_to) if clip_to is not None else end
    days = F.when(lo <= hi, F.sequence(lo, hi, F.expr("INTERVAL 1 DAY")))
    return df.withColumn(name, F.explode(days))
