"""Top-of-rank filter (``QUALIFY RANK() OVER (...) = 1``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first_rank(df: DataFrame, partition_by: Sequence[str], order_by: Column) -> DataFrame:
    """Rows of rank 1 in each group, ties included.

    Spark plans a partial ``WindowGroupLimit`` before the shuffle, so each map
    task forwards only its rank-1 rows: a hot group reaches the final window
    as its tied minimum rows, not as the whole group.
    """
    rk = "__rank"
    w = Window.partitionBy(*partition_by).orderBy(order_by)
    return df.withColumn(rk, F.rank().over(w)).where(F.col(rk) == 1).drop(rk)
