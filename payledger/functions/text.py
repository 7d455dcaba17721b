"""String helpers used to build join keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_leading_zeros(c: Column) -> Column:
    """``LTRIM(c, '0')``: '0010' -> '10', '000' -> ''. (Native trim: no regex.)"""
    return F.ltrim(c, F.lit("0"))


def last_token(c: Column, sep: str = "_") -> Column:
    """Last ``sep``-separated token of ``c`` (the whole string if ``sep`` is absent)."""
    return F.substring_index(c, sep, -1)


def left(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)
