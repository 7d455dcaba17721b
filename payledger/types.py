"""Decimal types. Products are cast so that Spark never has to drop digits.

decimal(28,9) * decimal(18,9) needs 47 digits, so Spark rounds the product
half-up to 9 decimals: the same result a NUMERIC(38,9) column gives.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

AMOUNT = DecimalType(28, 9)     # amounts after the currency-decimal fix
RAW_AMOUNT = DecimalType(23, 2)
RATE = DecimalType(18, 9)       # exchange rates
FACTOR = DecimalType(12, 9)     # currency decimal factor 10^(2 - decimals)
NUMERIC = DecimalType(38, 9)    # generic NUMERIC result


def zero(t=NUMERIC) -> Column:
    return F.lit(0).cast(t)
