"""Column-level building blocks (all Catalyst expressions, no Python UDFs)."""

from payledger.functions.amounts import debit_credit_label, scale_amount, sign_flip_columns
from payledger.functions.dates import (
    cash_discount_date_1,
    cash_discount_date_2,
    days_to_int,
    fiscal_case1,
    gdatu_to_date,
    net_due_date,
)
from payledger.functions.text import last_token, strip_leading_zeros

__all__ = [
    "cash_discount_date_1",
    "cash_discount_date_2",
    "days_to_int",
    "debit_credit_label",
    "fiscal_case1",
    "gdatu_to_date",
    "last_token",
    "net_due_date",
    "scale_amount",
    "sign_flip_columns",
    "strip_leading_zeros",
]
