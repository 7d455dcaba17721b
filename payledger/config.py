"""Run configuration: the client, the "as of" date and the business constants."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LedgerConfig:
    """Parameters shared by every dataset builder.

    ``as_of`` replaces every "today" in the measures; ``None`` means the
    session's ``current_date()``. Fixing it makes results reproducible.
    """

    as_of: dt.date | None = None
    # Fixed values (business constants of the payable model).
    target_currency: str = "BRL"
    rate_type: str = "B"
    vendor_account_type: str = "K"
    customer_account_type: str = "D"
    material_account_type: str = "M"
    parked_status: str = "A"
    partial_payment_type: str = "Z"
    hard_block_keys: tuple[str, ...] = ("P",)
    legal_vendor_groups: tuple[str, ...] = ("4000",)
    material_service_doc_types: tuple[str, ...] = ("RE", "KR")
    material_service_vendor_groups: tuple[str, ...] = ("1000", "2000")
    payment_doc_prefixes: tuple[str, ...] = ("15", "20", "17", "12")
    manual_payment_prefix: str = "15"
    automatic_payment_prefix: str = "20"
    cash_discount_doc_types: tuple[str, ...] = ("KZ", "ZP")
    cash_discount_transaction_key: str = "SKE"
    vendor_invoice_posting_key: str = "31"
    receipt_movements: tuple[str, ...] = ("101", "501")
    reversal_movements: tuple[str, ...] = ("102", "502")
    return_movement: str = "122"
    po_history_event_types: tuple[str, ...] = ("1", "2")
    vendor_config_separator: str = "_"
    open_item_sentinel: dt.date = dt.date(1900, 1, 1)
    current_address_until: dt.date = dt.date(9999, 12, 31)
    upcoming_payment_days: int = 14
    doubtful_after_days: int = 90
    rate_history_years: int = 10
    # Business-day calendar (the reference fills 2000-01-01 .. 2099-12-31).
    calendar_start: dt.date = dt.date(2000, 1, 1)
    calendar_end: dt.date = dt.date(2099, 12, 31)
    business_day_horizon: int = 30
    # "calendar": previous row of the generated calendar (as the reference does);
    # "business": the previous business day.
    previous_day_mode: str = "calendar"
    # "due_minus_today": DaysInArrear = due date - today, DoubtfulReceivables
    # when that exceeds the threshold (as the source model computes it);
    # "today_minus_due": the reading its comments describe (positive = late).
    arrear_mode: str = "due_minus_today"
    # Dimensions proven to hold at most this many bytes are broadcast; others go
    # through a shuffle join that AQE may still turn into a broadcast at run time.
    broadcast_bytes: int = 64 << 20
    # A currency-decimal table of at most this many rows, each currency once, becomes
    # expressions (read when a document dataset is built); a larger one is joined. 0: always joined.
    currency_values: int = 1000
    # How the payable fact finds a rate: "daily" (equality on the day of the daily
    # table) or "interval" (pair and month, then a range test; no daily table).
    rate_lookup: str = "daily"
    # Invoices and purchase-order items that hold this share of the vendor lines are
    # split over several tasks in the joins on them (found by one more pass over the
    # key columns). None leaves hot keys to AQE's skew join.
    hot_key_share: float | None = None
    # Write the merged invoice lines, joined to their headers, once for the two branches
    # of the payable fact (posted and parked); else each branch merges them again.
    share_invoice_lines: bool = True
    # Where the accounting lines read this many bytes or more, the joins of the payable fact
    # run as jobs of their own and their rows are stored: one job's shuffle files are gone when
    # the next begins, where a single plan keeps those of all joins. None: never.
    store_fact_bytes: int | None = 256 << 20
    # Write small dimensions (business days, fiscal periods, daily target rates,
    # currency decimals) once to the checkpoint folder and use them as leaves.
    materialize_dimensions: bool = True

    def today(self) -> Column:
        if self.as_of is None:
            return F.current_date()
        return F.lit(self.as_of)

    def previous_month_end(self) -> Column:
        """Last day of the month before ``today``."""
        return F.date_sub(F.trunc(self.today(), "MM"), 1)

    def rate_window_start(self) -> Column:
        return F.add_months(self.today(), -12 * self.rate_history_years)


# Settings the driver tables were shaped with (FIXTURES.md).
FIXTURE_CONFIG = LedgerConfig(
    as_of=dt.date(2001, 6, 30),
    calendar_start=dt.date(1994, 12, 1),
    calendar_end=dt.date(2002, 12, 31),
)
