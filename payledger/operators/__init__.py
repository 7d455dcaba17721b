"""Reusable DataFrame operators (joins, intervals, ranking, upsert, descriptions)."""

from payledger.operators.describe import attach_descriptions
from payledger.operators.intervals import explode_days, validity_interval
from payledger.operators.joins import broadcast_if_small, bounded_broadcast, left_join_salted_nulls
from payledger.operators.ranking import keep_first_rank
from payledger.operators.upsert import upsert

__all__ = [
    "attach_descriptions",
    "bounded_broadcast",
    "broadcast_if_small",
    "explode_days",
    "keep_first_rank",
    "left_join_salted_nulls",
    "upsert",
    "validity_interval",
]
