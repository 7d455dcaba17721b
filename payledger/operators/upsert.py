"""MERGE-style upsert for plain file tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], check_unique: bool = False) -> DataFrame:
    """Matched keys take the source row, unmatched source rows are inserted,
    target rows without a source match are kept; nothing is deleted.

    ``check_unique`` runs one aggregation to reject a source with repeated
    keys (a MERGE would fail on several matches for one target row).
    """
    if check_unique:
        dup = source.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
        if dup:
            raise DuplicateKeyError(f"source has repeated keys {list(keys)}")
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return source.select(*target.columns).unionByName(kept)
