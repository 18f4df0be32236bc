"""A small lookup sent to all tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from runlens.operators.skew import broadcast_if_small

MAX_LOOKUP_ROWS, MAX_LOOKUP_BYTES = 1_000_000, 64 << 20


def distribute_lookup(requests: DataFrame, lookup: DataFrame, key: str = "line_no",
                      max_rows: int = MAX_LOOKUP_ROWS, max_bytes: int = MAX_LOOKUP_BYTES) -> DataFrame:
    """Each request gets the lookup line of its number; a lookup too large to send is shuffled."""
    return requests.join(broadcast_if_small(lookup, max_rows, max_bytes), key)
