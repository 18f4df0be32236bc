"""Joins of a large table with a table that has one row per key, safe for very hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from runlens.session import written

# A key with more rows than this is joined by broadcast. There can be at most
# total_rows / HOT_ROWS such keys, so the broadcast side stays small whatever the skew.
HOT_ROWS = 1_000_000
# What is sent to all tasks, as JSON, unless a caller says otherwise.
MAX_SENT_BYTES = 64 << 20


def lookup_join(facts: DataFrame, per_key: DataFrame, key: str, payload: list[str], rows: str,
                hot_rows: int = HOT_ROWS, path: str | None = None) -> DataFrame:
    """Left join of `facts` with `per_key` (unique on `key`), adding the `payload` columns.

    `rows` names the column of `per_key` that holds the number of fact rows of the key; keys that
    may be hot must be in it. The table per key is written once (to `path`, if given). If it has hot keys, their facts are
    answered by a broadcast join where they are; all other facts are shuffled on the key.
    """
    per_key = per_key.filter(F.col(key).isNotNull())
    present = written(per_key.select(F.col(key).alias("_key"), F.col(rows).alias("_rows"), *payload), "per-key", path)
    matches = F.col(key) == F.col("_key")
    columns = [*facts.columns, *payload]
    hot = present.filter(F.col("_rows") > hot_rows)
    if hot.isEmpty():
        return facts.join(present, matches, "left").select(*columns)
    hot = F.broadcast(hot)
    answered = facts.join(hot, matches).select(*columns)
    others = facts.join(hot.select("_key"), matches, "left_anti").join(present, matches, "left").select(*columns)
    return answered.unionByName(others)


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_SENT_BYTES) -> DataFrame:
    """Broadcast `df` if it has at most `max_rows` rows of at most `max_bytes` in all, written as JSON; beyond that leave the join to the planner."""
    size = df.select(F.octet_length(F.to_json(F.struct("*"))).alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if size["rows"] <= max_rows and size["bytes"] <= max_bytes else df
