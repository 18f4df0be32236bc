"""Demand for executors as of each tick: the targets and counts that hold at that time, not those of some later state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from runlens.functions import capacity as cap
from runlens.operators.asof import as_of
from runlens.operators.lifecycle import running_counts
from runlens.operators.skew import HOT_ROWS, lookup_join
from runlens.session import written


def counts_over_time(events: DataFrame) -> DataFrame:
    """(job_set, ts, message_id, registered, pending, active) after each state-changing event."""
    times = events.select(F.col("message_id").alias("_id"), "ts")
    return running_counts(events).join(times, F.col("message_id") == F.col("_id")).drop("_id")


def gap_as_of(ticks: DataFrame, targets: DataFrame, counts: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Ticks (job_set, ts, ...) by the profiles of their set, with target, cardinality, registered, pending and gap at that time.

    `targets` (job_set, profile, ts, message_id, target, cardinality) says from when a target holds; `counts` is what
    `counts_over_time` gives. A profile without a target yet is left out; a set without a recorded job has counts of 0. The counts
    are those of the whole set, for every profile.
    """
    profiles = targets.groupBy("job_set").agg(F.array_sort(F.collect_set("profile")).alias("profiles"))
    per_set = ticks.groupBy("job_set").agg(F.count(F.lit(1)).alias("n_ticks")).join(profiles, "job_set", "left")
    counted = as_of(ticks, counts, ["job_set"], "ts", ["registered", "pending"], tie="message_id")
    each = lookup_join(counted, per_set, "job_set", ["profiles"], "n_ticks", hot_rows=hot_rows)
    each = each.withColumn("profile", F.explode("profiles")).drop("profiles")
    found = as_of(each, targets, ["job_set", "profile"], "ts", ["target", "cardinality"], tie="message_id").filter("target is not null")
    for name in ("registered", "pending"):
        found = found.withColumn(name, F.coalesce(name, F.lit(0)))
    return found.withColumn("gap", cap.gap(F.col("target"), F.col("registered"), F.col("pending")))


def allocate_as_of(gaps: DataFrame, initial: DataFrame, ratio: float = 0.8, batch: int = cap.BATCH_SIZE, max_pending: int = cap.MAX_PENDING,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add `ready`, `allowed` and `n`, the executors to ask for, to what `gap_as_of` gives; `initial` is (job_set, initial)."""
    gaps = written(gaps, "gaps")
    per_set = gaps.groupBy("job_set").agg(F.count(F.lit(1)).alias("n_gaps")).join(initial, "job_set", "left")
    known = lookup_join(gaps, per_set, "job_set", ["initial"], "n_gaps", hot_rows=hot_rows)
    ready = F.col("registered") >= F.coalesce("initial", F.lit(0)) * F.lit(ratio)
    allowed = cap.may_allocate(F.col("gap"), F.col("registered"), F.col("pending"), F.col("ready"), max_pending)
    asked = F.when(F.col("allowed"), cap.to_allocate(F.col("gap"), F.col("cardinality"), batch)).otherwise(F.lit(0).cast("long"))
    return known.withColumn("ready", ready).withColumn("allowed", allowed).withColumn("n", asked)
