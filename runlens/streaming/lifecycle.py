"""Lifecycle of jobs over an event stream.

Arrival order is truth: batches are taken in their order, and inside a batch rows count by
`message_id`. Keyed state lives in the RocksDB store, so it spills and survives lost executors; the
rows of one key that meet in a task are bounded by the size of a micro-batch (`maxFilesPerTrigger`).
`FirstTerminals` keeps its state in a table instead and uses joins that split hot jobs.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from runlens.functions import events as ev
from runlens.operators.lifecycle import loss_attribution
from runlens.operators.skew import lookup_join
from runlens.session import written

FIRST_RECORDED = "job_id string, first_record_id long"
FIRST_TERMINAL = ("job_id string, message_id long, ts timestamp_ntz, job_set string, loss_kind string, code int, "
                  "app_caused boolean, message string")


class FirstTerminals:
    """First terminal event of every known job, each exactly once, from micro-batches.

    Call it on every micro-batch. Two tables grow below `path`: the first recording of each job and
    the emitted outcomes. A batch writes its own `batch=n` folder with overwrite and reads only the
    folders of earlier batches, so a repeated batch changes nothing. Only new jobs add rows.
    """

    def __init__(self, path: str):
        self.recorded, self.outcomes = f"{path}/recorded", f"{path}/outcomes"
        self.batch_jobs, self.batch_keys = f"{path}/batch-jobs", f"{path}/batch-keys"

    def _before(self, spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], f"{schema}, batch long")
        return spark.read.schema(f"{schema}, batch long").parquet(path).filter(F.col("batch") < batch_id)

    def __call__(self, events: DataFrame, batch_id: int) -> None:
        spark = events.sparkSession
        kind = F.col("kind")
        fresh = events.filter(ev.is_recording(kind) | ev.is_terminal(kind))
        known = self._before(spark, self.recorded, FIRST_RECORDED, batch_id).select("job_id", "first_record_id")
        done = self._before(spark, self.outcomes, FIRST_TERMINAL, batch_id).select("job_id")

        in_batch = fresh.groupBy("job_id").agg(
            F.min(F.when(ev.is_recording(kind), F.col("message_id"))).alias("new_id"), F.count(F.lit(1)).alias("n_events"))
        # an earlier batch wins whatever the ids: it arrived first
        per_job = written(in_batch.join(known, "job_id", "left").select(
            "job_id", "n_events", "new_id", F.col("first_record_id").alias("old_id")), "batch-jobs", self.batch_jobs)
        (per_job.filter("old_id is null and new_id is not null")
         .select("job_id", F.col("new_id").alias("first_record_id"))
         .write.mode("overwrite").parquet(f"{self.recorded}/batch={batch_id}"))

        flagged = lookup_join(fresh, per_job, "job_id", ["old_id", "new_id"], "n_events", path=self.batch_keys)
        counts = F.col("old_id").isNotNull() | (F.col("message_id") >= F.col("new_id"))
        losses = loss_attribution(flagged.filter(counts))
        payload = F.struct("message_id", "ts", "job_set", "loss_kind", "code", "app_caused", "message")
        first = (losses.groupBy("job_id").agg(F.min_by(payload, "message_id").alias("f")).select("job_id", "f.*")
                 .join(done, "job_id", "left_anti"))
        first.write.mode("overwrite").parquet(f"{self.outcomes}/batch={batch_id}")

    def result(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{FIRST_TERMINAL}, batch long").parquet(self.outcomes).drop("batch")


TRANSITIONS = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("message_id", T.LongType()),
    T.StructField("transition", T.StringType()),
])


class Lifecycle(StatefulProcessor):
    """State of one job: recorded, submitted, registered, ended. Emits the transitions."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("job", "recorded boolean, submitted boolean, registered boolean, ended boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        recorded, submitted, registered, ended = self.state.get() if self.state.exists() else (False,) * 4
        for row in sorted(rows, key=lambda r: r["message_id"]):
            found = []
            if row["kind"] in ev.RECORDING and not recorded:
                recorded = True
                found.append("recorded")
            if ended or not recorded:
                pass
            elif row["kind"] == "submitted" and not submitted:
                submitted = True
                if not registered:
                    found.append("pending")
            elif row["kind"] == ev.REGISTRATION and not registered:
                registered = True
                found.append("registered")
            elif row["kind"] in ev.TERMINAL:
                ended = True
                found.append("terminal")
            for transition in found:
                yield Row(job_id=key[0], message_id=row["message_id"], transition=transition)
        self.state.update((recorded, submitted, registered, ended))

    def close(self) -> None:
        pass


def stream_lifecycle(events: DataFrame) -> DataFrame:
    """Transitions (job_id, message_id, transition) of known jobs."""
    kind = F.col("kind")
    relevant = events.filter(ev.is_recording(kind) | ev.is_terminal(kind)).select("job_id", "message_id", "kind")
    return relevant.groupBy("job_id").transformWithState(
        statefulProcessor=Lifecycle(), outputStructType=TRANSITIONS, outputMode="Append", timeMode="None")


TIMEOUTS = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("started_ms", T.LongType()),
    T.StructField("deadline_ms", T.LongType()),
])


class WatchTimeout(StatefulProcessor):
    """Reports a job with no terminal event within the limit after its first event."""

    def __init__(self, limit_ms: int):
        self.limit_ms = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("watch", "started_ms long, ended_ms long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old, ended = self.state.get() if self.state.exists() else (None, None)
        started = old
        for row in rows:
            if started is None or row["at_ms"] < started:
                started = row["at_ms"]
            if row["kind"] in ev.TERMINAL and (ended is None or row["at_ms"] < ended):
                ended = row["at_ms"]
        if started != old:
            if old is not None:
                self.handle.deleteTimer(old + self.limit_ms)
            self.handle.registerTimer(started + self.limit_ms)
        self.state.update((started, ended))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        started, ended = self.state.get()
        deadline = started + self.limit_ms
        if ended is None or ended > deadline:
            yield Row(job_id=key[0], started_ms=started, deadline_ms=deadline)

    def close(self) -> None:
        pass


def stream_watch_timeout(events: DataFrame, limit_ms: int, delay: str = "0 seconds") -> DataFrame:
    """(job_id, started_ms, deadline_ms) of the jobs that time out; a limit of 0 means never."""
    timed = events.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", delay)
    rows = timed.select("job_id", "kind", F.unix_millis("event_time").alias("at_ms"), "event_time")
    if limit_ms == 0:
        return rows.select("job_id", F.col("at_ms").alias("started_ms"), F.col("at_ms").alias("deadline_ms")).filter(F.lit(False))
    return rows.groupBy("job_id").transformWithState(
        statefulProcessor=WatchTimeout(limit_ms), outputStructType=TIMEOUTS, outputMode="Append", timeMode="EventTime")


def stream_state_counts(events: DataFrame, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Events and losses per effective kind and tumbling window, when the window is closed."""
    kind = F.col("kind")
    full = ev.failure_reason(F.col("reason"), F.col("cause"))
    rows = events.select(
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(kind == "failed", ev.effective_kind(kind, full)).otherwise(kind).alias("kind"), "exit_codes")
    by_app = ev.app_caused(kind, ev.loss_code(kind, F.col("exit_codes")))
    counts = rows.withWatermark("event_time", delay).groupBy(F.window("event_time", window), "kind").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(ev.is_terminal(kind)).alias("n_losses"),
        F.count_if(by_app).alias("n_app_caused"))
    return counts.select(F.unix_millis("window.start").alias("window_ms"), "kind", "n_events", "n_losses", "n_app_caused")


PAIRS = T.StructType([
    T.StructField("message_id", T.LongType()),
    T.StructField("job_id", T.StringType()),
    T.StructField("terminal_id", T.LongType()),
    T.StructField("gap_us", T.LongType()),
    T.StructField("within_grace", T.BooleanType()),
])


def _micros(delta) -> int:
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


class Decommission(StatefulProcessor):
    """Keeps the open preemption notices of a job until its terminal event."""

    def __init__(self, grace_ms: int):
        self.grace_ms = grace_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("job", "recorded boolean, ended boolean")
        self.notices = handle.getListState("notices", "message_id long, ts timestamp_ntz")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        recorded, ended = self.state.get() if self.state.exists() else (False, False)
        for row in sorted(rows, key=lambda r: r["message_id"]):
            recorded = recorded or row["kind"] in ev.RECORDING
            if ended or not recorded:
                continue
            if row["kind"] == "preempting":
                self.notices.appendValue((row["message_id"], row["ts"]))
            elif row["kind"] in ev.TERMINAL:
                ended = True
                yield from self._pairs(key[0], row["message_id"], row["ts"])
                self.notices.clear()
        self.state.update((recorded, ended))

    def _pairs(self, job_id: str, terminal_id: int, ts: datetime) -> Iterator[Row]:
        if self.notices.exists():
            for message_id, noticed in self.notices.get():
                gap = _micros(ts - noticed)
                yield Row(message_id=message_id, job_id=job_id, terminal_id=terminal_id, gap_us=gap,
                          within_grace=gap <= self.grace_ms * 1000)

    def close(self) -> None:
        pass


def stream_decommission(events: DataFrame, grace_ms: int = 180_000) -> DataFrame:
    """Preemption notices paired with the terminal event that ends their job."""
    kind = F.col("kind")
    relevant = events.filter(ev.is_recording(kind) | ev.is_terminal(kind) | (kind == "preempting"))
    return relevant.select("job_id", "message_id", "ts", "kind").groupBy("job_id").transformWithState(
        statefulProcessor=Decommission(grace_ms), outputStructType=PAIRS, outputMode="Append", timeMode="None")
