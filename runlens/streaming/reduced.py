"""Streams in two steps: every micro-batch is reduced to one row per job by the batch operators, then keyed state reads those rows.

The first step (`Reducer`, for `foreachBatch`) writes `batch=n` folders of `REDUCED` rows. It looks at its own batch only, so its cost does
not grow with history, and a job with any share of the events is handled by joins that split it. The second step streams
that folder. A job has one row per batch there, so what meets in a task is bounded by the number of batches, and the state of
a job is a few numbers in the RocksDB store.

Arrival decides: an earlier batch wins over a later one whatever the ids; inside a batch the id counts. A repeated batch changes nothing: the state of
a job names the last batch it took.

The keyed streams take an initial state made from the history by the batch operators (`initial_states`), so that a stream can start where a
table ends; `stored_states` reads the state of a running or stopped stream out of its checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, GroupedData, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from runlens.functions import events as ev
from runlens.operators.lifecycle import first_recorded, job_states, loss_attribution
from runlens.operators.skew import HOT_ROWS, lookup_join

LOSS = "message_id long, ts timestamp_ntz, job_set string, loss_kind string, code int, app_caused boolean, message string"
REDUCED = ("job_id string, job_set string, record_id long, submit_id long, register_id long, first_ms long, last_ms long, end_ms long, "
           f"any_end struct<{LOSS.replace(' ', ':').replace(',:', ',')}>, known_end struct<{LOSS.replace(' ', ':').replace(',:', ',')}>")
STATE = "recorded long, submitted long, registered long, ended long, batch long"


def reduced(events: DataFrame, hot_rows: int = HOT_ROWS, path: str | None = None) -> DataFrame:
    """One row per job of a batch of events: least ids of its recording, submission and registration, first and last time, and two ends with
    their loss attribution: the first terminal event (`any_end`), and the first one after the recording in this batch (`known_end`)."""
    kind, mid = F.col("kind"), F.col("message_id")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    flagged = lookup_join(events.select("job_id", "job_set", "message_id", "kind", ms.alias("ms")), first_recorded(events), "job_id",
                          ["first_record_id"], "n_events", hot_rows=hot_rows, path=path)
    end = F.when(ev.is_terminal(kind), mid)
    # a job belongs to one set; as a grouping column it keeps the buffers free of text
    per_job = flagged.groupBy("job_id", "job_set").agg(
        F.min("first_record_id").alias("record_id"), F.min(F.when(kind == "submitted", mid)).alias("submit_id"),
        F.min(F.when(kind == ev.REGISTRATION, mid)).alias("register_id"), F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"),
        F.min(F.when(ev.is_terminal(kind), F.col("ms"))).alias("end_ms"),
        F.min(end).alias("any_id"), F.min(F.when(mid >= F.col("first_record_id"), end)).alias("known_id"))
    # only the chosen events bring their texts
    fields = [f.split()[0] for f in LOSS.split(", ")]
    losses = loss_attribution(events).select(F.col("message_id").alias("_id"), F.struct(*fields).alias("_loss"))
    for found, at in (("any_end", "any_id"), ("known_end", "known_id")):
        per_job = per_job.join(losses, F.col(at) == F.col("_id"), "left").drop("_id", at).withColumnRenamed("_loss", found)
    return per_job


class Reducer:
    """Writes each micro-batch of events reduced below `path`, in at most `files` files. A repeated batch replaces its own folder.

    A stream that takes `files` files per trigger takes a whole batch at once: every trigger starts a Python worker and a
    state store for each shuffle partition, whatever it reads.
    """

    def __init__(self, path: str, hot_rows: int = HOT_ROWS, files: int = 64):
        self.path, self.keys, self.hot_rows, self.files = f"{path}/jobs", f"{path}/batch-keys", hot_rows, files

    def __call__(self, events: DataFrame, batch_id: int) -> None:
        reduced(events, self.hot_rows, self.keys).coalesce(self.files).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def stream(self, spark: SparkSession, files_per_trigger: int) -> DataFrame:
        return spark.readStream.schema(f"{REDUCED}, batch long").option("maxFilesPerTrigger", files_per_trigger).parquet(self.path)


class _JobState(StatefulProcessor):
    """Least ids of a job, merged batch by batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("job", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((*(initialState[c] for c in ("recorded", "submitted", "registered", "ended")), -1))

    def _steps(self, rows: Iterator[Row]) -> Iterator[tuple[Row, tuple, tuple, Row | None]]:
        """Each batch of the job with the state before and after it, and the terminal event if the job ends in it."""
        # every call goes to the state server and back: `get` alone tells whether there is a state
        *state, done = self.state.get() or (None, None, None, None, -1)
        for row in sorted(rows, key=lambda r: r["batch"]):
            if row["batch"] <= done:
                continue  # a batch that was written again
            done = row["batch"]
            recorded, submitted, registered, ended = before = state
            end = row["any_end"] if recorded is not None else row["known_end"]
            end = None if ended is not None else end
            last = end["message_id"] if end is not None else None

            def counts(at: int | None, old: int | None, last=last, ended=ended) -> int | None:
                return old if old is not None or at is None or ended is not None or (last is not None and at > last) else at

            state = (row["record_id"] if recorded is None else recorded, counts(row["submit_id"], submitted),
                     counts(row["register_id"], registered), last if ended is None else ended)
            yield row, before, state, end
        self.state.update((*state, done))

    def close(self) -> None:
        pass


class Transitions(_JobState):
    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for _, before, after, _ in self._steps(rows):
            names = ("recorded", "pending", "registered", "terminal")
            for name, old, new in zip(names, before, after, strict=True):
                # a submission after the registration makes nothing pending
                late = name == "pending" and after[2] is not None and (before[2] is not None or (new is not None and after[2] < new))
                if old is None and new is not None and not late:
                    yield Row(job_id=key[0], message_id=new, transition=name)


class Ends(_JobState):
    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for _, _, after, end in self._steps(rows):
            if end is not None:
                yield Row(job_id=key[0], record_id=after[0], **(end if isinstance(end, dict) else end.asDict()))


class Changes(_JobState):
    """What each event does to the counts of its set: recorded, registered, pending, active."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for row, before, after, _ in self._steps(rows):
            new = [b if a is None else None for a, b in zip(before, after, strict=True)]
            recorded, submitted, registered, ended = new
            waited = before[1] is not None or (submitted is not None and (after[2] is None or submitted < after[2]))
            steps = []
            if recorded is not None:
                steps.append((recorded, 1, 0, 0, 1))
            if submitted is not None and before[2] is None and waited:
                steps.append((submitted, 0, 0, 1, 0))
            if registered is not None:
                steps.append((registered, 0, 1, -int(waited), 0))
            if ended is not None:
                steps.append((ended, 0, -int(after[2] is not None), -int(after[2] is None and after[1] is not None), -1))
            for message_id, *change in steps:
                yield Row(job_id=key[0], job_set=row["job_set"], message_id=message_id, d_recorded=change[0], d_registered=change[1],
                          d_pending=change[2], d_active=change[3])


class Overdue(StatefulProcessor):
    """Reports a job with no terminal event within the limit after its first event."""

    def __init__(self, limit_ms: int):
        self.limit_ms = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("watch", "started_ms long, ended_ms long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old, ended = self.state.get() or (None, None)
        started = old
        for row in rows:
            started = row["first_ms"] if started is None else min(started, row["first_ms"])
            if row["end_ms"] is not None:
                ended = row["end_ms"] if ended is None else min(ended, row["end_ms"])
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


def initial_states(events: DataFrame) -> GroupedData:
    """The state that a stream would have after `events`, for `transitions` and `ends`."""
    j, never = job_states(events), F.lit(2**63 - 1)
    end = F.coalesce(F.col("terminal_id"), never)

    def before_end(name: str) -> Column:
        return F.when(F.col(name) < end, F.col(name))

    return j.select("job_id", F.col("record_id").alias("recorded"), before_end("submit_id").alias("submitted"),
                    before_end("register_id").alias("registered"), F.col("terminal_id").alias("ended")).groupBy("job_id")


def _keyed(rows: DataFrame, processor: StatefulProcessor, schema: str, start: GroupedData | None) -> DataFrame:
    return rows.groupBy("job_id").transformWithState(statefulProcessor=processor, outputStructType=T._parse_datatype_string(schema),
                                                     outputMode="Append", timeMode="None", initialState=start)


def transitions(rows: DataFrame, start: GroupedData | None = None) -> DataFrame:
    """(job_id, message_id, transition) of known jobs from a stream of reduced rows."""
    # other rows change no state
    rows = rows.filter(F.col("record_id").isNotNull() | F.col("any_end").isNotNull())
    narrow = rows.withColumns({c: F.struct(F.col(f"{c}.message_id")) for c in ("any_end", "known_end")})
    narrow = narrow.withColumns({c: F.when(F.col(f"{c}.message_id").isNotNull(), F.col(c)) for c in ("any_end", "known_end")})
    return _keyed(narrow.select("batch", "job_id", "record_id", "submit_id", "register_id", "any_end", "known_end"), Transitions(),
                  "job_id string, message_id long, transition string", start)


def ends(rows: DataFrame, start: GroupedData | None = None) -> DataFrame:
    """The first terminal event of every known job, once, with its loss attribution and the id of the job's recording."""
    acting = F.col("record_id").isNotNull() | F.col("any_end").isNotNull()
    return _keyed(rows.filter(acting).select("batch", "job_id", "record_id", "submit_id", "register_id", "any_end", "known_end"), Ends(),
                  f"job_id string, record_id long, {LOSS}", start)


def changes(rows: DataFrame, start: GroupedData | None = None) -> DataFrame:
    """(job_id, job_set, message_id, d_recorded, d_registered, d_pending, d_active) of known jobs, several rows an event where it does several things."""
    acting = F.col("record_id").isNotNull() | F.col("any_end").isNotNull()
    return _keyed(rows.filter(acting).select("batch", "job_id", "job_set", "record_id", "submit_id", "register_id", "any_end", "known_end"), Changes(),
                  "job_id string, job_set string, message_id long, d_recorded long, d_registered long, d_pending long, d_active long", start)


def overdue(rows: DataFrame, limit_ms: int, delay: str = "0 seconds") -> DataFrame:
    """(job_id, started_ms, deadline_ms) of the jobs that time out; a limit of 0 means never."""
    timed = rows.withColumn("event_time", F.timestamp_millis("last_ms")).withWatermark("event_time", delay)
    if limit_ms == 0:
        return timed.select("job_id", F.col("first_ms").alias("started_ms"), F.col("first_ms").alias("deadline_ms")).filter(F.lit(False))
    return timed.select("job_id", "first_ms", "end_ms", "event_time").groupBy("job_id").transformWithState(
        statefulProcessor=Overdue(limit_ms), outputStructType=T._parse_datatype_string("job_id string, started_ms long, deadline_ms long"),
        outputMode="Append", timeMode="EventTime")


def replay_delay(events: DataFrame) -> str:
    """A delay that no row of a table exceeds, in whatever order its files are replayed."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    span = events.agg(F.max(ms) - F.min(ms)).first()[0] or 0
    # the watermark is in whole milliseconds, and a row exactly on it counts as late
    return f"{span + 1000} milliseconds"


def decommissions(events: DataFrame, ended: DataFrame, horizon_ms: int, grace_ms: int, delay: str = "1 hour") -> DataFrame:
    """Preemption notices with the event that ends their job at most `horizon_ms` later, as an interval join of two streams.

    `events` is the stream of events, `ended` the stream of what `ends` emits. A notice counts between the job's recording and its end.
    Arrival is the order of the ids; the clock of an end may run up to `delay` behind that of its notice. Either side waits in the state store
    until the watermark shows that no partner can come: a notice for the horizon, an end for `delay`. Rows that come `delay` or more behind the
    newest of their stream are not paired, so `delay` has to cover the disorder of both streams: files of one batch that do not fit one
    trigger are in no order, and neither is a table that is replayed (see `replay_delay`).
    """
    notices = events.filter(F.col("kind") == "preempting").select(
        "message_id", "job_id", F.col("ts").cast("timestamp").alias("noticed")).withWatermark("noticed", delay)
    finished = ended.select(F.col("job_id").alias("_job"), "record_id", F.col("message_id").alias("terminal_id"),
                            F.col("ts").cast("timestamp").alias("finished")).withWatermark("finished", delay)
    inside = F.expr(f"job_id = _job and finished >= noticed - interval {delay} and finished <= noticed + interval {horizon_ms} milliseconds")
    gap = F.unix_micros("finished") - F.unix_micros("noticed")
    return notices.join(finished, inside).filter(F.col("message_id").between(F.col("record_id"), F.col("terminal_id"))).select(
        "message_id", "job_id", "terminal_id", gap.alias("gap_us"), (gap <= grace_ms * 1000).alias("within_grace"))


def stored_states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(job_id, recorded, submitted, registered, ended) out of the checkpoint of `transitions` or `ends`, after its last batch."""
    stored = spark.read.format("statestore").option("stateVarName", "job").load(checkpoint)
    return stored.select("key.job_id", "value.*").drop("batch")


def active_jobs(states: DataFrame) -> DataFrame:
    return states.filter("recorded is not null and ended is null").select("job_id", F.col("recorded").alias("record_id"))


def pending_jobs(states: DataFrame) -> DataFrame:
    return states.filter("ended is null and submitted is not null and registered is null").select("job_id", F.col("submitted").alias("submit_id"))
