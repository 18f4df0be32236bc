"""Lifecycle of jobs from their ordered event stream.

Input: events(message_id, ts, kind, job_id, job_set, reason, cause, exit_codes) in arrival order of
`message_id`. A job counts only from its first recording event on; its first terminal event wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runlens.functions import events as ev
from runlens.operators.scans import WIDTH, dense_rank_ids, running_totals
from runlens.operators.skew import HOT_ROWS, lookup_join
from runlens.session import written


def micros_between(start: str, end: str) -> Column:
    return F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))


def first_recorded(events: DataFrame) -> DataFrame:
    """(job_id, first_record_id, n_events); the id is null for a job never recorded."""
    return events.groupBy("job_id").agg(
        F.min(F.when(ev.is_recording(F.col("kind")), F.col("message_id"))).alias("first_record_id"),
        F.count(F.lit(1)).alias("n_events"),
    )


def flag_known(events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add `known`: the job was recorded by this event or an earlier one."""
    flagged = lookup_join(events, first_recorded(events), "job_id", ["first_record_id"], "n_events", hot_rows=hot_rows)
    known = F.coalesce(F.col("message_id") >= F.col("first_record_id"), F.lit(False))
    return flagged.withColumn("known", known)


def known_events(events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    return flag_known(events, hot_rows).filter("known").drop("known", "first_record_id")


def unknown_events(events: DataFrame) -> DataFrame:
    """Events that act on a job and are ignored because the job is not known yet."""
    acting = F.col("kind").isin("running", "preempting", *ev.TERMINAL)
    return flag_known(events).filter(~F.col("known") & acting).drop("known", "first_record_id")


def exclude_drivers(events: DataFrame, drivers: DataFrame) -> DataFrame:
    return events.join(drivers.select("job_id"), "job_id", "left_anti")


def executor_events(events: DataFrame, drivers: DataFrame | None = None, kills: DataFrame | None = None) -> DataFrame:
    """What a scheduler records: no driver's events, and nothing that ends an executor after it was asked to be killed.

    `kills` (job_id, kill_id, and kill_ts if known) names requests by their place among the message ids. The first request between a job's recording and its
    first terminal event ends the executor at once: a row `cancelled` that says so takes the place of the job's terminal events from there on.
    Earlier and later requests do nothing. The result feeds every other operator of this module.
    """
    if drivers is not None:
        events = exclude_drivers(events, drivers)
    if kills is None:
        return events
    asked = kills.select("job_id", "kill_id", (F.col("kill_ts") if "kill_ts" in kills.columns else F.lit(None)).cast(events.schema["ts"].dataType).alias("kill_ts"))
    known = asked.groupBy("job_id").agg(F.count(F.lit(1)).alias("n_kills")).join(job_states(events).select("job_id", "job_set", "record_id", "terminal_id"), "job_id")
    counted = lookup_join(asked, known, "job_id", ["job_set", "record_id", "terminal_id"], "n_kills").filter(
        (F.col("kill_id") >= F.col("record_id")) & (F.col("terminal_id").isNull() | (F.col("kill_id") <= F.col("terminal_id"))))
    first = written(counted.groupBy("job_id", "job_set").agg(F.min_by("kill_ts", "kill_id").alias("kill_ts"), F.min("kill_id").alias("kill_id")), "kills")
    sizes = events.groupBy("job_id").agg(F.count(F.lit(1)).alias("n_events")).join(first.select("job_id", "kill_id"), "job_id")
    marked = lookup_join(events, sizes, "job_id", ["kill_id"], "n_events")
    late = ev.is_terminal(F.col("kind")) & (F.col("message_id") >= F.col("kill_id"))
    requests = first.select(F.col("kill_id").alias("message_id"), F.col("kill_ts").alias("ts"), "job_id", "job_set", F.lit("cancelled").alias("kind"),
                            F.lit(ev.KILLED).alias("reason"))
    kept = marked.filter(~F.coalesce(late, F.lit(False))).drop("kill_id")
    return kept.unionByName(requests.select([c for c in requests.columns if c in events.columns]), allowMissingColumns=True)


def loss_attribution(events: DataFrame) -> DataFrame:
    """Terminal events with (loss_kind, code, app_caused, message)."""
    kind, loss_kind = F.col("kind"), F.col("loss_kind")
    full = ev.failure_reason(F.col("reason"), F.col("cause"))
    code = ev.loss_code(loss_kind, F.col("exit_codes"))
    return (events.filter(ev.is_terminal(kind)).withColumn("loss_kind", ev.effective_kind(kind, full))
            .select("message_id", "ts", "job_set", "job_id", "loss_kind", code.alias("code"),
                    ev.app_caused(loss_kind, code).alias("app_caused"),
                    ev.loss_message(kind, loss_kind, full, F.col("job_id")).alias("message")))


def _narrow_losses(events: DataFrame) -> DataFrame:
    """Terminal events of known jobs as (message_id, job_id, outcome), one number per outcome.

    The outcome is made before the join, so no text is shuffled or kept in a buffer.
    """
    kind, loss_kind = F.col("kind"), F.col("loss_kind")
    full = ev.failure_reason(F.col("reason"), F.col("cause"))
    by_app = ev.app_caused(loss_kind, ev.loss_code(loss_kind, F.col("exit_codes")))
    narrow = (events.filter(ev.is_terminal(kind) | ev.is_recording(kind))
              .withColumn("loss_kind", ev.effective_kind(kind, full))
              .select("message_id", "job_id", "kind",
                      (F.array_position(_terminal_kinds(), loss_kind) * 2 + by_app.cast("long")).alias("outcome")))
    return known_events(narrow).filter(ev.is_terminal(kind)).select("message_id", "job_id", "outcome")


def _terminal_kinds() -> Column:
    return F.array(*[F.lit(k) for k in ev.TERMINAL])


def _loss_kind(outcome: Column) -> Column:
    return F.element_at(_terminal_kinds(), F.call_function("div", outcome, F.lit(2)).cast("int"))


def first_terminal(events: DataFrame) -> DataFrame:
    """The first terminal event of every known job, with its loss attribution."""
    relevant = events.filter(ev.is_terminal(F.col("kind")) | ev.is_recording(F.col("kind")))
    losses = loss_attribution(known_events(relevant))
    payload = F.struct("message_id", "ts", "job_set", "loss_kind", "code", "app_caused", "message")
    return (losses.groupBy("job_id").agg(F.min_by(payload, "message_id").alias("first"))
            .select("job_id", "first.*"))


def loss_summary(events: DataFrame) -> DataFrame:
    """Jobs per kind of their first terminal event and whether the application caused it."""
    per_job = _narrow_losses(events).groupBy("job_id").agg(F.min_by("outcome", "message_id").alias("outcome"))
    return per_job.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_jobs")).select(
        _loss_kind(F.col("outcome")).alias("loss_kind"), (F.col("outcome") % 2 == 1).alias("app_caused"), "n_jobs")


def first_terminal_times(events: DataFrame) -> DataFrame:
    """(job_id, record_id, terminal_id, terminal_ts) of every known job that has ended."""
    kind = F.col("kind")
    relevant = events.filter(ev.is_terminal(kind) | ev.is_recording(kind))
    end = F.when(ev.is_terminal(kind), F.col("message_id"))
    return known_events(relevant.select("job_id", "kind", "message_id", "ts")).groupBy("job_id").agg(
        F.min("message_id").alias("record_id"), F.min(end).alias("terminal_id"),
        F.min_by("ts", end).alias("terminal_ts")).filter("terminal_id is not null")


def loss_totals(events: DataFrame) -> DataFrame:
    """Terminal events of known jobs per kind: events, jobs, and the share caused by the application."""
    by_app = F.col("outcome") % 2 == 1
    return _narrow_losses(events).groupBy(_loss_kind(F.col("outcome")).alias("loss_kind")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(by_app).alias("n_app_caused"),
        F.count_if(~by_app).alias("n_external"),
        F.countDistinct("job_id").alias("n_jobs"),
    )


def job_states(events: DataFrame) -> DataFrame:
    """One row per recorded job with the ids of its first events; the base of all state sets.

    Only integers are aggregated, so this is one hash aggregate with map-side combine.
    """
    kind, mid = F.col("kind"), F.col("message_id")
    relevant = events.filter(ev.is_terminal(kind) | ev.is_recording(kind)).select(
        "job_set", "job_id", "kind", "message_id")
    # a job belongs to one set; as a grouping column it keeps the buffers free of text
    per_job = known_events(relevant).groupBy("job_id", "job_set").agg(
        F.min(F.when(ev.is_recording(kind), mid)).alias("record_id"),
        F.min(F.when(kind == "submitted", mid)).alias("submit_id"),
        F.min(F.when(kind == ev.REGISTRATION, mid)).alias("register_id"),
        F.min(F.when(ev.is_terminal(kind), mid)).alias("terminal_id"),
    )
    never = F.lit(2**63 - 1)
    end = F.coalesce(F.col("terminal_id"), never)
    ended = F.col("terminal_id").isNotNull()
    submitted = F.coalesce(F.col("submit_id") < end, F.lit(False))
    registered = F.coalesce(F.col("register_id") < end, F.lit(False))
    return per_job.select(
        "*",
        (~ended).alias("active"),
        (submitted & ~registered & ~ended).alias("pending"),
        (registered & ~ended).alias("registered"),
    )


def active_set(events: DataFrame) -> DataFrame:
    return job_states(events).filter("active").select("job_id", "record_id")


def pending_set(events: DataFrame) -> DataFrame:
    return job_states(events).filter("pending").select("job_id", "submit_id")


def state_counts(events: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(registered, pending, active, terminal) as one snapshot, for all jobs or per `by`."""
    return job_states(events).groupBy(*(by or [])).agg(
        F.count_if("registered").alias("registered"),
        F.count_if("pending").alias("pending"),
        F.count_if("active").alias("active"),
        F.count_if(~F.col("active")).alias("terminal"),
    )


def readiness(events: DataFrame, initial: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Per job set of initial(job_set, initial): are enough of the configured executors registered now?

    An executor that has ended counts no more, nor does one that registers after its end.
    """
    per_set = job_states(events).groupBy("job_set").agg(F.count_if("registered").alias("registered"))
    found = initial.join(per_set, "job_set", "left").withColumn("registered", F.coalesce("registered", F.lit(0)))
    return found.select("job_set", "initial", "registered", (F.col("registered") >= F.col("initial") * F.lit(ratio)).alias("ready"))


def kill_noop(kills: DataFrame, events: DataFrame, grace_ms: int = 5_000) -> DataFrame:
    """What a kill request (job_id, kill_id, kill_ts) meets when its grace period ends.

    `noop`: the job ended within the grace period; `already_terminal`: it had ended before;
    `cancelled`: it is still there (or ends later) and the cancel takes effect.
    """
    ends = first_terminal_times(events).select("job_id", "terminal_ts")
    sizes = kills.groupBy("job_id").agg(F.count(F.lit(1)).alias("n_kills"))
    per_job = sizes.join(ends, "job_id", "left")
    joined = lookup_join(kills, per_job, "job_id", ["terminal_ts"], "n_kills")
    after = micros_between("kill_ts", "terminal_ts")
    outcome = (
        F.when(F.col("terminal_ts").isNull() | (after > grace_ms * 1000), "cancelled")
        .when(after >= 0, "noop")
        .otherwise("already_terminal")
    )
    return joined.select(*kills.columns, outcome.alias("outcome"))


def executor_ids(events: DataFrame, by: list[str] | None = None, width: int = WIDTH) -> DataFrame:
    """(job_id, executor_id): 1, 2, 3, ... in order of first recording, globally or per `by`."""
    first = (events.filter(ev.is_recording(F.col("kind")))
             .groupBy("job_id", *(by or [])).agg(F.min("message_id").alias("record_id")))
    return dense_rank_ids(written(first, "first-recorded"), by or [], "record_id", "executor_id", width)


def jobs_of_executors(requests: DataFrame, ids: DataFrame) -> DataFrame:
    """Job ids of the requested executor ids; unknown ids are dropped."""
    return requests.join(ids.select("executor_id", "job_id"), "executor_id")


def decommission_pairs(events: DataFrame, grace_ms: int = 180_000) -> DataFrame:
    """Each `preempting` of a known job with the terminal event that ends the job after it."""
    notices = events.filter(F.col("kind") == "preempting").select("message_id", "ts", "job_id")
    sizes = notices.groupBy("job_id").agg(F.count(F.lit(1)).alias("n_notices"))
    ends = first_terminal_times(events)
    # jobs without an end stay in the table, so that a hot one among them is recognised
    per_job = sizes.join(ends, "job_id", "left")
    joined = lookup_join(notices, per_job, "job_id", ["record_id", "terminal_id", "terminal_ts"], "n_notices")
    gap = micros_between("ts", "terminal_ts")
    return joined.filter(F.col("message_id").between(F.col("record_id"), F.col("terminal_id"))).select(
        "message_id", "job_id", "terminal_id", gap.alias("gap_us"), (gap <= grace_ms * 1000).alias("within_grace"))


def driver_outcome(events: DataFrame, drivers: DataFrame) -> DataFrame:
    """Terminal state of each driver job: its first terminal event."""
    state = ev.driver_state(F.col("kind"), F.col("reason"))
    return (
        events.filter(ev.is_terminal(F.col("kind")))
        .join(drivers.select("job_id"), "job_id", "left_semi")
        .groupBy("job_id").agg(F.min_by(state, "message_id").alias("outcome"))
        .select("job_id", "outcome.state", "outcome.reason")
    )


def events_after(events: DataFrame, last_id: Column | int) -> DataFrame:
    """Events after the last processed id; the filter reaches the scan."""
    return events.filter(F.col("message_id") > last_id)


def resume_points(events: DataFrame) -> DataFrame:
    """Highest message id and number of events per job set."""
    return events.groupBy("job_set").agg(
        F.max("message_id").alias("last_id"), F.count(F.lit(1)).alias("n_events"))


def resume_from(events: DataFrame, points: DataFrame) -> DataFrame:
    """Events of each job set after its own resume point (job_set, last_id, n_events)."""
    joined = lookup_join(events, points, "job_set", ["last_id"], "n_events")
    return joined.filter(F.col("message_id") > F.coalesce(F.col("last_id"), F.lit(-1))).drop("last_id")


def state_changes(events: DataFrame) -> DataFrame:
    """(job_set, message_id, d_registered, d_pending, d_active): what each state-changing event does."""
    j = job_states(events)
    never = F.lit(2**63 - 1)
    end = F.coalesce(F.col("terminal_id"), never)
    reg = F.when(F.col("register_id") < end, F.col("register_id"))
    sub = F.when(F.col("submit_id") < F.least(end, F.coalesce(reg, never)), F.col("submit_id"))

    def change(at: Column, registered: Column, pending: Column, active: Column) -> Column:
        return F.struct(at.alias("message_id"), registered.cast("long").alias("d_registered"),
                        pending.cast("long").alias("d_pending"), active.cast("long").alias("d_active"))

    zero, one = F.lit(0), F.lit(1)
    was_pending = F.when(sub.isNotNull(), one).otherwise(zero)
    still_pending = F.when(sub.isNotNull() & reg.isNull(), one).otherwise(zero)
    was_registered = F.when(reg.isNotNull(), one).otherwise(zero)
    changes = F.array(
        change(F.col("record_id"), zero, zero, one),
        change(sub, zero, one, zero),
        change(reg, one, -was_pending, zero),
        change(F.col("terminal_id"), -was_registered, -still_pending, -one),
    )
    rows = j.select("job_set", F.explode(changes).alias("c")).select("job_set", "c.*")
    # the recording event is also the first submit or register event
    return rows.filter("message_id is not null").groupBy("job_set", "message_id").agg(
        *[F.sum(c).alias(c) for c in ("d_registered", "d_pending", "d_active")])


def running_counts(events: DataFrame, width: int = WIDTH) -> DataFrame:
    """Registered, pending and active jobs of the set after each state-changing event."""
    totals = running_totals(
        written(state_changes(events), "state-changes"), ["job_set"], "message_id",
        {"registered": F.col("d_registered"), "pending": F.col("d_pending"), "active": F.col("d_active")},
        width)
    return totals.select("job_set", "message_id", "registered", "pending", "active")
