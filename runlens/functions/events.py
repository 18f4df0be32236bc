"""Column expressions over job events."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Event kinds by what they do to the tracked state.
STATE_CHANGING = ["submitted", "running", "succeeded", "failed", "cancelled", "preempting", "preempted"]
LOG_IF_KNOWN = ["queued", "pending"]
INFORMATIONAL = ["leased", "lease_returned", "lease_expired", "reprioritized", "reprioritizing",
                 "cancelling", "utilisation", "ingress_info", "empty"]
# The executor's own id request; not an event of the scheduler, but it records the job too.
REGISTRATION = "registered"
RECORDING = ["submitted", REGISTRATION]
TERMINAL = ["succeeded", "failed", "cancelled", "preempted"]

# Default texts and the preemption marker.
UNKNOWN_FAILURE = "Unknown failure"
JOB_CANCELLED = "Job cancelled"
PREEMPTION_MARKER = "preempt"
KILLED = "Executor killed by Spark"
NO_EXIT_CODE = -1


def _non_empty(text: Column) -> Column:
    return F.when(text != "", text)


def event_class(kind: Column) -> Column:
    return (
        F.when(kind.isin(STATE_CHANGING), "state_changing")
        .when(kind.isin(LOG_IF_KNOWN), "log_if_known")
        .when(kind.isin(INFORMATIONAL), "informational")
        .when(kind == REGISTRATION, "registration")
    )


def is_recording(kind: Column) -> Column:
    return kind.isin(RECORDING)


def is_terminal(kind: Column) -> Column:
    return kind.isin(TERMINAL)


def failure_reason(reason: Column, cause: Column) -> Column:
    """Reason (or the default text) and cause, joined by a comma."""
    return F.concat_ws(", ", F.coalesce(_non_empty(reason), F.lit(UNKNOWN_FAILURE)),
                       F.concat(F.lit("Cause: "), cause))


def exit_code(exit_codes: Column) -> Column:
    """Code of the first container, -1 when there is none."""
    return F.coalesce(F.get(exit_codes, F.lit(0)), F.lit(NO_EXIT_CODE))


def is_preemption(full_reason: Column) -> Column:
    return F.contains(F.lower(full_reason), F.lit(PREEMPTION_MARKER))


def effective_kind(kind: Column, full_reason: Column) -> Column:
    """The kind, with a failure that tells of a preemption counted as `preempted`."""
    return F.when((kind == "failed") & is_preemption(full_reason), "preempted").otherwise(kind)


def loss_code(loss_kind: Column, exit_codes: Column) -> Column:
    """Exit code reported for a terminal event of the given effective kind."""
    return F.when(loss_kind == "failed", exit_code(exit_codes)).when(loss_kind == "succeeded", 0).otherwise(NO_EXIT_CODE)


def app_caused(loss_kind: Column, code: Column) -> Column:
    """Only a failure with a code other than 0 is the application's own; a missing code is -1."""
    return (loss_kind == "failed") & (code != 0)


def loss_message(kind: Column, loss_kind: Column, full_reason: Column, job_id: Column, label: str = "Job",
                 preempted_text: str = "Preempted by scheduler") -> Column:
    head = F.concat(F.lit(label + " "), job_id)
    preempted_by = F.when(kind == "failed", full_reason).otherwise(preempted_text)
    return (
        F.when(loss_kind == "failed", F.concat(head, F.lit(" failed: "), full_reason))
        .when(loss_kind == "preempted", F.concat(head, F.lit(" was preempted: "), preempted_by))
        .when((loss_kind == "cancelled") & (full_reason == KILLED), KILLED)
        .when(loss_kind == "cancelled", F.concat(head, F.lit(" was cancelled")))
        .when(loss_kind == "succeeded", F.concat(head, F.lit(" succeeded")))
    )


def driver_state(kind: Column, reason: Column) -> Column:
    """Struct (state, reason) for the terminal event of a driver job, null for other events."""
    def build(state: str, text: Column) -> Column:
        return F.struct(F.lit(state).alias("state"), text.alias("reason"))

    return (
        F.when(kind == "succeeded", build("Succeeded", F.lit("")))
        .when(kind == "failed", build("Failed", F.coalesce(_non_empty(reason), F.lit(UNKNOWN_FAILURE))))
        .when(kind == "cancelled", build("Cancelled", F.lit(JOB_CANCELLED)))
        .when(kind == "preempted", build("Preempted", F.lit("")))
    )
