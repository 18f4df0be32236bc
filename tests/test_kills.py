"""Requests to kill an executor: which one counts, and what it leaves of the job's end."""

import pytest
from pyspark.sql import functions as F

from runlens.operators import lifecycle as lc

SCHEMA = "message_id long, ts string, kind string, job_id string, job_set string, reason string, cause string, exit_codes array<int>"


def events(spark, *items):
    rows = [(i, f"2024-01-01 00:00:{i:02d}", kind, job, "s", "boom" if kind == "failed" else None, None, [1] if kind == "failed" else None) for i, job, kind in items]
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def outcome(spark, kills, *items):
    asked = spark.createDataFrame(kills, "job_id string, kill_id long")
    out = lc.executor_events(events(spark, *items), kills=asked)
    return out, [(r["job_id"], r["message_id"], r["loss_kind"], r["code"], r["app_caused"], r["message"]) for r in lc.first_terminal(out).orderBy("job_id").collect()]


KILLED = ("cancelled", -1, False, "Executor killed by Spark")


@pytest.mark.parametrize(("kills", "want"), [
    ([("j", 2), ("j", 9)], ("j", 9, *KILLED)),      # the request before the recording does not hide the later one
    ([("j", 9), ("j", 12)], ("j", 9, *KILLED)),     # the first one counts
    ([("j", 20)], ("j", 20, *KILLED)),              # a request with the id of the end takes its place
    ([("j", 21)], ("j", 20, "failed", 1, True, "Job j failed: boom")),  # after the end nothing happens
    ([("j", 2)], ("j", 20, "failed", 1, True, "Job j failed: boom")),
    ([("other", 9)], ("j", 20, "failed", 1, True, "Job j failed: boom")),
])
def test_which_request_counts(spark, kills, want):
    out, got = outcome(spark, kills, (1, "j", "running"), (5, "j", "submitted"), (20, "j", "failed"), (30, "j", "cancelled"))
    assert got == [want]
    assert out.groupBy("message_id").count().filter("count > 1").count() == 0
    totals = {r["loss_kind"]: r["n_events"] for r in lc.loss_totals(out).collect()}
    killed = want[2:] == KILLED
    assert totals == ({"cancelled": 1} if killed else {"failed": 1, "cancelled": 1})


def test_time_of_the_request_is_kept(spark):
    asked = spark.createDataFrame([("j", 9, "2024-01-01 00:00:09")], "job_id string, kill_id long, kill_ts string").withColumn("kill_ts", F.col("kill_ts").cast("timestamp_ntz"))
    out = lc.executor_events(events(spark, (5, "j", "submitted"), (20, "j", "succeeded")), kills=asked)
    assert [str(r["ts"]) for r in lc.first_terminal(out).collect()] == ["2024-01-01 00:00:09"]


def test_a_killed_job_is_no_longer_active(spark):
    out, _ = outcome(spark, [("a", 3)], (1, "a", "submitted"), (2, "a", "registered"), (4, "b", "submitted"), (9, "a", "registered"))
    assert [r["job_id"] for r in lc.active_set(out).collect()] == ["b"]
    assert lc.state_counts(out).first().asDict() == {"registered": 0, "pending": 1, "active": 1, "terminal": 1}
