import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from runlens.operators import lifecycle as lc
from runlens.plans.fixtures import job_events
from runlens.session import scratch_path
from runlens.sources.event_stream import QUARANTINE, event_source, good_events, table_stream
from runlens.streaming import lifecycle as sl
from runlens.streaming.run import drain, drain_batches, drain_to_table


@pytest.fixture(scope="module")
def events(tables):
    return job_events(tables)


@pytest.fixture(scope="module")
def folder(spark, events):
    """The events in five files, written one after another, so that files arrive in order."""
    path = scratch_path(spark, "events-in-order")
    for part in range(5):
        events.filter(F.expr(f"message_id div 200 = {part}")).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, folder, events):
    return table_stream(spark, folder, events.schema, files_per_trigger=1)


def test_first_terminal_over_batches_equals_batch(spark, folder, events):
    state = sl.FirstTerminals(scratch_path(spark, "first"))
    drain_batches(stream(spark, folder, events), state, scratch_path(spark, "checkpoint"))
    assert spark.read.parquet(state.recorded).select("batch").distinct().count() == 5
    assert rows(state.result(spark)) == rows(lc.first_terminal(events))


def test_a_repeated_batch_changes_nothing(spark, events):
    state = sl.FirstTerminals(scratch_path(spark, "repeat"))
    first, second = events.filter("message_id < 500"), events.filter("message_id >= 500")
    state(first, 0)
    state(second, 1)
    once = rows(state.result(spark))
    state(second, 1)
    assert rows(state.result(spark)) == once == rows(lc.first_terminal(events))


def test_arrival_decides_over_ids(spark, events):
    """A batch that arrives earlier wins even if its ids are higher."""
    state = sl.FirstTerminals(scratch_path(spark, "late"))
    schema = "message_id long, kind string, job_id string, job_set string, reason string, cause string, exit_codes array<int>, ts string"

    def batch(*items):
        return spark.createDataFrame([(i, k, "j", "s", None, None, None, "2024-01-01") for i, k in items], schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))

    state(batch((10, "submitted"), (11, "cancelled")), 0)
    state(batch((1, "submitted"), (2, "succeeded")), 1)
    assert [(r["message_id"], r["loss_kind"]) for r in state.result(spark).collect()] == [(11, "cancelled")]


def test_lifecycle_over_batches(spark, folder, events):
    got = drain_to_table(sl.stream_lifecycle(stream(spark, folder, events)))
    s = lc.job_states(events)
    late = "coalesce(terminal_id, 9223372036854775807)"
    want = (s.selectExpr("job_id", "record_id as message_id", "'recorded' as transition")
            .union(s.filter(f"submit_id < least({late}, coalesce(register_id, 9223372036854775807))").selectExpr("job_id", "submit_id", "'pending'"))
            .union(s.filter(f"register_id < {late}").selectExpr("job_id", "register_id", "'registered'"))
            .union(s.filter("terminal_id is not null").selectExpr("job_id", "terminal_id", "'terminal'")))
    assert rows(got) == rows(want)


def test_decommission_over_batches(spark, folder, events):
    grace = 86_400_000
    got = drain_to_table(sl.stream_decommission(stream(spark, folder, events), grace))
    assert rows(got) == rows(lc.decommission_pairs(events, grace)) != []


def test_timeout_over_batches(spark, folder, events):
    limit = 3 * 86_400_000
    got = drain_to_table(sl.stream_watch_timeout(stream(spark, folder, events), limit))
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    last = events.agg(F.max(ms)).first()[0]
    per = events.groupBy("job_id").agg(F.min(ms).alias("started_ms"), F.min(F.when(F.col("kind").isin("succeeded", "failed", "cancelled", "preempted"), ms)).alias("end"))
    want = per.withColumn("deadline_ms", F.col("started_ms") + limit).filter(
        (F.col("end").isNull() | (F.col("end") > F.col("deadline_ms"))) & (F.col("deadline_ms") <= last)).drop("end")
    assert rows(got) == rows(want) != []
    assert drain_to_table(sl.stream_watch_timeout(stream(spark, folder, events), 0)).count() == 0


def test_counts_wait_for_late_events(spark):
    path, out, mark = (scratch_path(spark, n) for n in ("late-in", "late-out", "late-mark"))
    schema = "ts string, kind string, job_id string, reason string, cause string, exit_codes array<int>"

    def arrive(*times):
        spark.createDataFrame([(t, "running", "j", None, None, None) for t in times], schema).withColumn(
            "ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(path)

    def run():
        source = table_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)
        drain(sl.stream_state_counts(source, "1 hour", "30 minutes"), out, mark)

    arrive("2024-01-01 00:10:00", "2024-01-01 01:10:00")
    arrive("2024-01-01 00:50:00")  # out of order, inside the delay
    run()
    arrive("2024-01-01 03:00:00")
    run()
    arrive("2024-01-01 00:20:00")  # its window is closed
    run()
    got = {r["window_ms"] // 3_600_000 % 24: r["n_events"] for r in spark.read.parquet(out).collect()}
    assert got == {0: 2, 1: 1}


def test_restart_goes_on_after_the_last_file(spark, events):
    path, out, mark = (scratch_path(spark, n) for n in ("in", "out", "mark"))
    e = events.select("message_id", "kind")
    for part in ("message_id < 300", "message_id >= 300 and message_id < 600", "message_id >= 600"):
        e.filter(part).write.mode("append").parquet(path)
        drain(table_stream(spark, path, e.schema), out, mark)
    drain(table_stream(spark, path, e.schema), out, mark)
    assert rows(spark.read.parquet(out)) == rows(e)


def test_malformed_lines_are_set_aside(spark, tmp_path):
    good = {"message_id": 1, "ts": "2024-01-01T00:00:00", "job_set": "s", "job_id": "j", "kind": "failed", "reason": "r", "cause": "Error", "exit_codes": [1]}
    (tmp_path / "a.json").write_text("\n".join([json.dumps(good), "{broken", json.dumps({**good, "message_id": "text"}), json.dumps({**good, "message_id": 2})]))
    out = drain_to_table(event_source(spark, str(tmp_path)))
    assert out.filter(F.col(QUARANTINE).isNotNull()).count() == 2
    assert sorted(r["message_id"] for r in good_events(out).collect()) == [1, 2]
