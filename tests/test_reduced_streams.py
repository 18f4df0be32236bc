"""Streams over reduced batches against the batch operators: five batches, a hot job, history as the start, state read back."""

import duckdb
import pytest
from conftest import rows
from oracle_check import compare
from pyspark.sql import functions as F

from runlens.operators import lifecycle as lc
from runlens.plans import ORACLES, runner, stream_queries
from runlens.plans.fixtures import job_events
from runlens.session import scratch_path
from runlens.sources.event_stream import table_stream
from runlens.streaming import reduced as rd
from runlens.streaming.run import drain, drain_batches


@pytest.fixture(scope="module", params=["given", "hot"])
def events(request, tables):
    e = job_events(tables)
    if request.param == "given":
        return e
    # one job has a third of all events
    return e.withColumn("job_id", F.when(F.col("message_id") % 3 == 0, "job-hot").otherwise(F.col("job_id"))).withColumn(
        "job_set", F.when(F.col("message_id") % 3 == 0, "set-hot").otherwise(F.col("job_set")))


@pytest.fixture(scope="module")
def folder(spark, events):
    path = scratch_path(spark, "events-in-order")
    for part in range(5):
        events.filter(F.expr(f"message_id div 200 = {part}")).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def reducer(spark, events, folder):
    out = rd.Reducer(scratch_path(spark, "reduced"), hot_rows=50)
    drain_batches(table_stream(spark, folder, events.schema, files_per_trigger=1), out, scratch_path(spark, "mark"))
    return out


def run(stream, mark=None, path=None):
    spark = stream.sparkSession
    path, mark = path or scratch_path(spark, "out"), mark or scratch_path(spark, "mark")
    drain(stream, path, mark)
    return spark.read.schema(stream.schema).parquet(path)


def wanted_transitions(events):
    s = lc.job_states(events)
    late = "coalesce(terminal_id, 9223372036854775807)"
    return (s.selectExpr("job_id", "record_id as message_id", "'recorded' as transition")
            .union(s.filter(f"submit_id < least({late}, coalesce(register_id, 9223372036854775807))").selectExpr("job_id", "submit_id", "'pending'"))
            .union(s.filter(f"register_id < {late}").selectExpr("job_id", "register_id", "'registered'"))
            .union(s.filter("terminal_id is not null").selectExpr("job_id", "terminal_id", "'terminal'")))


def test_a_job_has_one_row_per_batch(spark, reducer, events):
    found = spark.read.parquet(reducer.path)
    assert found.groupBy("batch", "job_id").count().filter("count > 1").count() == 0
    assert found.select("batch").distinct().count() == 5


@pytest.mark.parametrize("files", [1, 1000])
def test_transitions_equal_the_batch(spark, reducer, events, files):
    assert rows(run(rd.transitions(reducer.stream(spark, files)))) == rows(wanted_transitions(events))


@pytest.mark.parametrize("files", [1, 1000])
def test_ends_equal_first_terminal(spark, reducer, events, files):
    got = run(rd.ends(reducer.stream(spark, files)))
    assert rows(got.drop("record_id")) == rows(lc.first_terminal(events)) != []


def test_a_repeated_batch_changes_nothing(spark, events):
    out = rd.Reducer(scratch_path(spark, "repeat"))
    out(events.filter("message_id < 500"), 0)
    out(events.filter("message_id >= 500"), 1)
    mark, path = scratch_path(spark, "mark"), scratch_path(spark, "out")
    once = rows(run(rd.transitions(out.stream(spark, 1000)), mark, path))
    out(events.filter("message_id >= 500"), 1)
    assert rows(run(rd.transitions(out.stream(spark, 1000)), mark, path)) == once == rows(wanted_transitions(events))


def test_arrival_decides_over_ids(spark):
    schema = "message_id long, kind string, job_id string, job_set string, reason string, cause string, exit_codes array<int>, ts string"

    def batch(*items):
        return spark.createDataFrame([(i, k, "j", "s", None, None, None, "2024-01-01") for i, k in items], schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))

    out = rd.Reducer(scratch_path(spark, "late"))
    out(batch((9, "failed"), (10, "submitted"), (11, "cancelled")), 0)
    out(batch((1, "submitted"), (2, "succeeded")), 1)
    assert [(r["record_id"], r["message_id"], r["loss_kind"]) for r in run(rd.ends(out.stream(spark, 10))).collect()] == [(10, 11, "cancelled")]


def test_a_stream_starts_from_history(spark, events):
    """The first 600 events are a table, the others arrive: together they give what one stream over all gives."""
    out = rd.Reducer(scratch_path(spark, "onward"))
    past = events.filter("message_id < 600")
    for batch, part in enumerate(("message_id >= 600 and message_id < 800", "message_id >= 800")):
        out(events.filter(part), batch)
    mark = scratch_path(spark, "mark")
    later = run(rd.transitions(out.stream(spark, 1000), rd.initial_states(past)), mark)
    assert rows(later.union(wanted_transitions(past))) == rows(wanted_transitions(events))
    ended = run(rd.ends(out.stream(spark, 1000), rd.initial_states(past))).drop("record_id")
    assert rows(ended.unionByName(lc.first_terminal(past))) == rows(lc.first_terminal(events))
    # and its state is that of the whole
    states = rd.stored_states(spark, mark)
    assert rows(rd.active_jobs(states)) == rows(lc.active_set(events))
    assert rows(rd.pending_jobs(states)) == rows(lc.pending_set(events))


def test_state_of_a_stopped_stream(spark, reducer, events):
    mark = scratch_path(spark, "mark")
    run(rd.transitions(reducer.stream(spark, 2)), mark)
    states = rd.stored_states(spark, mark)
    assert rows(rd.active_jobs(states)) == rows(lc.active_set(events)) != []
    assert rows(rd.pending_jobs(states)) == rows(lc.pending_set(events)) != []


def test_overdue_jobs_equal_the_batch(spark, reducer, events):
    limit = 3 * 86_400_000
    got = run(rd.overdue(reducer.stream(spark, 1), limit))
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    last = events.agg(F.max(ms)).first()[0]
    per = events.groupBy("job_id").agg(F.min(ms).alias("started_ms"), F.min(F.when(F.col("kind").isin("succeeded", "failed", "cancelled", "preempted"), ms)).alias("end"))
    want = per.withColumn("deadline_ms", F.col("started_ms") + limit).filter(
        (F.col("end").isNull() | (F.col("end") > F.col("deadline_ms"))) & (F.col("deadline_ms") <= last)).drop("end")
    assert rows(got) == rows(want) != []
    assert run(rd.overdue(reducer.stream(spark, 1), 0)).count() == 0


def test_decommissions_equal_the_batch_and_let_go_of_state(spark, reducer, events, folder):
    horizon, grace = 2 * 86_400_000, 86_400_000
    ended, mark = scratch_path(spark, "ends"), scratch_path(spark, "mark")
    drain(rd.ends(reducer.stream(spark, 1)), ended, mark)
    ends = spark.read.parquet(ended)
    # ends arrive in their order as well
    placed = scratch_path(spark, "ends-in-order")
    for part in range(5):
        ends.filter(F.expr(f"message_id div 200 = {part}")).coalesce(1).write.mode("append").parquet(placed)
    pairs = rd.decommissions(table_stream(spark, folder, events.schema, 1), table_stream(spark, placed, ends.schema, 1), horizon, grace)
    out = scratch_path(spark, "pairs")
    query = (pairs.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "mark")).option("path", out)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    want = lc.decommission_pairs(events, grace).filter(f"gap_us <= {horizon * 1000}")
    assert rows(spark.read.schema(pairs.schema).parquet(out)) == rows(want) != []
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    n_all = events.filter("kind = 'preempting'").count() + ends.count()
    assert max(held) < n_all and held[-1] < max(held)
    assert sum(p["stateOperators"][0]["numRowsRemoved"] for p in query.recentProgress if p["stateOperators"]) > 0


def test_decommission_join_of_files_in_no_order_of_time(spark, tables, monkeypatch):
    """Ends and notices in more files than a trigger takes, and an end whose clock is behind its notice."""
    folder = scratch_path(spark, "disordered")
    e = tables["events"]
    split = e.withColumn("_n", F.expr("crc32(cast(user_id as string)) % 3"))
    # the ids of a job stay in order within a file; clocks run backwards for every second user
    late = F.when(F.col("user_id") % 2 == 0, F.expr("ts - make_dt_interval(0, event_id % 4)")).otherwise(F.col("ts"))
    for part in (2, 0, 1):
        split.filter(F.col("_n") == part).withColumn("ts", late).drop("_n").coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(stream_queries, "FILES_PER_TRIGGER", 1)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet/*.parquet')")
    name = "stream_decommission_join"
    assert compare(spark, con, name, runner(name), ORACLES[name], folder) == []


def test_a_reduced_batch_fits_one_trigger(spark, tables):
    path = scratch_path(spark, "few-files")
    rd.Reducer(path, files=2)(job_events(tables).repartition(8), 0)
    read = spark.read.parquet(f"{path}/jobs")
    assert len(read.inputFiles()) <= 2 and read.count() == job_events(tables).select("job_id").distinct().count()
