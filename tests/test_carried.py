"""Counts and ids carried from batch to batch equal the one-pass operators."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from runlens.operators import lifecycle as lc
from runlens.plans.fixtures import job_events
from runlens.session import scratch_path, written
from runlens.streaming import reduced as rd
from runlens.streaming.carried import Carried
from runlens.streaming.run import drain_batches


@pytest.fixture(scope="module")
def events(tables):
    e = job_events(tables)
    # one set has over a third of all events
    return e.withColumn("job_set", F.when(F.col("job_set") < "set-4", "set-hot").otherwise(F.col("job_set")))


@pytest.fixture(scope="module")
def carried(spark, events):
    reducer, out, mark = rd.Reducer(scratch_path(spark, "reduced")), Carried(scratch_path(spark, "carried"), width=40, hot_rows=30), scratch_path(spark, "mark")
    for batch in range(10):
        reducer(events.filter(f"message_id div 100 = {batch}"), batch)
        drain_batches(rd.changes(reducer.stream(spark, 1000)), out, mark)
    return out


def check(spark, carried, events):
    assert rows(carried.counts(spark)) == rows(lc.running_counts(events)) != []
    ids = carried.ids(spark)
    assert rows(ids.select("job_id", "record_id", "executor_id")) == rows(lc.executor_ids(events).select("job_id", "record_id", "executor_id"))
    per_set = lc.executor_ids(events, by=["job_set"]).select("job_id", "job_set", "record_id", "executor_id")
    assert rows(ids.select("job_id", "job_set", "record_id", F.col("set_executor_id").alias("executor_id"))) == rows(per_set)


def test_ten_batches_equal_one_pass(spark, carried, events):
    assert len(carried._batches(spark)) == 10
    check(spark, carried, events)


def test_tails_are_the_snapshot(spark, carried, events):
    tails = carried._tails(spark, 10).filter("job_set is not null").select("job_set", "registered", "pending", "active")
    assert rows(tails) == rows(lc.state_counts(events, ["job_set"]).drop("terminal"))


def test_a_repeated_batch_changes_nothing_and_an_older_one_is_refused(spark, carried, events):
    last = written(spark.read.parquet(f"{carried.path}/changes"), "again")
    carried(last, 9)
    check(spark, carried, events)
    with pytest.raises(ValueError, match="another checkpoint"):
        carried(last, 3)


def test_a_batch_without_changes(spark):
    out = Carried(scratch_path(spark, "quiet"))
    empty = spark.createDataFrame([], "job_id string, job_set string, message_id long, d_recorded long, d_registered long, d_pending long, d_active long")
    out(empty, 0)
    assert out.counts(spark).count() == 0 and out.ids(spark).count() == 0
    out(spark.createDataFrame([("j", "s", 5, 1, 0, 0, 1), ("j", "s", 5, 0, 0, 1, 0)], empty.schema), 1)
    assert [tuple(r) for r in out.counts(spark).collect()] == [("s", 5, 0, 1, 1)]
    assert [tuple(r) for r in out.ids(spark).collect()] == [("j", "s", 5, 1, 1)]
