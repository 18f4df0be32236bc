"""The event log as a stream: any start id, restarts without a checkpoint, appended segments."""

import pytest
from conftest import rows

from runlens.operators import lifecycle as lc
from runlens.plans.fixtures import job_events
from runlens.session import scratch_path
from runlens.sources import event_log as el
from runlens.streaming.run import drain, drain_to_table


@pytest.fixture(scope="module")
def events(tables):
    return job_events(tables).drop("k", "user_id")


@pytest.fixture(scope="module")
def log(spark, events):
    path = scratch_path(spark, "log")
    el.write_log(events, path, width=150)
    return path


@pytest.mark.parametrize("after", [-1, 0, 149, 150, 777, 10**9])
def test_starts_after_any_id(spark, events, log, after):
    got = drain_to_table(el.read_log(spark, log, after)).select(*events.columns)
    assert rows(got) == rows(events.filter(f"message_id > {after}"))


def test_a_batch_is_cut_into_ranges_of_segments(spark, events, log):
    reader = el.LogReader(log, -1)
    last = events.agg({"message_id": "max"}).first()[0]
    assert reader.latestOffset() == {"id": last}
    parts = reader.partitions({"id": 100}, {"id": last})
    assert len(parts) == last // 150 + 1
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == events.filter("message_id > 100").count()
    assert reader.partitions({"id": last}, {"id": last}) == []
    assert el.LogReader("/tmp/no-such-log", 7).latestOffset() == {"id": 7}


def test_appended_events_are_read_once(spark, events):
    path, out, mark = (scratch_path(spark, n) for n in ("grows", "out", "mark"))
    for part in ("message_id < 310", "message_id >= 310 and message_id < 700", "message_id >= 700"):
        el.write_log(events.filter(part), path, width=150)
        drain(el.read_log(spark, path), out, mark)
    drain(el.read_log(spark, path), out, mark)
    assert rows(spark.read.parquet(out).select(*events.columns)) == rows(events)


def test_a_restart_without_checkpoint_repeats_and_loses_nothing(spark, events):
    """The first run stops; all that is left of it are its results, and they say where each job set goes on."""
    path, out = scratch_path(spark, "log"), scratch_path(spark, "out")
    el.write_log(events.filter("message_id < 500"), path, width=150)
    drain(el.read_log(spark, path), out, scratch_path(spark, "mark"))
    # of one set the last results are lost
    kept = spark.read.parquet(out).filter("job_set <> 'set-3' or message_id < 200")
    el.write_log(events.filter("message_id >= 500"), path, width=150)
    points = lc.resume_points(kept)
    later = drain_to_table(el.read_log_from(spark, path, points))
    assert rows(kept.unionByName(later).select(*events.columns)) == rows(events)
