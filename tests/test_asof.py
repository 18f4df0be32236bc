"""As-of joins and demand at a tick, against plain loops."""

import random

import pytest
from conftest import rows

from runlens.operators import demand as dm
from runlens.operators import lifecycle as lc
from runlens.operators.asof import as_of
from runlens.plans import runner


def data(seed):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot", "hot", "a", "b", "c", None])
    left = [(n, key(), rng.choice([None, *range(200)])) for n in range(600)]
    right = [(n, rng.choice(["hot", "hot", "a", "b", "d", None]), rng.choice([None, *range(5, 200)]), rng.choice([None, n])) for n in range(500)]
    return left, right


@pytest.mark.parametrize("partitions", ["1", "8", "64"])
def test_as_of_equals_a_loop(spark, partitions):
    left, right = data(int(partitions))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = as_of(spark.createDataFrame(left, "n long, k string, at long"), spark.createDataFrame(right, "m long, k string, at long, v long"),
                    ["k"], "at", ["m", "v"], tie="m")
        got = {r["n"]: (r["k"], r["at"], r["m"], r["v"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == len(left)
    for n, k, at in left:
        found = [(r[2], r[0], r[3]) for r in right if k is not None and at is not None and r[1] == k and r[2] is not None and r[2] <= at]
        best = max(found, key=lambda f: f[:2], default=(None, None, None))
        assert got[n] == (k, at, best[1], best[2])


def test_as_of_of_empty_tables(spark):
    left, right = spark.createDataFrame([(1, 5)], "k long, at long"), spark.createDataFrame([], "k long, at long, v string")
    assert [tuple(r) for r in as_of(left, right, ["k"], "at", ["v"]).collect()] == [(1, 5, None)]
    assert as_of(left.limit(0), right, ["k"], "at", ["v"]).collect() == []


SCHEMA = "message_id long, ts timestamp_ntz, kind string, job_id string, job_set string, reason string, cause string, exit_codes array<int>"


def history(spark, hot=400):
    """Set `hot` has over a third of all events; one job after the other is recorded, registers and ends."""
    from datetime import datetime, timedelta

    out, start = [], datetime(2024, 1, 1)
    for job in range(hot):
        name = "hot" if job % 2 else f"set-{job % 7}"
        for kind in ("submitted", "registered", "succeeded")[: 1 + job % 3]:
            out.append((len(out), start + timedelta(minutes=len(out)), kind, f"job-{job}", name, None, None, None))
    return spark.createDataFrame(out, SCHEMA), out


def test_gap_at_a_tick_counts_what_was_known_then(spark):
    events, plain = history(spark)
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    ticks = [(f"t{n}", name, start + timedelta(minutes=7 * n, seconds=30)) for n in range(120) for name in ("hot", "set-0", "unheard")]
    targets = [("hot", 0, start + timedelta(minutes=100), 1, 50, 0), ("hot", 0, start + timedelta(minutes=300), 2, 9, 4), ("hot", 1, start, 3, 400, -1),
               ("set-0", 0, start, 4, 3, 0), ("unheard", 0, start, 5, 2, 0)]
    gaps = dm.gap_as_of(spark.createDataFrame(ticks, "tick string, job_set string, ts timestamp_ntz"),
                        spark.createDataFrame(targets, "job_set string, profile int, ts timestamp_ntz, message_id long, target long, cardinality int"),
                        dm.counts_over_time(events), hot_rows=20)
    initial = spark.createDataFrame([("hot", 30), ("set-0", 0)], "job_set string, initial long")
    got = {(r["tick"], r["job_set"], r["profile"]): r for r in dm.allocate_as_of(gaps, initial, hot_rows=20).collect()}
    want = 0
    for tick, name, at in ticks:
        seen = {}
        for _, ts, kind, job, job_set, *_ in plain:
            if job_set == name and ts <= at:
                seen[job] = kind
        registered, pending = (sum(k == w for k in seen.values()) for w in ("registered", "submitted"))
        for profile in (0, 1):
            held = max((t for t in targets if t[0] == name and t[1] == profile and t[2] <= at), key=lambda t: t[2], default=None)
            if held is None:
                assert (tick, name, profile) not in got
                continue
            want += 1
            row, gap = got[tick, name, profile], held[4] - registered - pending
            assert (row["registered"], row["pending"], row["gap"]) == (registered, pending, gap)
            ready = registered >= 0.8 * {"hot": 30, "set-0": 0}.get(name, 0)
            allowed = gap > 0 and pending < 100 and ((registered == 0 and pending == 0) or ready)
            step = min(10, held[5]) if held[5] > 0 else 10
            assert (row["ready"], row["allowed"], row["n"]) == (ready, allowed, min(gap, step) if allowed else 0)
    assert len(got) == want


def test_both_answers_of_the_gate_occur(spark):
    seen = {r["allowed"] for r in runner("allocate_as_of")(spark, "/root/testdata/sf0.01").select("allowed").distinct().collect()}
    assert seen == {True, False}


def test_last_counts_equal_the_snapshot(spark, tables):
    from runlens.plans.fixtures import job_events

    e = job_events(tables)
    end = e.groupBy("job_set").agg({"ts": "max"}).withColumnRenamed("max(ts)", "ts")
    got = as_of(end, dm.counts_over_time(e), ["job_set"], "ts", ["registered", "pending", "active"], tie="message_id").drop("ts")
    assert rows(got) == rows(lc.state_counts(e, ["job_set"]).drop("terminal"))
