from conftest import rows
from pyspark.sql import functions as F

from runlens.functions import events as ev
from runlens.operators import lifecycle as lc
from runlens.operators.scans import dense_rank_ids, running_totals, sorted_positions
from runlens.operators.skew import broadcast_if_small, lookup_join
from runlens.plans.fixtures import job_events

SCHEMA = "message_id long, kind string, job_id string, job_set string, reason string, cause string, exit_codes array<int>, ts timestamp_ntz"


def stream(spark, *items):
    """Events (kind, job[, reason, exit_codes]) in arrival order, one second apart."""
    data = []
    for at, (kind, job, *more) in enumerate(items, 1):
        reason, codes = (more + [None, None])[:2]
        data.append((at, kind, job, "s", reason, "Error" if kind == "failed" else None, codes, f"2024-01-01 00:00:{at:02d}"))
    return spark.createDataFrame(data, SCHEMA.replace("timestamp_ntz", "string")).withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))


PREEMPTIONS = [
    "Preempted by scheduler using urgency preemption - preempting job job-111",
    "Preempted by scheduler using fair share preemption",
    "Preempted by scheduler using market based preemption",
    "Preempted by scheduler due to the fairness optimiser",
    "failing to reschedule\njob preempted",
]


def test_failure_texts_are_routed(spark):
    texts = [t for p in PREEMPTIONS for t in (p, p.lower(), p.upper())]
    crashes = [("OOMKilled", [137]), ("Error: Container exited with a non-zero status of 1", [1])]
    items = []
    for n, text in enumerate(texts):
        items += [("submitted", f"p{n}"), ("failed", f"p{n}", text, [])]
    for n, (text, codes) in enumerate(crashes):
        items += [("submitted", f"c{n}"), ("failed", f"c{n}", text, codes)]
    items.append(("failed", "unknown", "OOMKilled", [137]))
    data = [(i, *x) for i, x in enumerate(items)]
    events = spark.createDataFrame(
        [(i, k, j, "s", (m + [None, None])[0], "Error" if k == "failed" else None, (m + [None, None])[1])
         for i, k, j, *m in data], SCHEMA.rsplit(",", 1)[0]).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    got = {r["job_id"]: (r["loss_kind"], r["app_caused"], r["code"]) for r in lc.first_terminal(events).collect()}
    assert "unknown" not in got
    assert all(got[f"p{n}"] == ("preempted", False, -1) for n in range(len(texts)))
    assert got["c0"] == ("failed", True, 137) and got["c1"] == ("failed", True, 1)


def test_reason_cause_and_missing_code(spark):
    e = stream(spark, ("submitted", "a"), ("failed", "a", "", []), ("submitted", "b"), ("failed", "b", None, [0, 5]))
    got = {r["job_id"]: r for r in lc.first_terminal(e).collect()}
    assert got["a"]["message"] == "Job a failed: Unknown failure, Cause: Error"
    assert (got["a"]["code"], got["a"]["app_caused"]) == (-1, True)
    assert (got["b"]["code"], got["b"]["app_caused"]) == (0, False)


def test_first_terminal_wins_by_arrival(spark):
    e = stream(spark, ("succeeded", "a"), ("submitted", "a"), ("preempted", "a"), ("failed", "a", "OOMKilled", [137]),
               ("cancelled", "a"), ("submitted", "b"), ("failed", "b", "OOMKilled", [137]), ("preempted", "b"))
    got = {r["job_id"]: (r["message_id"], r["loss_kind"]) for r in lc.first_terminal(e).collect()}
    assert got == {"a": (3, "preempted"), "b": (7, "failed")}


def test_pending_until_registered_or_ended(spark):
    def pending(*items):
        return [r["job_id"] for r in lc.pending_set(stream(spark, *items)).collect()]

    assert pending(("submitted", "a"), ("submitted", "b"), ("failed", "a", "x", [1])) == ["b"]
    assert pending(("submitted", "a"), ("running", "a")) == ["a"]
    assert pending(("submitted", "a"), ("running", "a"), ("registered", "a")) == []
    assert pending(("registered", "a"), ("submitted", "a")) == []
    assert pending(("submitted", "a"), ("failed", "a", "x", [1]), ("submitted", "a")) == []


def test_half_of_hundred_fail(spark):
    items = [("submitted", f"j{n}") for n in range(50)] + [("failed", f"j{n}", "x", [1]) for n in range(25)]
    counts = lc.state_counts(stream(spark, *items[:59])).first()
    assert counts["active"] + counts["terminal"] == 50
    assert (counts["active"], counts["pending"], counts["registered"]) == (41, 41, 0)


def test_driver_outcomes(spark):
    e = stream(spark, ("submitted", "d1"), ("succeeded", "d1"), ("failed", "d2", "OOMKilled", [137]), ("failed", "d3", "", []),
               ("cancelled", "d4", "why"), ("preempted", "d5"), ("running", "d6"), ("queued", "d6"), ("failed", "other", "x", [1]))
    drivers = spark.createDataFrame([(f"d{n}",) for n in range(1, 7)], "job_id string")
    got = {r["job_id"]: (r["state"], r["reason"]) for r in lc.driver_outcome(e, drivers).collect()}
    assert got == {"d1": ("Succeeded", ""), "d2": ("Failed", "OOMKilled"), "d3": ("Failed", "Unknown failure"),
                   "d4": ("Cancelled", "Job cancelled"), "d5": ("Preempted", "")}


def test_kill_outcomes(spark):
    e = stream(spark, ("submitted", "a"), ("submitted", "b"), ("cancelled", "a"), ("submitted", "c"), ("succeeded", "c"))
    kills = spark.createDataFrame([(1, "2024-01-01 00:00:01", "a"), (2, "2024-01-01 00:00:04", "a"), (3, "2024-01-01 00:00:02", "b"),
                                   (4, "2024-01-01 00:00:01", "c")], "kill_id long, kill_ts string, job_id string")
    kills = kills.withColumn("kill_ts", F.col("kill_ts").cast("timestamp_ntz"))
    got = {r["kill_id"]: r["outcome"] for r in lc.kill_noop(kills, e, grace_ms=2000).collect()}
    assert got == {1: "noop", 2: "already_terminal", 3: "cancelled", 4: "cancelled"}


def test_events_after_resume_id(spark, tables):
    e = job_events(tables).select("message_id", "job_id")
    assert lc.events_after(e, 900).count() == e.filter("message_id > 900").count()
    assert "GreaterThan(event_id,900)" in lc.events_after(e, 900)._jdf.queryExecution().toString()


def test_all_kinds_have_a_class(spark):
    kinds = ev.STATE_CHANGING + ev.LOG_IF_KNOWN + ev.INFORMATIONAL
    assert len(kinds) == 18 == len(set(kinds))
    df = spark.createDataFrame([(k,) for k in kinds], "kind string").select(ev.event_class(F.col("kind")).alias("c"))
    counts = {r["c"]: r["count"] for r in df.groupBy("c").count().collect()}
    assert counts == {"state_changing": 7, "log_if_known": 2, "informational": 9}


def test_hot_jobs_give_the_same_answer(spark, tables):
    """A third of all events belongs to one job; hot keys take the broadcast branch."""
    e = job_events(tables).withColumn(
        "job_id", F.when(F.col("message_id") % 3 == 0, "hot").otherwise(F.col("job_id"))).select("message_id", "job_id", "kind")
    usual = rows(lc.known_events(e))
    assert rows(lc.known_events(e, hot_rows=50)) == usual
    assert rows(lc.known_events(e, hot_rows=0)) == usual


def test_lookup_join_keeps_null_and_unmatched_keys(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "c")], "id long, key string")
    per_key = spark.createDataFrame([("a", 10, 2), ("b", 20, 1)], "key string, value long, n long")
    want = [(1, "a", 10), (2, "a", 10), (3, "b", 20), (4, None, None), (5, "c", None)]
    for hot in (0, 1, 100):
        got = lookup_join(facts, per_key, "key", ["value"], "n", hot_rows=hot)
        assert sorted((r["id"], r["key"], r["value"]) for r in got.collect()) == want


def test_running_totals_do_not_depend_on_bucket_width(spark):
    df = spark.range(0, 500, 1, 4).selectExpr("id * 7 % 503 as at", "if(id % 3 = 0, 'hot', concat('k', id % 5)) as key", "id % 11 - 5 as v")
    whole = sorted(df.selectExpr("key", "at", "sum(v) over (partition by key order by at) as t").collect())
    for width in (3, 10, 1000):
        got = running_totals(df.select("key", "at", "v"), ["key"], "at", {"t": F.col("v")}, width)
        assert sorted(got.select("key", "at", "t").collect()) == whole


def test_dense_ids_are_dense(spark):
    df = spark.range(0, 400, 1, 7).selectExpr("id * 13 % 4001 as at")
    want = sorted(r["at"] for r in df.collect())
    for width in (5, 64, 10**6):
        got = sorted((r["n"], r["at"]) for r in dense_rank_ids(df, [], "at", "n", width).collect())
        assert got == [(i, at) for i, at in enumerate(want, 1)]


def test_sorted_positions_over_many_partitions(spark):
    df = spark.range(0, 1000, 1, 5).selectExpr("concat('x', id * 37 % 1009) as name")
    got = sorted((r["position"], r["name"]) for r in sorted_positions(df, [F.col("name")]).collect())
    assert [n for _, n in got] == sorted(n for _, n in got)
    assert [p for p, _ in got] == list(range(1, 1001))


def test_lookup_is_sent_only_when_small(spark):
    small, big = spark.range(5), spark.range(50)
    assert "broadcast" in broadcast_if_small(small, 10)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in broadcast_if_small(big, 10)._jdf.queryExecution().logical().toString()


def test_results_do_not_depend_on_partitions(spark, tables):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        seen = []
        for n in ("1", "4", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            e = job_events(tables)
            seen.append([rows(lc.running_counts(e, width=100)), rows(lc.executor_ids(e, width=64)), rows(lc.first_terminal(e))])
        assert seen[0] == seen[1] == seen[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_state_invariants(spark, tables):
    states = lc.job_states(job_events(tables)).collect()
    assert all(not s["pending"] or s["active"] for s in states)
    assert all(not (s["pending"] and s["registered"]) for s in states)
    assert len({s["job_id"] for s in states}) == len(states)
