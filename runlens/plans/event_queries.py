"""Registered queries over job events."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.functions import events as ev
from runlens.operators import demand as dm
from runlens.operators import lifecycle as lc
from runlens.plans.fixtures import JOB_EVENTS_CTE, KNOWN_CTE, driver_jobs, job_events, kill_requests
from runlens.plans.registry import query

_STATES = KNOWN_CTE + """,
states AS (
  SELECT job_id, min(job_set) AS job_set,
    min(message_id) FILTER (kind IN ('submitted', 'registered')) AS record_id,
    min(message_id) FILTER (kind = 'submitted') AS submit_id,
    min(message_id) FILTER (kind = 'registered') AS register_id,
    min(message_id) FILTER (terminal) AS terminal_id
  FROM known GROUP BY job_id),
sets AS (
  SELECT *, terminal_id IS NULL AS active,
    terminal_id IS NULL AND submit_id IS NOT NULL AND register_id IS NULL AS pending,
    terminal_id IS NULL AND register_id IS NOT NULL AS registered
  FROM states)"""

_DRIVERS = """,
drivers AS (SELECT DISTINCT job_id FROM job_events WHERE user_id % 10 = 0 AND job_id LIKE '%-0')"""


@query("event_class", f"""WITH {JOB_EVENTS_CTE}
SELECT message_id, kind, CASE
  WHEN kind IN ('submitted','running','succeeded','failed','cancelled','preempting','preempted') THEN 'state_changing'
  WHEN kind IN ('queued','pending') THEN 'log_if_known'
  WHEN kind = 'registered' THEN 'registration' ELSE 'informational' END AS event_class
FROM job_events""")
def event_class(t):
    return job_events(t).select("message_id", "kind", ev.event_class(F.col("kind")).alias("event_class"))


@query("failure_reason", f"""WITH {KNOWN_CTE}
SELECT message_id, full_reason FROM flagged WHERE kind = 'failed'""")
def failure_reason(t):
    e = job_events(t).filter(F.col("kind") == "failed")
    return e.select("message_id", ev.failure_reason(F.col("reason"), F.col("cause")).alias("full_reason"))


@query("exit_code", f"""WITH {JOB_EVENTS_CTE}
SELECT message_id, code AS exit_code FROM job_events WHERE kind = 'failed'""")
def exit_code(t):
    e = job_events(t).filter(F.col("kind") == "failed")
    return e.select("message_id", ev.exit_code(F.col("exit_codes")).alias("exit_code"))


@query("preempt_classify", f"""WITH {KNOWN_CTE}
SELECT message_id, full_reason ILIKE '%preempt%' AS is_preemption,
  CASE WHEN full_reason ILIKE '%preempt%' THEN 'preempted' ELSE 'failed' END AS effective_kind
FROM flagged WHERE kind = 'failed'""")
def preempt_classify(t):
    e = job_events(t).filter(F.col("kind") == "failed")
    full = ev.failure_reason(F.col("reason"), F.col("cause"))
    return e.select("message_id", ev.is_preemption(full).alias("is_preemption"),
                    ev.effective_kind(F.col("kind"), full).alias("effective_kind"))


@query("loss_attribution", f"""WITH {KNOWN_CTE}
SELECT message_id, job_id, loss_kind, CAST(code AS INTEGER) AS code, app_caused, message FROM losses""")
def loss_attribution(t):
    return lc.loss_attribution(lc.known_events(job_events(t))).select(
        "message_id", "job_id", "loss_kind", "code", "app_caused", "message")


@query("known_job_filter", f"""WITH {KNOWN_CTE}
SELECT kind, known, CAST(count(*) AS BIGINT) AS n_events, CAST(sum(message_id) AS BIGINT) AS id_sum
FROM flagged GROUP BY kind, known""")
def known_job_filter(t):
    return lc.flag_known(job_events(t).select("message_id", "job_id", "kind")).groupBy("kind", "known").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("message_id").alias("id_sum"))


@query("unknown_job_events", f"""WITH {KNOWN_CTE}
SELECT message_id, job_id, kind FROM flagged
WHERE NOT known AND kind IN ('running','preempting','succeeded','failed','cancelled','preempted')""")
def unknown_job_events(t):
    return lc.unknown_events(job_events(t).select("message_id", "job_id", "kind"))


@query("driver_exclude", f"""WITH {JOB_EVENTS_CTE} {_DRIVERS}
SELECT message_id, job_id, kind FROM job_events WHERE job_id NOT IN (SELECT job_id FROM drivers)""")
def driver_exclude(t):
    return lc.exclude_drivers(job_events(t), driver_jobs(t)).select("message_id", "job_id", "kind")


@query("first_terminal", f"""WITH {KNOWN_CTE}
SELECT job_id, message_id, job_set, loss_kind, CAST(code AS INTEGER) AS code, app_caused, message
FROM first_terminal""")
def first_terminal(t):
    return lc.first_terminal(job_events(t)).drop("ts")


@query("loss_summary", f"""WITH {KNOWN_CTE}
SELECT loss_kind, app_caused, count(*) AS n_jobs FROM first_terminal GROUP BY loss_kind, app_caused""")
def loss_summary(t):
    return lc.loss_summary(job_events(t))


@query("loss_totals", f"""WITH {KNOWN_CTE}
SELECT loss_kind, count(*) AS n_events, count(*) FILTER (app_caused) AS n_app_caused,
  count(*) FILTER (NOT app_caused) AS n_external, count(DISTINCT job_id) AS n_jobs
FROM losses GROUP BY loss_kind""")
def loss_totals(t):
    return lc.loss_totals(job_events(t))


@query("active_set", f"WITH {_STATES} SELECT job_id, record_id FROM sets WHERE active")
def active_set(t):
    return lc.active_set(job_events(t))


@query("pending_set", f"WITH {_STATES} SELECT job_id, submit_id FROM sets WHERE pending")
def pending_set(t):
    return lc.pending_set(job_events(t))


@query("state_counts", f"""WITH {_STATES}
SELECT count(*) FILTER (registered) AS registered, count(*) FILTER (pending) AS pending,
  count(*) FILTER (active) AS active, count(*) FILTER (NOT active) AS terminal FROM sets""")
def state_counts(t):
    return lc.state_counts(job_events(t))


@query("state_counts_per_set", f"""WITH {_STATES}
SELECT job_set, count(*) FILTER (registered) AS registered, count(*) FILTER (pending) AS pending,
  count(*) FILTER (active) AS active, count(*) FILTER (NOT active) AS terminal FROM sets GROUP BY job_set""")
def state_counts_per_set(t):
    return lc.state_counts(job_events(t), ["job_set"])


@query("readiness_ratio", f"""WITH {_STATES},
wanted AS (SELECT job_set, count(DISTINCT job_id) % 4 AS initial FROM job_events GROUP BY job_set),
now AS (SELECT job_set, count(*) FILTER (registered AND register_id < coalesce(terminal_id, 9e18)) AS n FROM sets GROUP BY job_set)
SELECT w.job_set, initial, coalesce(n, 0) AS registered, coalesce(n, 0) >= initial * CAST(0.8 AS DOUBLE) AS ready
FROM wanted w LEFT JOIN now ON now.job_set = w.job_set""")
def readiness_ratio(t):
    events = job_events(t)
    wanted = events.groupBy("job_set").agg((F.countDistinct("job_id") % 4).alias("initial"))
    return lc.readiness(events, wanted)


@query("state_counts_of_executors", f"""WITH {JOB_EVENTS_CTE} {_DRIVERS},
requests AS (SELECT job_id, message_id AS kill_id FROM job_events WHERE kind = 'utilisation' AND k >= 70),
recorded AS (SELECT job_id, min(message_id) AS record_id FROM job_events WHERE kind IN ('submitted', 'registered')
  AND job_id NOT IN (SELECT job_id FROM drivers) GROUP BY job_id),
kills AS (SELECT job_id, min(kill_id) AS kill_id FROM requests JOIN recorded USING (job_id) WHERE kill_id >= record_id GROUP BY job_id),
ends AS (SELECT r.job_id, r.record_id, min(e.message_id) FILTER (kind = 'submitted') AS submit_id,
    min(e.message_id) FILTER (kind = 'registered') AS register_id,
    least(coalesce(min(e.message_id) FILTER (kind IN ('succeeded','failed','cancelled','preempted')), 9e18),
      coalesce(min(kill_id), 9e18)) AS terminal_id
  FROM recorded r JOIN job_events e ON e.job_id = r.job_id AND e.message_id >= r.record_id LEFT JOIN kills k ON k.job_id = r.job_id GROUP BY r.job_id, r.record_id)
SELECT count(*) FILTER (terminal_id > 8e18 AND register_id IS NOT NULL) AS registered,
  count(*) FILTER (terminal_id > 8e18 AND register_id IS NULL AND submit_id IS NOT NULL) AS pending,
  count(*) FILTER (terminal_id > 8e18) AS active, count(*) FILTER (terminal_id < 8e18) AS terminal FROM ends""")
def state_counts_of_executors(t):
    kills = kill_requests(t).select("job_id", "kill_id")
    return lc.state_counts(lc.executor_events(job_events(t), driver_jobs(t), kills))


_OF_EXECUTORS = KNOWN_CTE + _DRIVERS + """,
recorded AS (SELECT job_id, min(job_set) AS job_set, min(message_id) AS record_id FROM known WHERE job_id NOT IN (SELECT job_id FROM drivers) GROUP BY job_id),
kills AS (SELECT r.job_id, min(e.message_id) AS kill_id FROM recorded r JOIN job_events e ON e.job_id = r.job_id AND e.message_id >= r.record_id
  WHERE e.kind = 'utilisation' AND e.k >= 70 GROUP BY r.job_id),
outcomes AS (SELECT r.job_id, r.job_set, least(f.message_id, kill_id) AS message_id, coalesce(kill_id <= f.message_id, kill_id IS NOT NULL) AS killed,
    f.loss_kind, f.code, f.app_caused, f.message
  FROM recorded r LEFT JOIN kills USING (job_id) LEFT JOIN first_terminal f ON f.job_id = r.job_id WHERE kill_id IS NOT NULL OR f.message_id IS NOT NULL),
ended AS (SELECT job_id, job_set, message_id, CASE WHEN killed THEN 'cancelled' ELSE loss_kind END AS loss_kind, CASE WHEN killed THEN -1 ELSE code END AS code,
    NOT killed AND app_caused AS app_caused, CASE WHEN killed THEN 'Executor killed by Spark' ELSE message END AS message FROM outcomes)"""


def _executor_events(t):
    return lc.executor_events(job_events(t), driver_jobs(t), kill_requests(t))


@query("first_terminal_of_executors", f"""WITH {_OF_EXECUTORS}
SELECT job_id, message_id, job_set, loss_kind, CAST(code AS INTEGER) AS code, app_caused, message FROM ended""")
def first_terminal_of_executors(t):
    return lc.first_terminal(_executor_events(t)).drop("ts")


@query("loss_summary_of_executors", f"WITH {_OF_EXECUTORS} SELECT loss_kind, app_caused, count(*) AS n_jobs FROM ended GROUP BY ALL")
def loss_summary_of_executors(t):
    return lc.loss_summary(_executor_events(t))


KILL_GRACE_MS = 2 * 86_400_000


@query("kill_noop", f"""WITH {KNOWN_CTE},
kills AS (SELECT message_id AS kill_id, ts AS kill_ts, job_id FROM job_events WHERE kind = 'utilisation' AND k >= 70)
SELECT kill_id, kills.job_id, CASE
  WHEN f.ts IS NULL OR epoch_us(f.ts) - epoch_us(kill_ts) > {KILL_GRACE_MS * 1000} THEN 'cancelled'
  WHEN f.ts >= kill_ts THEN 'noop' ELSE 'already_terminal' END AS outcome
FROM kills LEFT JOIN first_terminal f ON f.job_id = kills.job_id""")
def kill_noop(t):
    return lc.kill_noop(kill_requests(t), job_events(t), grace_ms=KILL_GRACE_MS).drop("kill_ts")


_IDS = KNOWN_CTE + """,
ids AS (SELECT job_id, job_set, record_id, row_number() OVER (ORDER BY record_id) AS executor_id,
    row_number() OVER (PARTITION BY job_set ORDER BY record_id) AS set_executor_id
  FROM (SELECT job_id, job_set, min(message_id) AS record_id FROM job_events
        WHERE kind IN ('submitted', 'registered') GROUP BY job_id, job_set))"""


@query("dense_ids", f"WITH {_IDS} SELECT job_id, record_id, executor_id FROM ids")
def dense_ids(t):
    return lc.executor_ids(job_events(t))


@query("dense_ids_per_set", f"WITH {_IDS} SELECT job_id, job_set, record_id, set_executor_id AS executor_id FROM ids")
def dense_ids_per_set(t):
    return lc.executor_ids(job_events(t), by=["job_set"])


@query("job_to_executor_join", f"""WITH {_IDS}
SELECT e.message_id, e.user_id * 7 + e.k AS executor_id, ids.job_id
FROM job_events e JOIN ids ON ids.executor_id = e.user_id * 7 + e.k WHERE e.kind = 'utilisation'""")
def job_to_executor_join(t):
    e = job_events(t)
    requests = e.filter(F.col("kind") == "utilisation").select(
        "message_id", (F.col("user_id") * 7 + F.col("k")).alias("executor_id"))
    return lc.jobs_of_executors(requests, lc.executor_ids(e)).select("message_id", "executor_id", "job_id")


DECOMMISSION_GRACE_MS = 86_400_000


@query("decommission_pairs", f"""WITH {KNOWN_CTE}
SELECT p.message_id, p.job_id, f.message_id AS terminal_id, epoch_us(f.ts) - epoch_us(p.ts) AS gap_us,
  epoch_us(f.ts) - epoch_us(p.ts) <= {DECOMMISSION_GRACE_MS * 1000} AS within_grace
FROM known p JOIN first_terminal f ON f.job_id = p.job_id AND f.message_id > p.message_id
WHERE p.kind = 'preempting'""")
def decommission_pairs(t):
    return lc.decommission_pairs(job_events(t), grace_ms=DECOMMISSION_GRACE_MS)


@query("driver_outcome", f"""WITH {JOB_EVENTS_CTE} {_DRIVERS}
SELECT job_id, CASE kind WHEN 'succeeded' THEN 'Succeeded' WHEN 'failed' THEN 'Failed'
    WHEN 'cancelled' THEN 'Cancelled' ELSE 'Preempted' END AS state,
  CASE kind WHEN 'failed' THEN coalesce(nullif(reason, ''), 'Unknown failure')
    WHEN 'cancelled' THEN 'Job cancelled' ELSE '' END AS reason
FROM job_events WHERE job_id IN (SELECT job_id FROM drivers)
  AND kind IN ('succeeded','failed','cancelled','preempted')
QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY message_id) = 1""")
def driver_outcome(t):
    return lc.driver_outcome(job_events(t), driver_jobs(t))


@query("resume_point", f"""WITH {JOB_EVENTS_CTE},
points AS (SELECT job_set, max(message_id) FILTER (kind = 'running') AS last_id FROM job_events GROUP BY job_set)
SELECT message_id, e.job_set, kind FROM job_events e JOIN points p ON p.job_set = e.job_set
WHERE message_id > coalesce(last_id, -1)""")
def resume_point(t):
    e = job_events(t).select("message_id", "job_set", "kind")
    points = e.groupBy("job_set").agg(
        F.max(F.when(F.col("kind") == "running", F.col("message_id"))).alias("last_id"),
        F.count(F.lit(1)).alias("n_events"))
    return lc.resume_from(e, points)


@query("resume_ids", f"""WITH {JOB_EVENTS_CTE}
SELECT job_set, max(message_id) AS last_id, count(*) AS n_events FROM job_events GROUP BY job_set""")
def resume_ids(t):
    return lc.resume_points(job_events(t))


_RUNNING = f"""WITH {_STATES},
changes AS (
  SELECT job_set, record_id AS message_id, 0 AS r, 0 AS p, 1 AS a FROM states
  UNION ALL SELECT job_set, submit_id, 0, 1, 0 FROM states
    WHERE submit_id < least(coalesce(terminal_id, 9e18), coalesce(register_id, 9e18))
  UNION ALL SELECT job_set, register_id, 1, CASE WHEN submit_id < register_id THEN -1 ELSE 0 END, 0
    FROM states WHERE register_id < coalesce(terminal_id, 9e18)
  UNION ALL SELECT job_set, terminal_id, CASE WHEN register_id < terminal_id THEN -1 ELSE 0 END,
    CASE WHEN submit_id < terminal_id AND coalesce(register_id, 9e18) > terminal_id THEN -1 ELSE 0 END, -1
    FROM states WHERE terminal_id IS NOT NULL),
merged AS (SELECT job_set, message_id, sum(r) AS r, sum(p) AS p, sum(a) AS a FROM changes GROUP BY ALL),
running AS (SELECT job_set, message_id,
    CAST(sum(r) OVER w AS BIGINT) AS registered, CAST(sum(p) OVER w AS BIGINT) AS pending,
    CAST(sum(a) OVER w AS BIGINT) AS active
  FROM merged WINDOW w AS (PARTITION BY job_set ORDER BY message_id))"""


@query("running_counts", f"{_RUNNING} SELECT * FROM running")
def running_counts(t):
    return lc.running_counts(job_events(t))


_AS_OF = _RUNNING + """,
counts AS (SELECT job_set, ts, registered, pending FROM running JOIN job_events USING (job_set, message_id)
  QUALIFY row_number() OVER (PARTITION BY job_set, ts ORDER BY message_id DESC) = 1),
targets AS (SELECT job_set, k % 3 AS profile, ts, k AS target, k % 16 - 1 AS cardinality FROM job_events WHERE kind = 'queued'
  QUALIFY row_number() OVER (PARTITION BY job_set, k % 3, ts ORDER BY message_id DESC) = 1),
ticks AS (SELECT message_id AS tick_id, job_set, ts FROM job_events WHERE kind = 'utilisation' AND k < 70),
profiles AS (SELECT DISTINCT job_set, profile FROM targets),
counted AS (SELECT tick_id, t.job_set, t.ts, coalesce(registered, 0) AS registered, coalesce(pending, 0) AS pending
  FROM ticks t ASOF LEFT JOIN counts c ON c.job_set = t.job_set AND t.ts >= c.ts),
each AS (SELECT * FROM counted JOIN profiles USING (job_set)),
gaps AS (SELECT tick_id, e.job_set, e.profile, target, cardinality, registered, pending, target - (registered + pending) AS gap
  FROM each e ASOF JOIN targets g ON g.job_set = e.job_set AND g.profile = e.profile AND e.ts >= g.ts),
wanted AS (SELECT job_set, count(DISTINCT job_id) % 20 AS initial FROM job_events GROUP BY job_set)"""


def _gaps(t):
    """Demand messages set targets per profile; usage reports are the ticks that ask for them."""
    e = job_events(t)
    ticks = e.filter((F.col("kind") == "utilisation") & (F.col("k") < 70)).select(F.col("message_id").alias("tick_id"), "job_set", "ts")
    targets = e.filter(F.col("kind") == "queued").select(
        "job_set", (F.col("k") % 3).alias("profile"), "ts", "message_id", F.col("k").alias("target"), (F.col("k") % 16 - 1).alias("cardinality"))
    return dm.gap_as_of(ticks, targets, dm.counts_over_time(e))


@query("gap_as_of", f"{_AS_OF} SELECT tick_id, job_set, profile, target, registered, pending, CAST(gap AS BIGINT) AS gap FROM gaps")
def gap_as_of(t):
    return _gaps(t).select("tick_id", "job_set", "profile", "target", "registered", "pending", "gap")


@query("allocate_as_of", f"""{_AS_OF},
gated AS (SELECT g.*, gap > 0 AND pending < 8 AND ((registered = 0 AND pending = 0) OR registered >= initial * CAST(0.8 AS DOUBLE)) AS allowed
  FROM gaps g JOIN wanted USING (job_set))
SELECT tick_id, job_set, profile, allowed,
  CAST(CASE WHEN allowed THEN least(gap, CASE WHEN cardinality > 0 THEN least(10, cardinality) ELSE 10 END) ELSE 0 END AS BIGINT) AS n FROM gated""")
def allocate_as_of(t):
    wanted = job_events(t).groupBy("job_set").agg((F.countDistinct("job_id") % 20).alias("initial"))
    return dm.allocate_as_of(_gaps(t), wanted, max_pending=8).select("tick_id", "job_set", "profile", "allowed", "n")
