"""Job events, configuration, pods and benchmark results derived from the star-schema tables.

Every fixture is a projection or one aggregate of a given table, so its size follows the table.
The `*_CTE` strings state the same projections for the checking SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from runlens.sources.tables import Tables


def job_events(t: Tables) -> DataFrame:
    base = t["events"].selectExpr(
        "event_id as message_id", "ts", "user_id", "event_type", "cast(get_json_object(props, '$.k') as int) as k",
        "concat('set-', user_id % 10) as job_set", "concat('job-', user_id, '-', (day(ts) - 1) div 5) as job_id")
    kinds = base.selectExpr("*", """case event_type
        when 'signup' then 'submitted'
        when 'view' then if(k < 50, 'queued', 'running')
        when 'click' then if(k < 50, 'registered', 'utilisation')
        when 'purchase' then case when k < 40 then 'succeeded' when k < 70 then 'cancelled' else 'preempting' end
        else if(k < 15, 'preempted', 'failed') end as kind""")
    return kinds.selectExpr(
        "message_id", "ts", "k", "user_id", "job_set", "job_id", "kind",
        """case when kind = 'failed' then case
             when k < 40 then concat('Preempted by scheduler using urgency preemption - preempting job job-', k)
             when k < 60 then 'OOMKilled' when k < 80 then ''
             else 'Error: Container exited with a non-zero status of 1' end end as reason""",
        "if(kind = 'failed', 'Error', null) as cause",
        """case when kind = 'failed' then case
             when k % 3 = 0 then cast(array() as array<int>) when k >= 40 and k < 60 then array(137)
             when k = 98 then array(0) else array(1) end end as exit_codes""")


JOB_EVENTS_CTE = """
job_base AS (
  SELECT event_id AS message_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         'set-' || (user_id % 10) AS job_set,
         'job-' || user_id || '-' || ((day(ts) - 1) // 5) AS job_id
  FROM events),
job_kinds AS (
  SELECT *, CASE event_type
      WHEN 'signup' THEN 'submitted'
      WHEN 'view' THEN CASE WHEN k < 50 THEN 'queued' ELSE 'running' END
      WHEN 'click' THEN CASE WHEN k < 50 THEN 'registered' ELSE 'utilisation' END
      WHEN 'purchase' THEN CASE WHEN k < 40 THEN 'succeeded' WHEN k < 70 THEN 'cancelled' ELSE 'preempting' END
      ELSE CASE WHEN k < 15 THEN 'preempted' ELSE 'failed' END END AS kind
  FROM job_base),
job_events AS (
  SELECT message_id, ts, k, user_id, job_set, job_id, kind,
    CASE WHEN kind = 'failed' THEN
      CASE WHEN k < 40 THEN 'Preempted by scheduler using urgency preemption - preempting job job-' || k
           WHEN k < 60 THEN 'OOMKilled' WHEN k < 80 THEN ''
           ELSE 'Error: Container exited with a non-zero status of 1' END END AS reason,
    CASE WHEN kind = 'failed' THEN 'Error' END AS cause,
    CASE WHEN kind = 'failed' THEN
      CASE WHEN k % 3 = 0 THEN -1 WHEN k >= 40 AND k < 60 THEN 137 WHEN k = 98 THEN 0 ELSE 1 END END AS code
  FROM job_kinds)"""

# adds the effective outcome of each event and whether the job was recorded by then
KNOWN_CTE = JOB_EVENTS_CTE + """,
flagged AS (
  SELECT *, CASE WHEN kind = 'failed' THEN
        CASE WHEN reason = '' THEN 'Unknown failure' ELSE reason END || ', Cause: ' || cause END AS full_reason,
    max(CASE WHEN kind IN ('submitted', 'registered') THEN 1 ELSE 0 END) OVER (
      PARTITION BY job_id ORDER BY message_id ROWS UNBOUNDED PRECEDING) = 1 AS known
  FROM job_events),
known AS (
  SELECT *, CASE WHEN kind = 'failed' AND full_reason ILIKE '%preempt%' THEN 'preempted' ELSE kind END AS loss_kind,
    kind IN ('succeeded', 'failed', 'cancelled', 'preempted') AS terminal
  FROM flagged WHERE known),
losses AS (
  SELECT message_id, ts, job_set, job_id, loss_kind,
    CASE loss_kind WHEN 'failed' THEN code WHEN 'succeeded' THEN 0 ELSE -1 END AS code,
    loss_kind = 'failed' AND code <> 0 AS app_caused,
    CASE loss_kind WHEN 'failed' THEN 'Job ' || job_id || ' failed: ' || full_reason
      WHEN 'preempted' THEN 'Job ' || job_id || ' was preempted: '
           || coalesce(full_reason, 'Preempted by scheduler')
      WHEN 'cancelled' THEN 'Job ' || job_id || ' was cancelled'
      ELSE 'Job ' || job_id || ' succeeded' END AS message
  FROM known WHERE terminal),
first_terminal AS (
  SELECT * FROM losses QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY message_id) = 1)"""


def driver_jobs(t: Tables) -> DataFrame:
    """Ids of driver jobs: the `-0` jobs of every tenth user."""
    e = job_events(t)
    return e.filter((F.col("user_id") % 10 == 0) & F.col("job_id").endswith("-0")).select("job_id").distinct()


def kill_requests(t: Tables) -> DataFrame:
    """Utilisation reports above a level, taken as requests to kill the job."""
    e = job_events(t)
    return e.filter((F.col("kind") == "utilisation") & (F.col("k") >= 70)).select(
        F.col("message_id").alias("kill_id"), F.col("ts").alias("kill_ts"), "job_id")


def bench_lines(t: Tables) -> DataFrame:
    """Benchmark result rows in line order: (line_no, run, query, seconds, result_hash)."""
    return t["part"].select(
        F.col("p_partkey").alias("line_no"),
        (F.col("p_partkey") % 2 + 1).cast("int").alias("run"),
        F.concat(F.lit("q"), F.expr("p_partkey div 2 % 97 + 1 + (p_partkey % 2) * 3"),
                 F.when(F.col("p_size") % 5 == 0, "a").otherwise(""), F.lit("-v2.4")).alias("query"),
        F.round(F.col("p_retailprice") / 10, 2).alias("seconds"),
        F.when(F.col("p_size") % 17 == 0, "HASH MISMATCH").otherwise(
            F.concat(F.lit("H"), F.expr("p_partkey div 194 % 3"))).alias("result_hash"),
    )


BENCH_CTE = """
bench_lines AS (
  SELECT p_partkey AS line_no, CAST(p_partkey % 2 + 1 AS INTEGER) AS run,
    'q' || ((p_partkey // 2) % 97 + 1 + (p_partkey % 2) * 3)
        || CASE WHEN p_size % 5 = 0 THEN 'a' ELSE '' END || '-v2.4' AS query,
    round(p_retailprice / 10, 2) AS seconds,
    CASE WHEN p_size % 17 = 0 THEN 'HASH MISMATCH' ELSE 'H' || ((p_partkey // 194) % 3) END AS result_hash
  FROM part),
bench AS (
  SELECT run, split_part(query, '-', 1) AS query, seconds, result_hash FROM bench_lines
  QUALIFY row_number() OVER (PARTITION BY run, split_part(query, '-', 1) ORDER BY line_no DESC) = 1),
pairs AS (
  SELECT a.query, a.seconds AS seconds_1, b.seconds AS seconds_2, a.result_hash AS hash_1, b.result_hash AS hash_2
  FROM bench a JOIN bench b ON a.query = b.query AND a.run = 1 AND b.run = 2)"""
