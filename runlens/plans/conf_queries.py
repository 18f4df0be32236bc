"""Registered queries over configuration texts, layers, documents and pod snapshots.

The fixture expressions below are plain SQL that means the same in Spark and in the checking engine.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.functions import capacity as cap, text as tx
from runlens.operators import documents as docs, layers as ly, selectors as sl, snapshots as sn, variants as va
from runlens.plans.fixtures import JOB_EVENTS_CTE, job_events
from runlens.plans.registry import query
from runlens.session import scratch_path
from runlens.sources.conf import conf_dir_scan, error_line_extract

# ---- validators -------------------------------------------------------------------------------

KEY = """CASE CAST(c_custkey % 13 AS INT)
  WHEN 0 THEN concat('example.com/', lower(c_mktsegment)) WHEN 1 THEN concat(c_mktsegment, '_', c_custkey)
  WHEN 2 THEN 'Bad_Prefix/name' WHEN 3 THEN c_name WHEN 4 THEN concat('/lead', c_custkey) WHEN 5 THEN 'trail/'
  WHEN 6 THEN repeat('a', CAST(c_custkey % 90 AS INT)) WHEN 7 THEN concat(repeat('a', CAST(210 + c_custkey % 90 AS INT)), '/foo')
  WHEN 8 THEN '' WHEN 9 THEN NULL WHEN 10 THEN 'a/b/c' WHEN 11 THEN concat('end-', c_custkey, '-')
  ELSE concat('a.b-', c_custkey, '.c/x.y_z') END"""
VALUE = """CASE CAST(c_custkey % 7 AS INT) WHEN 0 THEN '' WHEN 1 THEN c_mktsegment WHEN 2 THEN concat('-', c_custkey)
  WHEN 3 THEN repeat('v', CAST(40 + c_custkey % 40 AS INT)) WHEN 4 THEN c_name WHEN 5 THEN NULL ELSE concat('App', c_custkey) END"""
LONG_VALUE = """CASE CAST(c_custkey % 101 AS INT) WHEN 0 THEN repeat('é', CAST(131072 + c_custkey % 2 AS INT))
  WHEN 1 THEN NULL WHEN 2 THEN '' ELSE concat(c_name, ' any text / here') END"""
OBJECT_NAME = """CASE CAST(c_custkey % 9 AS INT) WHEN 0 THEN concat('pod-', c_custkey) WHEN 1 THEN concat('Pod', c_custkey)
  WHEN 2 THEN concat(lower(c_mktsegment), '.', c_custkey) WHEN 3 THEN concat('.dot', c_custkey)
  WHEN 4 THEN repeat('a', CAST(200 + c_custkey % 100 AS INT)) WHEN 5 THEN concat('x..', c_custkey) WHEN 6 THEN ''
  WHEN 7 THEN concat('end', c_custkey, '-') ELSE NULL END"""

_SUB = r"[a-z0-9]([a-z0-9\-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9\-]*[a-z0-9])?)*"
_NAME = r"[A-Za-z0-9]([A-Za-z0-9_.-]*[A-Za-z0-9])?"


def _key_ok(key: str) -> str:
    name = f"substr({key}, strpos({key}, '/') + 1)"
    prefix = f"substr({key}, 1, strpos({key}, '/') - 1)"
    return f"""coalesce(length({name}) BETWEEN 1 AND 63 AND regexp_full_match({name}, '{_NAME}')
      AND (strpos({key}, '/') = 0 OR (length({prefix}) <= 253 AND regexp_full_match({prefix}, '{_SUB}'))), false)"""


def _label_value_ok(value: str) -> str:
    return f"coalesce({value} = '' OR (length({value}) <= 63 AND regexp_full_match({value}, '{_NAME}')), false)"


@query("label_valid", f"""SELECT c_custkey, {_key_ok('k')} AS key_ok, {_label_value_ok('v')} AS value_ok
FROM (SELECT c_custkey, {KEY} AS k, {VALUE} AS v FROM customer)""")
def label_valid(t):
    c = t["customer"].select("c_custkey", F.expr(KEY).alias("k"), F.expr(VALUE).alias("v"))
    return c.select("c_custkey", tx.key_valid(F.col("k")).alias("key_ok"), tx.label_value_valid(F.col("v")).alias("value_ok"))


@query("annotation_valid", f"""SELECT c_custkey, {_key_ok('k')} AS key_ok, coalesce(strlen(v) <= 262144, false) AS value_ok
FROM (SELECT c_custkey, {KEY} AS k, {LONG_VALUE} AS v FROM customer)""")
def annotation_valid(t):
    c = t["customer"].select("c_custkey", F.expr(KEY).alias("k"), F.expr(LONG_VALUE).alias("v"))
    return c.select("c_custkey", tx.key_valid(F.col("k")).alias("key_ok"),
                    tx.annotation_value_valid(F.col("v")).alias("value_ok"))


@query("name_valid", f"""SELECT c_custkey, coalesce(length(n) BETWEEN 1 AND 253 AND regexp_full_match(n, '{_SUB}'), false) AS ok
FROM (SELECT c_custkey, {OBJECT_NAME} AS n FROM customer)""")
def name_valid(t):
    return t["customer"].select("c_custkey", tx.name_valid(F.expr(OBJECT_NAME)).alias("ok"))


@query("name_prefix_valid", f"""SELECT c_custkey, coalesce(length(n) BETWEEN 1 AND 30 AND regexp_full_match(n, '[A-Za-z0-9.-]+'), false) AS ok
FROM (SELECT c_custkey, {KEY} AS n FROM customer)""")
def name_prefix_valid(t):
    return t["customer"].select("c_custkey", tx.name_prefix_valid(F.expr(KEY)).alias("ok"))


PATH = """CASE CAST(c_custkey % 9 AS INT) WHEN 0 THEN concat('/etc/conf/', c_custkey, '.yaml') WHEN 1 THEN concat('FILE:///etc/', c_custkey)
  WHEN 2 THEN concat('HTTP://host:8080/', c_custkey) WHEN 3 THEN concat('https://host/', c_custkey) WHEN 4 THEN concat('ftp://host/', c_custkey)
  WHEN 5 THEN '' WHEN 6 THEN '://x' WHEN 7 THEN concat('./', c_custkey, '.yaml') ELSE NULL END"""


@query("path_class", f"""SELECT c_custkey, CASE WHEN p ILIKE 'http://%' OR p ILIKE 'https://%' THEN 'http' WHEN p ILIKE 'file://%' THEN 'file_uri'
  WHEN p <> '' AND strpos(p, '://') = 0 THEN 'local' ELSE 'invalid' END AS source FROM (SELECT c_custkey, {PATH} AS p FROM customer)""")
def path_class(t):
    return t["customer"].select("c_custkey", tx.path_source(F.expr(PATH)).alias("source"))


URL = """CASE CAST(c_custkey % 8 AS INT) WHEN 0 THEN concat('queue://host', c_custkey, ':50051') WHEN 1 THEN concat('queue://h:', c_custkey, ':')
  WHEN 2 THEN concat('queue://malformed:url:', c_custkey) WHEN 3 THEN 'queue://badurl' WHEN 4 THEN 'queue://localhost:badport'
  WHEN 5 THEN concat('queue://:', c_custkey) WHEN 6 THEN concat('other://h:', c_custkey) ELSE 'queue://h:99999999999' END"""


@query("master_url_parse", f"""SELECT c_custkey, ok AS valid, CASE WHEN ok THEN regexp_extract(u, '^queue://([^:]*):', 1) ELSE '' END AS host,
  CASE WHEN ok THEN CAST(port AS INTEGER) ELSE -1 END AS port
FROM (SELECT *, coalesce(port BETWEEN 0 AND 2147483647, false) AS ok FROM (
  SELECT c_custkey, u, CASE WHEN regexp_full_match(u, 'queue://[^:]*:[0-9]+:*') THEN CAST(regexp_extract(u, '://[^:]*:([0-9]+)', 1) AS BIGINT) END AS port
  FROM (SELECT c_custkey, {URL} AS u FROM customer)))""")
def master_url_parse(t):
    parsed = t["customer"].select("c_custkey", tx.master_url(F.expr(URL), "queue").alias("m"))
    return parsed.select("c_custkey", F.col("m").isNotNull().alias("valid"), F.coalesce("m.host", F.lit("")).alias("host"),
                         F.coalesce("m.port", F.lit(-1)).alias("port"))


URI = """CASE CAST(c_custkey % 9 AS INT) WHEN 0 THEN concat('/opt/app-', c_custkey, '.jar') WHEN 1 THEN concat('FILE:/opt/', c_custkey)
  WHEN 2 THEN concat('local:///opt/', c_custkey) WHEN 3 THEN concat('s3a://bucket/', c_custkey) WHEN 4 THEN concat('has blank ', c_custkey)
  WHEN 5 THEN concat('1bad:', c_custkey) WHEN 6 THEN concat('a%zz', c_custkey) WHEN 7 THEN concat('dir/with%20blank', c_custkey) ELSE 'file:' END"""


@query("resource_locality", f"""SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN true WHEN 7 THEN true ELSE false END AS is_local,
  c_custkey % 9 IN (1, 2) AS is_local_on_remote_fs FROM customer""")
def resource_locality(t):
    uri = F.expr(URI)
    return t["customer"].select("c_custkey", tx.is_local_resource(uri).alias("is_local"),
                                tx.is_local_resource(uri, "hdfs").alias("is_local_on_remote_fs"))


STATUS_LINE = """concat('pod-', c_custkey, '   1/1   ', CASE CAST(c_custkey % 40 AS INT) WHEN 3 THEN 'Failed' WHEN 7 THEN 'Error'
  WHEN 11 THEN 'CrashLoopBackOff' WHEN 17 THEN 'OOMKilled' WHEN 23 THEN 'Evicted' WHEN 29 THEN 'Completed' ELSE 'Running' END, '   0   5m')"""


@query("failed_status_scan", f"""SELECT c_nationkey AS scan_id, 'pod-' || min(c_custkey) AS name FROM customer
WHERE c_custkey > 0 AND c_custkey % 40 IN (3, 7, 11, 17, 23) GROUP BY c_nationkey""")
def failed_status_scan(t):
    lines = t["customer"].select(F.col("c_nationkey").alias("scan_id"), (F.col("c_custkey") + 1).alias("line_no"),
                                 F.expr(STATUS_LINE).alias("line"))
    return sn.failed_status_scan(lines)


LINE = "concat(kind, coalesce(concat(': ', reason), ''))"


@query("error_line_extract", f"""WITH {JOB_EVENTS_CTE}
SELECT job_set AS run_id, message_id AS line_no, line, row_number() OVER (PARTITION BY job_set ORDER BY message_id) AS place
FROM (SELECT *, {LINE} AS line FROM job_events) WHERE regexp_matches(line, 'Exception|Error|Failed|FAILED')
QUALIFY place <= 10""")
def error_lines_of_runs(t):
    lines = job_events(t).select(F.col("job_set").alias("run_id"), F.col("message_id").alias("line_no"), F.expr(LINE).alias("line"))
    return error_line_extract(lines).withColumn("place", F.col("place").cast("long"))


@query("error_lines_of_text", """SELECT c_custkey, array_to_string(list_slice(list_filter(
    list_transform(range(1, c_custkey % 60 + 2), lambda i: CASE WHEN i % 3 = 0 THEN 'Error at step ' || i WHEN i % 7 = 0 THEN 'FAILED task ' || i ELSE 'step ' || i END),
    lambda x: x LIKE '%Error%' OR x LIKE '%FAILED%'), 1, 10), '|') AS lines FROM customer""")
def error_lines_of_text(t):
    text = F.expr("""array_join(transform(sequence(1, cast(c_custkey % 60 + 1 as int)), i ->
        case when i % 3 = 0 then concat('Error at step ', i) when i % 7 = 0 then concat('FAILED task ', i) else concat('step ', i) end), '\n')""")
    return t["customer"].select("c_custkey", F.array_join(tx.error_lines(text), "|").alias("lines"))


# ---- key/value texts --------------------------------------------------------------------------

KV_TEXT = """concat(' seg=', c_mktsegment, ',, nation = ', c_nationkey, ',seg=last', c_custkey % 3,
  CASE WHEN c_custkey % 13 = 0 THEN ', ,x' WHEN c_custkey % 11 = 0 THEN ',empty=' WHEN c_custkey % 17 = 0 THEN ',a=b=c' ELSE '' END, ' ')"""


@query("kv_list_parse", """SELECT c_custkey AS app_id, unnest(['seg', 'nation']) AS key, unnest(['last' || c_custkey % 3, CAST(c_nationkey AS VARCHAR)]) AS value
  FROM customer WHERE c_custkey % 13 <> 0 AND (c_custkey % 17 <> 0 OR c_custkey % 11 = 0)
UNION ALL SELECT c_custkey, 'empty', '' FROM customer WHERE c_custkey % 13 <> 0 AND c_custkey % 11 = 0""")
def kv_list_parse(t):
    c = t["customer"].select(F.col("c_custkey").alias("app_id"), tx.kv_entries(F.expr(KV_TEXT)).alias("entries"))
    return c.select("app_id", F.explode(tx.entries_map(F.col("entries"))).alias("key", "value"))


@query("kv_list_check", """SELECT c_custkey AS app_id, c_custkey % 13 <> 0 AND (c_custkey % 17 <> 0 OR c_custkey % 11 = 0) AS valid,
  CASE WHEN c_custkey % 13 = 0 THEN 'Invalid label format: '''' (expected key=value)|Invalid label format: ''x'' (expected key=value)'
    WHEN c_custkey % 17 = 0 AND c_custkey % 11 <> 0 THEN 'Invalid label format: ''a=b=c'' (expected key=value)' ELSE '' END AS messages FROM customer""")
def kv_list_check(t):
    c = t["customer"].select(F.col("c_custkey").alias("app_id"), tx.kv_entries(F.expr(KV_TEXT)).alias("entries"))
    return c.select("app_id", tx.entries_valid(F.col("entries")).alias("valid"),
                    F.array_join(tx.entries_messages(F.col("entries")), "|").alias("messages"))


@query("conf_tokens", """SELECT c_custkey AS app_id, unnest(['spark.a', 'spark.b']) AS key, unnest(['n' || c_nationkey, 'x=' || c_custkey]) AS value FROM customer""")
def conf_tokens(t):
    text = F.expr("concat('--conf spark.a=', c_custkey, '  --conf spark.b=x=', c_custkey, ' -Dskip=1 word --conf spark.a=n', c_nationkey)")
    return t["customer"].select(F.col("c_custkey").alias("app_id"), F.explode(tx.conf_tokens(text)).alias("key", "value"))


@query("conf_dir_scan", f"""SELECT c_mktsegment AS app, count(*) AS n_lines,
  md5(sum(('0x' || substr(md5({KV_TEXT}), 1, 15))::BIGINT)::VARCHAR) AS content_md5 FROM customer GROUP BY c_mktsegment""")
def conf_dir(t):
    path = scratch_path(t.spark, "conf")
    t["customer"].select(F.col("c_mktsegment").alias("app"), F.expr(KV_TEXT).alias("value")).write.partitionBy("app").text(path)
    files = conf_dir_scan(t.spark, path, "conf").filter(F.col("key").startswith("conf/part-"))
    # the lines of an app may lie in several files, in any order: their digests are added up
    lines = files.select(F.regexp_replace("app", "^app=", "").alias("app"), F.explode(F.split(F.rtrim("content", F.lit("\n")), "\n")).alias("line"))
    part = F.conv(F.substring(F.md5("line"), 1, 15), 16, 10).cast("decimal(38,0)")
    return lines.select("app", part.alias("part")).groupBy("app").agg(
        F.md5(F.sum("part").cast("decimal(38,0)").cast("string")).alias("content_md5"), F.count(F.lit(1)).alias("n_lines"))


# ---- layers -----------------------------------------------------------------------------------

# Applications with their command line (cli_), template (tpl_) and base settings, one per order.
APP = {
    "app_id": "o_orderkey",
    "cli_queue": "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '' ELSE concat('queue-', o_custkey % 5) END",
    "tpl_queue": "CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN '' ELSE concat('tq-', o_custkey % 3) END",
    "cli_namespace": "CASE WHEN o_orderkey % 5 = 0 THEN 'default' WHEN o_orderkey % 11 < 4 THEN NULL ELSE concat('ns-', o_custkey % 9) END",
    "tpl_namespace": "CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN '' WHEN o_orderkey % 4 = 3 THEN 'default' ELSE concat('tns-', o_custkey % 4) END",
    "base_namespace": "CASE WHEN o_orderkey % 3 = 0 THEN 'base' ELSE '' END",
    "cli_priority": "CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(o_custkey % 10 AS DOUBLE) END",
    "tpl_priority": "CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 8 = 1 THEN CAST(0 AS DOUBLE) ELSE o_custkey % 7 + CAST(0.5 AS DOUBLE) END",
    "base_priority": "CAST(o_orderkey % 2 AS DOUBLE)",
    "cli_user": "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 1000 + o_custkey % 50 END",
    "tpl_user": "CASE WHEN o_orderkey % 9 < 4 THEN NULL ELSE 2000 + o_custkey % 20 END",
    "cli_image": "CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN '' ELSE concat('img:', o_custkey % 6) END",
    "driver_image": "CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE concat('drv:', o_custkey % 3) END",
    "executor_image": "CASE WHEN o_orderkey % 14 = 5 THEN NULL ELSE concat('exe:', o_custkey % 3) END",
    "cli_timeout_s": "CASE WHEN o_orderkey % 4 = 0 THEN o_custkey % 600 ELSE NULL END",
    "executor_ingresses": "CAST(CASE WHEN o_orderkey % 31 = 0 THEN 1 ELSE 0 END AS INT)",
    "driver_ingresses": "CAST(o_orderkey % 37 % 3 AS INT)",
    "cli_job_set": "CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN NULL ELSE concat('js-', o_custkey) END",
    "tpl_job_set": "CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 5 = 2 THEN '' ELSE concat('tjs-', o_custkey % 10) END",
    "env_job_set": "CASE WHEN o_orderkey % 8 = 0 THEN concat('env-', o_custkey % 10) END",
    "deploy_mode": "CASE o_orderstatus WHEN 'F' THEN 'Cluster' WHEN 'O' THEN 'client' END",
    "dynamic": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN true WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE false END",
    "instances": "CAST(o_orderkey % 4 AS INT)",
    "uniformity": "CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN '' ELSE 'zone' END",
    "captured": "o_orderkey % 5 = 2",
    "driver_host": "CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE concat('host-', o_custkey) END",
    "cli_ingress": "o_orderkey % 3 = 0",
    "tpl_ingress": "o_orderkey % 4 = 0",
    "cli_tls": "CASE o_orderkey % 9 WHEN 0 THEN false WHEN 3 THEN true END",
    "tpl_tls": "o_orderkey % 8 = 0",
    "cli_cert": "CASE WHEN o_orderkey % 15 = 0 THEN concat('cert-', o_custkey) END",
    "tpl_cert": "CASE WHEN o_orderkey % 20 = 0 THEN '' ELSE 'template-cert' END",
    "proxy_enabled": "o_orderkey % 5 = 0",
    "proxy_port": "CAST(CASE WHEN o_orderkey % 10 = 0 THEN 4280 ELSE NULL END AS INT)",
    "ui_port": "CAST(CASE WHEN o_orderkey % 7 = 0 THEN 4050 ELSE NULL END AS INT)",
    "auth_enabled": "o_orderkey % 2 = 0",
    "client_id": "CASE WHEN o_orderkey % 3 <> 0 THEN 'id' END",
    "client_secret": "CASE WHEN o_orderkey % 5 = 0 THEN 's' END",
    "secret_ref": "CASE WHEN o_orderkey % 7 < 4 THEN 'ref' END",
    "skip_discovery": "o_orderkey % 4 = 0",
    "issuer_url": "CASE WHEN o_orderkey % 9 < 6 THEN 'https://issuer' END",
    "login_url": "CASE WHEN o_custkey % 2 = 0 THEN 'l' END",
    "redeem_url": "CASE WHEN o_custkey % 3 = 0 THEN 'r' END",
    "validate_url": "CASE WHEN o_custkey % 5 <> 0 THEN 'v' END",
    "jwks_url": "CASE WHEN o_custkey % 7 <> 0 THEN 'j' END",
}
APPS_CTE = "apps AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in APP.items()) + " FROM orders)"


def apps(t, *columns: str):
    """Only the columns a query needs are built."""
    names = columns or APP
    return t["orders"].selectExpr(*[f"{APP[n]} AS {n}" for n in names])


@query("resolve_value", f"""WITH {APPS_CTE}
SELECT app_id, coalesce(cli_queue, tpl_queue, 'none') AS queue, coalesce(cli_priority, tpl_priority, 0.0) AS priority FROM apps""")
def resolve_value(t):
    return apps(t, "app_id", "cli_queue", "tpl_queue", "cli_priority", "tpl_priority").select(
        "app_id", F.coalesce("cli_queue", "tpl_queue", F.lit("none")).alias("queue"),
        F.coalesce("cli_priority", "tpl_priority", F.lit(0.0)).alias("priority"))


@query("resolve_value_long", f"""WITH {APPS_CTE},
long AS (SELECT app_id, 'cli' AS layer, 3 AS s, 'queue' AS key, cli_queue AS value FROM apps UNION ALL SELECT app_id, 'template', 2, 'queue', tpl_queue FROM apps
  UNION ALL SELECT app_id, 'cli', 3, 'image', cli_image FROM apps UNION ALL SELECT app_id, 'template', 2, 'image', driver_image FROM apps
  UNION ALL SELECT app_id, 'default', 1, 'image', 'none' FROM apps)
SELECT app_id, key, value, layer FROM long WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY app_id, key ORDER BY s DESC) = 1""")
def resolve_value_long(t):
    a = apps(t, "app_id", "cli_queue", "tpl_queue", "cli_image", "driver_image")
    long = a.selectExpr("app_id", """stack(5, 'cli', 'queue', cli_queue, 'template', 'queue', tpl_queue, 'cli', 'image', cli_image,
        'template', 'image', driver_image, 'default', 'image', 'none') as (layer, key, value)""")
    return ly.resolve_long(long)


@query("resolve_job", f"""WITH {APPS_CTE}, first AS (SELECT *, coalesce(cli_namespace, tpl_namespace, 'default') AS n, coalesce(cli_priority, tpl_priority, 0.0) AS p FROM apps)
SELECT app_id, CASE WHEN n <> 'default' THEN n WHEN tpl_namespace <> '' THEN tpl_namespace WHEN base_namespace <> '' THEN base_namespace ELSE 'default' END AS namespace,
  CASE WHEN p <> 0.0 THEN p WHEN tpl_priority <> 0.0 THEN tpl_priority ELSE base_priority END AS priority,
  coalesce(cli_user, tpl_user, 185) AS run_as_user, coalesce(cli_image, driver_image) AS image, coalesce(cli_timeout_s, 300) AS timeout_s FROM first""")
def resolve_job(t):
    return ly.resolve_job(apps(t, "app_id", "cli_namespace", "tpl_namespace", "base_namespace", "cli_priority", "tpl_priority",
                               "base_priority", "cli_user", "tpl_user", "cli_image", "driver_image", "cli_timeout_s"))


_CELLS = """SELECT o_orderkey AS app_id, role, resource, bound,
  CASE WHEN (o_orderkey + r * 3 + b) % 4 = 0 THEN concat(o_custkey % 8 + 1, CASE WHEN resource = 'memory' THEN 'Gi' ELSE '' END) END AS cli,
  CASE WHEN (o_orderkey + r + b * 5) % 3 = 0 THEN concat(o_custkey % 5 + 1, CASE WHEN resource = 'memory' THEN 'Mi' ELSE '00m' END) END AS template FROM """
_GRID = """(VALUES (0, 'driver', 'memory', 0, 'limit'), (0, 'driver', 'memory', 1, 'request'), (0, 'driver', 'cpu', 2, 'limit'), (0, 'driver', 'cpu', 3, 'request'),
  (1, 'executor', 'memory', 0, 'limit'), (1, 'executor', 'memory', 1, 'request'), (1, 'executor', 'cpu', 2, 'limit'), (1, 'executor', 'cpu', 3, 'request')) AS g(r, role, resource, b, bound)"""


@query("resolve_resources", f"""WITH cells AS ({_CELLS} orders, {_GRID}),
v AS (SELECT *, coalesce(cli, template, CASE resource WHEN 'memory' THEN '1Gi' ELSE '1' END) AS value FROM cells)
SELECT app_id, role, max(value) FILTER (resource = 'memory' AND bound = 'limit') AS memory_limit, max(value) FILTER (resource = 'memory' AND bound = 'request') AS memory_request,
  max(value) FILTER (resource = 'cpu' AND bound = 'limit') AS cpu_limit, max(value) FILTER (resource = 'cpu' AND bound = 'request') AS cpu_request FROM v GROUP BY app_id, role""")
def resolve_resources(t):
    cells = {}
    for r, role in enumerate(("driver", "executor")):
        for b, (resource, bound) in enumerate((("memory", "limit"), ("memory", "request"), ("cpu", "limit"), ("cpu", "request"))):
            big, small = ("Gi", "Mi") if resource == "memory" else ("", "00m")
            cells[f"cli_{role}_{resource}_{bound}"] = F.expr(f"if((o_orderkey + {r * 3 + b}) % 4 = 0, concat(o_custkey % 8 + 1, '{big}'), null)")
            cells[f"tpl_{role}_{resource}_{bound}"] = F.expr(f"if((o_orderkey + {r + b * 5}) % 3 = 0, concat(o_custkey % 5 + 1, '{small}'), null)")
    return ly.resolve_resources(t["orders"].select(F.col("o_orderkey").alias("app_id"), *[c.alias(n) for n, c in cells.items()]))


_RESOURCES = """map_from_arrays(array('memory', 'gpu', 'ephemeral-storage'),
  array(concat(o_custkey % 9, 'Gi'), cast(o_custkey % 2 as string), concat(o_custkey % 7, 'Mi')))"""


@query("extra_resources", """SELECT app_id, key, value FROM (SELECT o_orderkey AS app_id, unnest(['memory', 'cpu', 'gpu', 'ephemeral-storage']) AS key,
  unnest([CASE WHEN o_orderkey % 4 = 0 THEN 'cliGi' WHEN o_orderkey % 3 = 0 THEN '1Gi' ELSE (o_custkey % 9) || 'Gi' END, '1',
    CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey % 2 AS VARCHAR) END, CASE WHEN o_orderkey % 3 <> 0 THEN (o_custkey % 7) || 'Mi' END]) AS value FROM orders)
WHERE value IS NOT NULL""")
def extra_resources(t):
    resources = F.when(F.col("o_orderkey") % 3 != 0, F.expr(_RESOURCES))
    cli = F.when(F.col("o_orderkey") % 4 == 0, "cliGi")
    merged = ly.resolved_resources(resources, cli, F.lit(None).cast("string"))
    return t["orders"].select(F.col("o_orderkey").alias("app_id"), F.explode(merged).alias("key", "value"))


@query("resolve_ingress", f"""WITH {APPS_CTE},
i AS (SELECT * FROM apps WHERE cli_ingress OR tpl_ingress)
SELECT app_id, CASE WHEN cli_ingress AND tpl_ingress THEN 'both=cli, cli=1, tpl=1' WHEN cli_ingress THEN 'both=cli, cli=1' ELSE 'both=tpl, tpl=1' END AS annotations,
  coalesce(CASE WHEN cli_ingress THEN cli_tls END, CASE WHEN tpl_ingress THEN tpl_tls END, false) AS tls,
  coalesce(CASE WHEN cli_ingress THEN cli_cert END, CASE WHEN tpl_ingress THEN tpl_cert END, '') AS cert,
  CASE WHEN proxy_enabled THEN coalesce(proxy_port, 4180) ELSE coalesce(ui_port, 4040) END AS port FROM i""")
def resolve_ingress(t):
    a = apps(t, "app_id", "cli_ingress", "tpl_ingress", "cli_tls", "tpl_tls", "cli_cert", "tpl_cert", "proxy_enabled", "proxy_port", "ui_port")
    a = a.withColumns({"tpl_annotations": F.expr("map('both', 'tpl', 'tpl', '1')"), "cli_annotations": F.expr("map('both', 'cli', 'cli', '1')")})
    return ly.resolve_ingress(a).withColumn("annotations", sn.map_text(F.col("annotations")))


@query("node_selector", """SELECT app_id, key, value FROM (SELECT o_orderkey AS app_id, unnest(['cli', 'tpl', 'zone']) AS key,
  unnest([CASE WHEN o_orderkey % 3 = 0 THEN '1' END, CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 4 <> 0 THEN '1' END,
    CASE WHEN o_orderkey % 5 = 0 THEN 'captured-' || o_custkey % 3 WHEN o_orderkey % 3 = 0 THEN 'own' END]) AS value FROM orders) WHERE value IS NOT NULL""")
def node_selector(t):
    k = F.col("o_orderkey")
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    cli = F.when(k % 3 == 0, F.expr("map('cli', '1', 'zone', 'own')")).when(k % 3 == 1, empty)
    tpl = F.when(k % 4 != 0, F.expr("map('tpl', '1')"))
    zone = F.when(k % 5 == 0, F.concat(F.lit("captured-"), F.col("o_custkey") % 3)).otherwise("")
    chosen = ly.node_selector(cli, tpl, F.lit("zone"), zone)
    return t["orders"].select(k.alias("app_id"), F.explode(chosen).alias("key", "value"))


@query("required_rules", f"""WITH {APPS_CTE},
r AS (SELECT app_id, 1 AS rule_no, 'container image is empty' AS message FROM apps WHERE cli_image = ''
  UNION ALL SELECT app_id, 2, 'container image must be set or be in both templates (driver: ' || (driver_image IS NOT NULL) || ', executor: ' || (executor_image IS NOT NULL) || ')'
    FROM apps WHERE cli_image IS NULL AND (driver_image IS NULL OR executor_image IS NULL)
  UNION ALL SELECT app_id, 3, 'executor template must not have an ingress' FROM apps WHERE executor_ingresses > 0
  UNION ALL SELECT app_id, 4, 'driver template can have one ingress only' FROM apps WHERE driver_ingresses > 1
  UNION ALL SELECT app_id, 5, 'queue is not set' FROM apps WHERE coalesce(cli_queue, '') = '' AND coalesce(tpl_queue, '') = ''
  UNION ALL SELECT app_id, 6, 'job set id is empty' FROM apps WHERE cli_job_set = '')
SELECT app_id, CAST(rule_no AS INTEGER) AS rule_no, message FROM r""")
def required_rules(t):
    return ly.required_rules(apps(t, "app_id", "cli_image", "driver_image", "executor_image", "executor_ingresses", "driver_ingresses",
                                  "cli_queue", "tpl_queue", "cli_job_set"))


@query("auth_rules", f"""WITH {APPS_CTE}, e AS (SELECT * FROM apps WHERE auth_enabled),
r AS (SELECT app_id, 1 AS rule_no, 'clientId is not set' AS message FROM e WHERE client_id IS NULL
  UNION ALL SELECT app_id, 2, 'neither clientSecret nor its reference is set' FROM e WHERE client_secret IS NULL AND secret_ref IS NULL
  UNION ALL SELECT app_id, 3, 'issuerUrl is not set' FROM e WHERE NOT skip_discovery AND issuer_url IS NULL
  UNION ALL SELECT app_id, 4, 'loginUrl is not set' FROM e WHERE skip_discovery AND login_url IS NULL
  UNION ALL SELECT app_id, 5, 'redeemUrl is not set' FROM e WHERE skip_discovery AND redeem_url IS NULL
  UNION ALL SELECT app_id, 6, 'validateUrl is not set' FROM e WHERE skip_discovery AND validate_url IS NULL
  UNION ALL SELECT app_id, 7, 'jwksUrl is not set' FROM e WHERE skip_discovery AND jwks_url IS NULL)
SELECT app_id, CAST(rule_no AS INTEGER) AS rule_no, message FROM r""")
def auth_rules(t):
    return ly.auth_rules(apps(t, "app_id", "auth_enabled", "client_id", "client_secret", "secret_ref", "skip_discovery", "issuer_url",
                              "login_url", "redeem_url", "validate_url", "jwks_url"))


# Fixed values: (key, kind, unit, default, check); keys without their common prefix. Only `dashboardUrl` is a name of our own, as that key bears a product's.
SETTINGS = [
    ("executor.connectionTimeout", "time", "s", "300s", "positive"),
    ("dashboardUrl", "text", "", "http://localhost:30000", "http"),
    ("health.checkTimeout", "time", "s", "5", "positive"),
    ("driver.watchEnabled", "boolean", "", "true", ""),
    ("driver.watchTimeout", "time", "s", "0s", "non_negative"),
    ("scheduling.priority", "number", "", None, "non_negative"),
    ("killGracePeriod", "time", "ms", "5s", "positive"),
    ("allocation.batchSize", "integer", "", "10", "positive"),
    ("allocation.maxPendingJobs", "integer", "", "100", "positive"),
    ("allocation.checkInterval", "time", "ms", "10s", "positive"),
    ("eventWatcher.useTls", "boolean", "", "false", ""),
    ("executor.preemptionGracePeriod", "time", "s", "180", "positive"),
    ("runAsUser", "long", "", None, ""),
    ("deleteExecutors", "boolean", "", "true", ""),
    ("scheduling.initialPriorityClass", "text", "", None, "nonempty"),
    ("scheduling.nodeUniformity", "text", "", None, "label_key"),
    ("pod.labels", "text", "", None, "labels"),
    ("driver.ingress.annotations", "text", "", None, "annotations"),
    ("jobTemplate", "text", "", None, "path"),
    ("oauth.proxy.port", "integer", "", "4180", "positive"),
]
_SETTING_KEYS = [key for key, *_ in SETTINGS]
SETTING_KEY = f"CASE CAST(o_orderkey % {len(SETTINGS) + 2} AS INT) " + " ".join(
    f"WHEN {i} THEN '{key}'" for i, key in enumerate(_SETTING_KEYS)) + " ELSE 'other.setting' END"
SETTING_VALUE = """CASE CAST(o_orderkey % 17 AS INT) WHEN 0 THEN concat(o_custkey % 90, 's') WHEN 1 THEN concat(o_custkey % 50, 'min') WHEN 2 THEN concat(o_custkey)
  WHEN 3 THEN concat('-', o_custkey % 5) WHEN 4 THEN 'true' WHEN 5 THEN 'FALSE' WHEN 6 THEN 'http://dashboard:8080' WHEN 7 THEN 'junk' WHEN 8 THEN concat(o_custkey % 4000, 'ms')
  WHEN 9 THEN NULL WHEN 10 THEN '' WHEN 11 THEN '3000000000' WHEN 12 THEN 'NaN' WHEN 13 THEN concat('a.b/c=', o_custkey, ',d=e') WHEN 14 THEN 'ftp://host/x'
  WHEN 15 THEN concat('k=has blank ', o_custkey) ELSE '0' END"""


def _setting_rows_sql() -> str:
    rows = ", ".join(f"('{k}', '{kind}', '{unit}', {'NULL' if d is None else repr(d)}, '{check}')" for k, kind, unit, d, check in SETTINGS)
    return f"(VALUES {rows}) AS s(key, kind, unit, dflt, chk)"


@query("typed_conf", f"""WITH entries AS (SELECT o_custkey AS app_id, o_orderkey AS pos, {SETTING_KEY} AS key, {SETTING_VALUE} AS value FROM orders),
last AS (SELECT app_id, key, value FROM entries WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY app_id, key ORDER BY pos DESC) = 1),
full_ AS (SELECT a.app_id, s.*, last.value IS NOT NULL AS given, coalesce(last.value, dflt) AS text
  FROM (SELECT DISTINCT app_id FROM entries) a CROSS JOIN {_setting_rows_sql()} LEFT JOIN last ON last.app_id = a.app_id AND last.key = s.key),
parts AS (SELECT *, regexp_full_match(text, '-?[0-9]+(us|ms|s|m|min|h|d)?') AS time_ok, TRY_CAST(regexp_extract(text, '^-?[0-9]+') AS BIGINT) AS n,
  coalesce(nullif(regexp_extract(text, '[a-z]*$'), ''), unit) AS u FROM full_),
num AS (SELECT *, CASE WHEN kind = 'time' AND time_ok THEN CAST(floor(n * CASE u WHEN 'ms' THEN 1 WHEN 's' THEN 1000 WHEN 'min' THEN 60000 END / (CASE unit WHEN 's' THEN 1000 ELSE 1 END)) AS DOUBLE)
  WHEN kind = 'integer' THEN CAST(TRY_CAST(text AS INTEGER) AS DOUBLE) WHEN kind = 'long' THEN CAST(TRY_CAST(text AS BIGINT) AS DOUBLE) WHEN kind = 'number' THEN TRY_CAST(text AS DOUBLE)
  WHEN kind = 'boolean' AND lower(text) = 'true' THEN 1.0 WHEN kind = 'boolean' AND lower(text) = 'false' THEN 0.0 END AS number FROM parts)
SELECT app_id, key, given, coalesce(text, '') AS text, coalesce(number, -999.0) AS number,
  CASE WHEN text IS NULL THEN true WHEN chk = 'http' THEN text LIKE 'http%' WHEN chk = 'nonempty' THEN text <> ''
    WHEN chk = 'path' THEN text <> '' AND text NOT LIKE '%://%' OR text LIKE 'http://%'
    WHEN chk = 'label_key' THEN text = '' OR {_key_ok('text')}
    WHEN chk = 'labels' THEN text = '' OR text LIKE 'a.b/c=%'
    WHEN chk = 'annotations' THEN text = '' OR text LIKE 'a.b/c=%' OR text LIKE 'k=%'
    WHEN number IS NULL OR isnan(number) AND chk <> '' THEN false
    WHEN chk = 'positive' THEN number > 0 WHEN chk = 'non_negative' THEN number >= 0 ELSE true END AS valid FROM num""")
def typed_conf(t):
    entries = t["orders"].select(F.col("o_custkey").alias("app_id"), F.col("o_orderkey").alias("pos"),
                                 F.expr(SETTING_KEY).alias("key"), F.expr(SETTING_VALUE).alias("value"))
    return ly.typed_settings(entries, SETTINGS).select("app_id", "key", "given", F.coalesce("text", F.lit("")).alias("text"),
                                             F.coalesce("number", F.lit(-999.0)).alias("number"), "valid")


@query("map_layers", """WITH entries AS (SELECT o_custkey AS app_id, o_orderkey % 3 AS layer, 'key-' || (o_orderkey // 3) % 6 AS key, o_orderkey AS value FROM orders)
SELECT app_id, key, CAST(max(value) AS VARCHAR) AS value FROM entries e
WHERE layer = (SELECT max(layer) FROM entries x WHERE x.app_id = e.app_id AND x.key = e.key) GROUP BY app_id, key""")
def map_layers(t):
    entries = t["orders"].select(F.col("o_custkey").alias("app_id"), F.concat(F.lit("key-"), F.expr("o_orderkey div 3 % 6")).alias("key"),
                                 F.struct(F.expr("o_orderkey % 3"), "o_orderkey").alias("layer"), F.col("o_orderkey").cast("string").alias("value"))
    return ly.merge_layers(entries, ["app_id", "key"])


@query("map_layers_of_maps", """SELECT app_id, key, value FROM (SELECT o_orderkey AS app_id, unnest(['a', 'b', 'c']) AS key,
  unnest([CASE WHEN o_orderkey % 3 = 0 THEN 'role' ELSE 'pod' END, CASE WHEN o_orderkey % 3 = 0 THEN 'role' WHEN o_orderkey % 4 <> 0 THEN 'template' END,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'template' END]) AS value FROM orders) WHERE value IS NOT NULL""")
def map_layers_of_maps(t):
    k = F.col("o_orderkey")
    pod = F.expr("map('a', 'pod')")
    template = F.when(k % 4 != 0, F.expr("map('b', 'template', 'c', 'template')"))
    role = F.when(k % 3 == 0, F.expr("map('a', 'role', 'b', 'role')"))
    return t["orders"].select(k.alias("app_id"), F.explode(ly.merge_maps(pod, template, role)).alias("key", "value"))


@query("missing_entries", """SELECT app_id, key, value FROM (SELECT o_orderkey AS app_id, unnest(['zone', 'disk']) AS key,
  unnest([CASE WHEN o_orderkey % 4 = 0 OR o_custkey % 3 <> 1 THEN 'z1' END, CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 2 = 0 THEN 'ssd' END]) AS value FROM orders) WHERE value IS NOT NULL""")
def missing(t):
    expected = F.expr("map('zone', 'z1', 'disk', 'ssd')")
    actual = F.expr("""case when o_orderkey % 4 <> 0 then if(o_orderkey % 2 = 0, map('zone', concat('z', o_custkey % 3)),
        map('zone', concat('z', o_custkey % 3), 'disk', 'ssd')) end""")
    return t["orders"].select(F.col("o_orderkey").alias("app_id"), F.explode(ly.missing_entries(expected, actual)).alias("key", "value"))


@query("merge_by_name", """WITH items AS (SELECT o_custkey AS app_id, o_orderkey % 2 AS layer, o_orderkey AS pos,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'VAR' || o_orderkey % 5 END AS name, 'v' || o_orderkey AS value FROM orders)
SELECT app_id, name, value FROM items WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY app_id, name ORDER BY layer DESC, pos DESC) = 1""")
def merge_by_name(t):
    items = t["orders"].selectExpr("o_custkey as app_id", "o_orderkey % 2 as layer", "o_orderkey as pos",
                                   "if(o_orderkey % 9 = 0, null, concat('VAR', o_orderkey % 5)) as name", "concat('v', o_orderkey) as value")
    return ly.merge_by_name(items)


@query("first_capture", f"""WITH {JOB_EVENTS_CTE},
a AS (SELECT user_id AS app_id, message_id, CASE WHEN k % 5 = 0 THEN '' ELSE 'zone' END AS label, CASE WHEN k % 7 = 0 THEN '' WHEN k % 11 = 0 THEN NULL ELSE 'z' || k END AS value FROM job_events)
SELECT app_id, label, value FROM a WHERE label <> '' AND value <> '' AND app_id % 4 > 1 QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY message_id) = 1""")
def first_capture(t):
    e = job_events(t).selectExpr("user_id as app_id", "message_id", "if(k % 5 = 0, '', 'zone') as label",
                                 "case when k % 7 = 0 then '' when k % 11 = 0 then null else concat('z', k) end as value",
                                 "case user_id % 4 when 0 then null when 1 then '' else 'zone' end as uniformity")
    return ly.first_capture(e, configured=F.col("uniformity"))


# ---- capacity ---------------------------------------------------------------------------------

MODE_SQL = """CASE WHEN lower(coalesce(deploy_mode, 'cluster')) = 'cluster' OR env_job_set IS NOT NULL
  THEN CASE WHEN coalesce(dynamic, false) THEN 'DynamicCluster' ELSE 'StaticCluster' END
  ELSE CASE WHEN coalesce(dynamic, false) THEN 'DynamicClient' ELSE 'StaticClient' END END"""
_MODES = f"{APPS_CTE}, modes AS (SELECT *, {MODE_SQL} AS mode FROM apps)"


def _modes(t, *columns: str):
    a = apps(t, "app_id", "deploy_mode", "env_job_set", "dynamic", *columns)
    return a.withColumn("mode", cap.mode(F.col("deploy_mode"), F.col("env_job_set").isNotNull(), F.col("dynamic")))


@query("mode_class", f"WITH {_MODES} SELECT app_id, mode FROM modes")
def mode_class(t):
    return _modes(t).select("app_id", "mode")


_CARDINALITY_SQL = """CASE mode WHEN 'StaticCluster' THEN instances + 1 WHEN 'StaticClient' THEN instances
  WHEN 'DynamicCluster' THEN CASE WHEN captured THEN 0 ELSE instances + 1 END ELSE CASE WHEN captured THEN 0 ELSE instances END END"""


@query("cardinality", f"WITH {_MODES} SELECT app_id, mode, {_CARDINALITY_SQL} AS cardinality FROM modes")
def cardinality(t):
    return _modes(t, "instances", "captured").select(
        "app_id", "mode", cap.cardinality(F.col("mode"), F.col("instances"), F.col("captured")).alias("cardinality"))


@query("mode_rules", f"""WITH {_MODES},
r AS (SELECT app_id, 1 AS rule_no, 'node uniformity label is not set' AS message FROM modes WHERE mode LIKE 'Dynamic%' AND coalesce(uniformity, '') = ''
  UNION ALL SELECT app_id, 2, 'initial executors must be >= ' || CASE mode WHEN 'DynamicClient' THEN 2 ELSE 1 END || ', got ' || instances FROM modes
    WHERE mode LIKE 'Dynamic%' AND instances < CASE mode WHEN 'DynamicClient' THEN 2 ELSE 1 END
  UNION ALL SELECT app_id, 3, 'executor count must be > 0, got ' || instances FROM modes WHERE mode LIKE 'Static%' AND instances <= 0
  UNION ALL SELECT app_id, 4, 'driver host is not set' FROM modes WHERE mode LIKE '%Client' AND driver_host IS NULL)
SELECT app_id, CAST(rule_no AS INTEGER) AS rule_no, message FROM r""")
def mode_rules(t):
    m = _modes(t, "instances", "uniformity", "driver_host")
    return ly.explode_violations(m, cap.mode_violations(F.col("mode"), F.col("instances"), F.col("uniformity"), F.col("driver_host")))


@query("priority_class", f"""WITH {_MODES} SELECT app_id, CASE WHEN app_id % 10 = 0 OR {_CARDINALITY_SQL} > 0 THEN 'initial' ELSE 'scale-up' END AS priority_class FROM modes""")
def priority_class(t):
    size = cap.cardinality(F.col("mode"), F.col("instances"), F.col("captured"))
    return _modes(t, "instances", "captured").select("app_id", cap.priority_class(
        F.col("app_id") % 10 == 0, size, F.lit("initial"), F.lit("scale-up")).alias("priority_class"))


@query("job_set_id", f"""WITH {_MODES}
SELECT app_id, coalesce(CASE WHEN mode LIKE '%Cluster' THEN env_job_set ELSE coalesce(cli_job_set, 'app-' || app_id) END, '') AS running_id,
  coalesce(nullif(cli_job_set, ''), nullif(tpl_job_set, ''), 'app-' || app_id) AS submitted_id FROM modes""")
def job_set_id(t):
    app = F.concat(F.lit("app-"), "app_id")
    running = cap.job_set_id(F.col("mode"), F.col("env_job_set"), F.col("cli_job_set"), app)
    return _modes(t, "cli_job_set", "tpl_job_set").select(
        "app_id", F.coalesce(running, F.lit("")).alias("running_id"),
        cap.submitted_job_set_id(F.col("cli_job_set"), F.col("tpl_job_set"), app).alias("submitted_id"))


_TICKS = """targets AS (SELECT CAST(o_orderdate AS DATE) AS tick, o_orderpriority AS profile, count(*) * 12 AS target, min(o_custkey) % 16 - 1 AS cardinality
  FROM orders GROUP BY ALL),
counts AS (SELECT CAST(o_orderdate AS DATE) AS tick, count(*) FILTER (o_orderstatus = 'F') AS current, count(*) FILTER (o_orderstatus = 'P') AS pending,
  count(*) % 3 <> 0 AS ready FROM orders GROUP BY 1),
ticks AS (SELECT *, target - (current + pending) AS gap FROM targets JOIN counts USING (tick))"""


def _ticks(t):
    o = t["orders"].select(F.col("o_orderdate").cast("date").alias("tick"), F.col("o_orderpriority").alias("profile"), "o_orderstatus", "o_custkey")
    targets = o.groupBy("tick", "profile").agg((F.count(F.lit(1)) * 12).alias("target"), (F.min("o_custkey") % 16 - 1).alias("cardinality"))
    counts = o.groupBy("tick").agg(F.count_if(F.col("o_orderstatus") == "F").alias("current"), F.count_if(F.col("o_orderstatus") == "P").alias("pending"),
                                   (F.count(F.lit(1)) % 3 != 0).alias("ready"))
    ticks = targets.join(counts, "tick")
    return ticks.withColumn("gap", cap.gap(F.col("target"), F.col("current"), F.col("pending"))).withColumn("tick", F.col("tick").cast("string"))


@query("gap", f"WITH {_TICKS} SELECT CAST(tick AS VARCHAR) AS tick, profile, gap FROM ticks")
def gap(t):
    return _ticks(t).select("tick", "profile", "gap")


@query("to_allocate", f"""WITH {_TICKS} SELECT CAST(tick AS VARCHAR) AS tick, profile, CAST(least(gap, CASE WHEN cardinality > 0 THEN least(10, cardinality) ELSE 10 END) AS BIGINT) AS n
FROM ticks""")
def to_allocate(t):
    return _ticks(t).select("tick", "profile", cap.to_allocate(F.col("gap"), F.col("cardinality")).alias("n"))


@query("allocate_gate", f"""WITH {_TICKS} SELECT CAST(tick AS VARCHAR) AS tick, profile, gap > 0 AND pending < 3 AND ((current = 0 AND pending = 0) OR ready) AS allowed FROM ticks""")
def allocate_gate(t):
    return _ticks(t).select("tick", "profile", cap.may_allocate(
        F.col("gap"), F.col("current"), F.col("pending"), F.col("ready"), max_pending=3).alias("allowed"))


# ---- pod snapshots ----------------------------------------------------------------------------

_PODS = """pods AS (SELECT s AS snapshot, 'pod-' || c_custkey AS pod, c_custkey AS pod_no, CASE WHEN c_custkey % 10 = 0 THEN 'driver' ELSE 'executor' END AS role,
  'test-' || c_nationkey AS test_id, CASE WHEN (c_custkey + s) % 4 <> 0 THEN lower(c_mktsegment) END AS segment,
  CASE WHEN c_custkey % 6 <> 0 THEN 'zone-' || c_nationkey % 3 END AS zone, CASE WHEN c_custkey % 4 <> 0 THEN 'ssd' ELSE 'hdd' END AS disk
  FROM customer, (VALUES (1), (2), (3)) AS v(s) WHERE (c_custkey + s) % 5 <> 0)"""


def pods(t):
    seen = t["customer"].withColumn("snapshot", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).filter(
        (F.col("c_custkey") + F.col("snapshot")) % 5 != 0)
    return seen.selectExpr(
        "snapshot", "concat('pod-', c_custkey) as pod", "c_custkey as pod_no", "c_nationkey",
        """map_filter(map('spark-role', if(c_custkey % 10 = 0, 'driver', 'executor'), 'test-id', concat('test-', c_nationkey),
             'segment', if((c_custkey + snapshot) % 4 <> 0, lower(c_mktsegment), null)), (k, v) -> v is not null) as labels""",
        """map_filter(map('zone', if(c_custkey % 6 <> 0, concat('zone-', c_nationkey % 3), null), 'disk', if(c_custkey % 4 <> 0, 'ssd', 'hdd')),
             (k, v) -> v is not null) as node_selector""")


@query("label_select", f"WITH {_PODS} SELECT snapshot, pod FROM pods WHERE role = 'executor' AND segment = 'building'")
def label_select(t):
    return sn.label_select(pods(t), {"spark-role": "executor", "segment": "building"}).select("snapshot", "pod")


@query("label_select_per_test", f"""WITH {_PODS} SELECT snapshot, pod, test_id FROM pods JOIN nation ON test_id = 'test-' || n_nationkey
WHERE role = 'executor' AND segment = CASE n_nationkey % 2 WHEN 0 THEN 'building' ELSE 'machinery' END""")
def label_select_per_test(t):
    checks = t["nation"].selectExpr("concat('test-', n_nationkey) as test_id",
                                    "map('spark-role', 'executor', 'segment', if(n_nationkey % 2 = 0, 'building', 'machinery')) as selector")
    return sn.select_per_test(pods(t), checks).select("snapshot", "pod", "test_id")


_APP_PODS = _PODS + """,
selectors AS (SELECT 'order-' || o_orderkey AS selector_id, 'app-' || o_custkey AS app, 'executor' AS role,
    CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'building' ELSE 'machinery' END AS segment, NULL AS test_id FROM orders
  UNION ALL SELECT 'nation-' || n_nationkey, NULL, 'driver', NULL, 'test-' || n_nationkey FROM nation
  UNION ALL SELECT 'role-' || r_regionkey, NULL, CASE r_regionkey WHEN 0 THEN 'driver' WHEN 1 THEN 'executor' ELSE 'nobody' END, NULL, NULL FROM region)"""


@query("label_select_many", f"""WITH {_APP_PODS}
SELECT selector_id, snapshot, pod FROM selectors s JOIN pods p ON s.app = 'app-' || p.pod_no AND s.role = p.role AND (s.segment IS NULL OR s.segment = p.segment)
UNION ALL SELECT selector_id, snapshot, pod FROM selectors s JOIN pods p ON s.test_id = p.test_id AND s.role = p.role WHERE s.app IS NULL
UNION ALL SELECT selector_id, snapshot, pod FROM selectors s JOIN pods p ON s.role = p.role WHERE s.app IS NULL AND s.test_id IS NULL""")
def label_select_many(t):
    """One selector per order, nation and region against all pods."""
    held = pods(t).withColumn("labels", F.map_concat("labels", F.create_map(F.lit("app"), F.concat(F.lit("app-"), F.col("pod_no").cast("string")))))
    orders = t["orders"].selectExpr("concat('order-', o_orderkey) as selector_id", """map_filter(map('app', concat('app-', o_custkey), 'spark-role', 'executor',
        'segment', case o_orderkey % 3 when 0 then null when 1 then 'building' else 'machinery' end), (k, v) -> v is not null) as selector""")
    nations = t["nation"].selectExpr("concat('nation-', n_nationkey) as selector_id", "map('spark-role', 'driver', 'test-id', concat('test-', n_nationkey)) as selector")
    roles = t["region"].selectExpr("concat('role-', r_regionkey) as selector_id",
                                   "map('spark-role', case r_regionkey when 0 then 'driver' when 1 then 'executor' else 'nobody' end) as selector")
    found = sl.select_many(held, orders.unionByName(nations).unionByName(roles))
    return found.select("selector_id", "snapshot", "pod")


@query("pod_count_check", f"""WITH {_PODS},
checks AS (SELECT s AS snapshot, 'test-' || n_nationkey AS test_id, role, CASE role WHEN 'driver' THEN 5 ELSE 40 + n_nationkey % 3 END AS expected
  FROM nation, (VALUES (1), (2), (3)) AS v(s), (VALUES ('driver'), ('executor')) AS r(role)),
n AS (SELECT snapshot, test_id, role, count(*) AS found FROM pods GROUP BY ALL)
SELECT c.snapshot, c.test_id, c.role, c.expected, coalesce(found, 0) AS found, coalesce(found, 0) = expected AS passed,
  CASE WHEN coalesce(found, 0) = expected THEN '' ELSE 'Expected ' || expected || ' pods with selector ''spark-role=' || c.role || ',test-id=' || c.test_id || ''', found ' || coalesce(found, 0) END AS message
FROM checks c LEFT JOIN n ON n.snapshot = c.snapshot AND n.test_id = c.test_id AND n.role = c.role""")
def pod_count_check(t):
    checks = t["nation"].selectExpr("n_nationkey", "explode(array(1, 2, 3)) as snapshot").selectExpr(
        "snapshot", "concat('test-', n_nationkey) as test_id", "explode(array('driver', 'executor')) as role", "n_nationkey").selectExpr(
        "snapshot", "test_id", "role", "if(role = 'driver', 5, 40 + n_nationkey % 3) as expected")
    return sn.pod_count_check(pods(t), checks)


@query("max_seen", f"""WITH {_PODS}, n AS (SELECT snapshot, test_id, count(*) AS c FROM pods WHERE role = 'executor' GROUP BY ALL),
m AS (SELECT test_id, max(c) AS max_seen, coalesce(max(c) FILTER (snapshot = 3), 0) AS current FROM n GROUP BY test_id)
SELECT *, max_seen >= 45 AS passed, CASE WHEN max_seen >= 45 THEN '' ELSE 'Executor count max never reached 45 (max seen: ' || max_seen || ', current: ' || current || ')' END AS message FROM m""")
def max_seen(t):
    return sn.max_seen(pods(t), "executor", F.lit(45), latest=3)


@query("all_pass_min", f"""WITH {_PODS}, first AS (SELECT *, segment IS NOT NULL AND segment <> 'furniture' AS ok FROM pods
  WHERE role = 'driver' QUALIFY row_number() OVER (PARTITION BY test_id, pod ORDER BY snapshot) = 1),
n AS (SELECT test_id, count(*) FILTER (ok) AS n_valid, count(*) FILTER (NOT ok) AS n_failed, string_agg(pod, ', ' ORDER BY pod) FILTER (NOT ok) AS names FROM first GROUP BY test_id)
SELECT test_id, n_valid, n_failed, n_failed = 0 AND n_valid >= 3 AS passed, CASE WHEN n_failed > 0 THEN n_failed || ' driver pod(s) failed ''segment'': ' || names WHEN n_valid < 3
  THEN 'Only seen ' || n_valid || ' valid driver pod(s) so far, need at least 3' ELSE '' END AS message FROM n""")
def all_pass_min(t):
    ok = sn.label("segment").isNotNull() & (sn.label("segment") != "furniture")
    return sn.all_pass_min(pods(t), "driver", ok, "segment", 3)


@query("failure_messages", f"""WITH {_PODS}, bad AS (SELECT snapshot, test_id, pod_no, 'Pod ' || pod || ' missing node selectors: ' ||
    concat_ws(', ', CASE WHEN disk <> 'ssd' THEN 'disk=ssd' END, CASE WHEN zone IS NULL OR zone <> 'zone-1' THEN 'zone=zone-1' END) AS message
  FROM pods WHERE disk <> 'ssd' OR zone IS NULL OR zone <> 'zone-1')
SELECT * FROM bad""")
def failure_messages(t):
    return sn.entry_failures(pods(t), F.expr("map('zone', 'zone-1', 'disk', 'ssd')"))


@query("failure_messages_joined", f"""WITH {_PODS}, bad AS (SELECT snapshot, test_id, pod_no, 'Pod ' || pod || ' missing or incorrect annotations: ' ||
    concat_ws(', ', CASE WHEN disk <> 'ssd' THEN 'disk=ssd' END, CASE WHEN zone IS NULL OR zone <> 'zone-1' THEN 'zone=zone-1' END) AS message
  FROM pods WHERE disk <> 'ssd' OR zone IS NULL OR zone <> 'zone-1'),
placed AS (SELECT *, (row_number() OVER (PARTITION BY snapshot, test_id ORDER BY pod_no) - 1) // 20 AS chunk FROM bad)
SELECT snapshot, test_id, chunk, count(*) AS n_messages, string_agg(message, '; ' ORDER BY pod_no) AS messages FROM placed GROUP BY ALL""")
def failure_messages_joined(t):
    annotated = pods(t).withColumnRenamed("node_selector", "annotations")
    bad = sn.entry_failures(annotated, F.expr("map('zone', 'zone-1', 'disk', 'ssd')"), "annotations")
    return sn.join_messages(bad, ["snapshot", "test_id"], "pod_no", size=20)


@query("no_pods_found", f"""WITH {_PODS}
SELECT s AS snapshot, 'test-' || n_nationkey AS test_id, role, 'No pods found with selector: spark-role=' || role || ',test-id=test-' || n_nationkey AS message
FROM nation, (VALUES (1), (2), (3), (4)) AS v(s), (VALUES ('driver'), ('executor')) AS r(role)
WHERE NOT EXISTS (SELECT 1 FROM pods p WHERE p.snapshot = s AND p.test_id = 'test-' || n_nationkey AND p.role = r.role)""")
def no_pods_found(t):
    checks = t["nation"].selectExpr("n_nationkey", "explode(array(1, 2, 3, 4)) as snapshot").selectExpr(
        "snapshot", "concat('test-', n_nationkey) as test_id", "explode(array('driver', 'executor')) as role")
    return sn.no_pods(checks, pods(t))


_POLLS = """polls AS (SELECT o_custkey AS check_id, o_orderkey AS poll, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus = 'F' AND o_orderkey % 9 = 0 END AS passed,
  concat('Expected ', o_orderkey % 5, ' pods') AS message, o_orderpriority = '1-URGENT' AS job_completed FROM orders WHERE o_orderstatus IN ('P', 'F', 'O'))"""


@query("check_results", f"""WITH {_POLLS}, a AS (SELECT check_id, coalesce(bool_or(passed), false) AS passed, arg_max(message, poll) FILTER (passed IS NOT NULL) AS last,
  bool_or(job_completed) AS done FROM polls GROUP BY check_id)
SELECT check_id, passed, CASE WHEN passed THEN '' WHEN last IS NULL THEN 'Timed out waiting for assertion'
  WHEN done THEN last || ' (job completed before assertion could pass)' ELSE last END AS message FROM a""")
def check_results(t):
    polls = t["orders"].selectExpr("o_custkey as check_id", "o_orderkey as poll", "if(o_orderstatus = 'P', null, o_orderstatus = 'F' and o_orderkey % 9 = 0) as passed",
                                   "concat('Expected ', o_orderkey % 5, ' pods') as message", "o_orderpriority = '1-URGENT' as job_completed")
    return sn.check_results(polls)


# ---- documents --------------------------------------------------------------------------------

BASE_DOC = """concat('{"metadata":{"name":"app-', c_custkey, '","labels":{"segment":"', c_mktsegment, '","app.io/tier":',
  if(c_custkey % 3 = 0, 'null', concat('"t', c_custkey % 3, '"')), '}},"spec":{"priority":', c_custkey % 10,
  ',"args":["a","b"],"containers":[{"name":"main","image":"base"},{"name":"log","image":"l"},{"image":"plain"}],"nodeSelector":{"zone":"z', c_custkey % 4,
  '"},"volumes":[{"name":"v1"}],"status":{"deep":{"er":1}}}}')"""
OVER_DOC = """concat('{"metadata":{"labels":{"app.io/tier":"over","extra":null}},"spec":{"priority":', if(c_custkey % 2 = 0, 'null', cast(c_custkey % 7 as string)),
  ',"args":["x"],"containers":[{"name":"main","image":"over-', c_custkey, '"},{"image":"anon"}],"nodeSelector":', if(c_custkey % 5 = 0, '"none"', '{"disk":"ssd"}'),
  ',"status":', if(c_custkey % 7 = 0, '[1]', 'null'), if(c_custkey % 11 = 0, ',"volumes":"none"', ''), '}}')"""

_DOC_NODES = """nodes AS (
  SELECT c_custkey AS doc_id, unnest([
    {'p': '', 'k': 'object', 'v': NULL}, {'p': 'metadata', 'k': 'object', 'v': NULL}, {'p': 'metadata/labels', 'k': 'object', 'v': NULL}, {'p': 'spec', 'k': 'object', 'v': NULL},
    {'p': 'metadata/name', 'k': 'scalar', 'v': '"app-' || c_custkey || '"'}, {'p': 'metadata/labels/segment', 'k': 'scalar', 'v': '"' || c_mktsegment || '"'},
    {'p': 'metadata/labels/app.io/tier', 'k': 'scalar', 'v': '"over"'}, {'p': 'metadata/labels/extra', 'k': 'null', 'v': NULL},
    {'p': 'spec/priority', 'k': 'scalar', 'v': CAST(CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 10 ELSE c_custkey % 7 END AS VARCHAR)},
    {'p': 'spec/args', 'k': 'array', 'v': '["x"]'}, {'p': 'spec/containers', 'k': 'array', 'v': NULL},
    {'p': 'spec/nodeSelector', 'k': CASE WHEN c_custkey % 5 = 0 THEN 'scalar' ELSE 'object' END, 'v': CASE WHEN c_custkey % 5 = 0 THEN '"none"' END},
    {'p': 'spec/volumes', 'k': CASE WHEN c_custkey % 11 = 0 THEN 'scalar' ELSE 'array' END, 'v': CASE WHEN c_custkey % 11 = 0 THEN '"none"' END},
    {'p': 'spec/status', 'k': CASE WHEN c_custkey % 7 = 0 THEN 'array' ELSE 'object' END, 'v': CASE WHEN c_custkey % 7 = 0 THEN '[1]' END}
  ], recursive := true) FROM customer
  UNION ALL SELECT c_custkey, unnest([{'p': 'spec/nodeSelector/zone', 'k': 'scalar', 'v': '"z' || c_custkey % 4 || '"'}, {'p': 'spec/nodeSelector/disk', 'k': 'scalar', 'v': '"ssd"'}], recursive := true)
    FROM customer WHERE c_custkey % 5 <> 0
  UNION ALL SELECT c_custkey, unnest([{'p': 'spec/status/deep', 'k': 'object', 'v': NULL}, {'p': 'spec/status/deep/er', 'k': 'scalar', 'v': '1'}], recursive := true)
    FROM customer WHERE c_custkey % 7 <> 0),
items AS (SELECT c_custkey AS doc_id, unnest([
    {'p': 'spec/containers', 'layer': 0, 'pos': 1, 'place': 0, 'v': '{"image":"l","name":"log"}'}, {'p': 'spec/containers', 'layer': 0, 'pos': 2, 'place': 1, 'v': '{"image":"plain"}'},
    {'p': 'spec/containers', 'layer': 1, 'pos': 0, 'place': 2, 'v': '{"image":"over-' || c_custkey || '","name":"main"}'}, {'p': 'spec/containers', 'layer': 1, 'pos': 1, 'place': 3, 'v': '{"image":"anon"}'}
  ], recursive := true) FROM customer
  UNION ALL SELECT c_custkey, 'spec/volumes', 0, 0, 0, '{"name":"v1"}' FROM customer WHERE c_custkey % 11 <> 0)"""


def _doc_rows(nodes):
    return nodes.select("doc_id", F.array_join("path", "/").alias("path"), "kind", F.coalesce("value", F.lit("")).alias("value"))


@query("deep_merge", f"""WITH {_DOC_NODES}
SELECT doc_id, p AS path, k AS kind, coalesce(v, '') AS value, CAST(-1 AS BIGINT) AS pos, -1 AS item_layer FROM nodes
UNION ALL SELECT doc_id, p, 'item', v, CAST(pos AS BIGINT), layer FROM items""")
def deep_merge(t):
    item = F.col("kind") == "item"
    return _merged_nodes(t).select("doc_id", F.array_join("path", "/").alias("path"), "kind", F.coalesce("value", F.lit("")).alias("value"),
                                   F.coalesce("pos", F.lit(-1)).alias("pos"), F.when(item, F.col("layer")).otherwise(-1).alias("item_layer"))


def _merged_nodes(t):
    c = t["customer"]

    def nodes(doc: str):
        return va.flatten(c.select(F.col("c_custkey").alias("doc_id"), F.expr(doc).alias("doc")))

    return docs.merge_nodes(nodes(BASE_DOC), nodes(OVER_DOC))


@query("deep_merge_documents", f"""WITH {_DOC_NODES}
SELECT doc_id, p AS path, k AS kind, coalesce(v, '') AS value, CAST(-1 AS BIGINT) AS pos FROM nodes
UNION ALL SELECT doc_id, p, 'item', v, CAST(place AS BIGINT) FROM items""")
def deep_merge_documents(t):
    return docs.merged_nodes(t["customer"], F.expr(BASE_DOC), F.expr(OVER_DOC), "c_custkey").select(
        "doc_id", F.array_join("path", "/").alias("path"), "kind", F.coalesce("value", F.lit("")).alias("value"), F.coalesce("pos", F.lit(-1)).alias("pos"))


@query("deep_merge_rebuilt", f"""WITH {_DOC_NODES}
SELECT doc_id, p AS path, k AS kind, coalesce(v, '') AS value, CAST(-1 AS BIGINT) AS pos FROM nodes
UNION ALL SELECT doc_id, p, 'item', v, CAST(place AS BIGINT) FROM items""")
def deep_merge_rebuilt(t):
    """The merged documents as texts, taken apart again."""
    texts = va.rebuild(_merged_nodes(t))
    return va.flatten(texts).select(
        "doc_id", F.array_join("path", "/").alias("path"), "kind", F.coalesce("value", F.lit("")).alias("value"), F.coalesce("pos", F.lit(-1)).alias("pos"))

