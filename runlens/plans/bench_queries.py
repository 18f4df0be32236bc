"""Registered queries over benchmark results and example workloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.operators import bench, partitions
from runlens.operators.lookup import distribute_lookup
from runlens.plans.fixtures import BENCH_CTE, bench_lines
from runlens.plans.registry import ORACLES, QUERIES, query
from runlens.session import scratch_path
from runlens.sources.results import read_result_lines, write_result_lines


def _lines_on_disk(t):
    path = scratch_path(t.spark, "bench-lines")
    write_result_lines(bench_lines(t), path, "line_no", by="run")
    return read_result_lines(t.spark, path)


def _runs(t):
    lines = bench_lines(t).withColumn("query", F.substring_index("query", "-", 1))
    best = bench.last_wins(lines, ["run", "query"], "line_no")
    return best.filter("run = 1").drop("run"), best.filter("run = 2").drop("run")


@query("bench_read", f"""WITH {BENCH_CTE}
SELECT 'run=' || run AS source, split_part(query, '-', 1) AS query, seconds, result_hash FROM bench_lines""")
def bench_read(t):
    return _lines_on_disk(t).drop("line_order")


@query("bench_last_wins", f"WITH {BENCH_CTE} SELECT 'run=' || run AS source, query, seconds, result_hash FROM bench")
def bench_last_wins(t):
    return bench.last_wins(_lines_on_disk(t), ["source", "query"], "line_order")


@query("bench_common", f"WITH {BENCH_CTE} SELECT * FROM pairs")
def bench_common(t):
    return bench.common(*_runs(t))


@query("bench_uncommon", f"""WITH {BENCH_CTE}
SELECT query, min(run) AS run FROM bench GROUP BY query HAVING count(*) = 1""")
def bench_uncommon(t):
    return bench.uncommon(*_runs(t))


@query("bench_hash_mismatch", f"WITH {BENCH_CTE} SELECT query, hash_1, hash_2 FROM pairs WHERE hash_1 <> hash_2")
def bench_hash_mismatch(t):
    return bench.hash_mismatch(*_runs(t))


@query("bench_hash_verdict", f"""WITH {BENCH_CTE}
SELECT query, hash_1 = hash_2 AS equal, 'HASH MISMATCH' IN (hash_1, hash_2) AS sentinel FROM pairs""")
def bench_hash_verdict(t):
    return bench.hash_verdict(*_runs(t))


@query("bench_summary", f"""WITH {BENCH_CTE}
SELECT count(*) AS n_queries, round(sum(seconds_1), 2) AS total_1, round(sum(seconds_2), 2) AS total_2,
  count(*) FILTER (seconds_1 < seconds_2) AS faster_1, count(*) FILTER (seconds_1 > seconds_2) AS slower_1,
  count(*) FILTER (seconds_1 = seconds_2) AS equal, count(*) FILTER (hash_1 <> hash_2) AS mismatches FROM pairs""")
def bench_summary(t):
    return bench.run_summary(*_runs(t))


_NATURAL = """CAST(regexp_extract(query, '[0-9]+') AS INTEGER), query"""


@query("natural_sort", f"""WITH {BENCH_CTE}
SELECT query, row_number() OVER (ORDER BY {_NATURAL}) AS position FROM (SELECT DISTINCT query FROM bench)""")
def natural_sort(t):
    first, second = _runs(t)
    return bench.natural_positions(first.select("query").union(second.select("query")).distinct())


@query("chunk_by_n", f"""WITH {BENCH_CTE}
SELECT query, n AS position, (n - 1) // 35 + 1 AS chunk, (n - 1) % 35 + 1 AS place
FROM (SELECT query, row_number() OVER (ORDER BY {_NATURAL}) AS n FROM pairs)""")
def chunk_by_n(t):
    return bench.chunked(bench.natural_positions(bench.common(*_runs(t)).select("query")))


@query("chart_series_sink", f"""WITH {BENCH_CTE},
placed AS (SELECT *, row_number() OVER (ORDER BY {_NATURAL}) - 1 AS n FROM pairs)
SELECT n // 35 + 1 AS chunk, n % 35 + 1 AS place, query, 1 AS run, seconds_1 AS seconds FROM placed
UNION ALL SELECT n // 35 + 1, n % 35 + 1, query, 2, seconds_2 FROM placed""")
def chart_series_sink(t):
    path = scratch_path(t.spark, "chart-series")
    bench.chart_series(*_runs(t)).write.parquet(path)
    return t.spark.read.parquet(path)


@query("set_common", f"WITH {BENCH_CTE} SELECT query FROM pairs")
def set_common(t):
    return bench.common_keys(*_runs(t))


@query("set_only", f"""WITH {BENCH_CTE}
SELECT query FROM bench WHERE run = 1 EXCEPT SELECT query FROM bench WHERE run = 2""")
def set_only(t):
    return bench.keys_only(*_runs(t))


@query("parquet_scan", "SELECT l_returnflag, count(*) AS n_rows FROM lineitem GROUP BY l_returnflag")
def parquet_scan(t):
    return t["lineitem"].groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"))


@query("lookup_distribute", """SELECT c_custkey AS request_id, c_nationkey AS line_no, n_name AS line
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def lookup_distribute(t):
    requests = t["customer"].select(F.col("c_custkey").alias("request_id"), F.col("c_nationkey").alias("line_no"))
    lookup = t["nation"].select(F.col("n_nationkey").alias("line_no"), F.col("n_name").alias("line"))
    return distribute_lookup(requests, lookup).select("request_id", "line_no", "line")


_LINE_TEXT = " || chr(31) || ".join(f"coalesce('=' || {text}, '!')" for text in (
    "l_discount::DECIMAL(38,6)::VARCHAR", "l_extendedprice::DECIMAL(38,6)::VARCHAR", "l_linenumber::VARCHAR", "l_linestatus",
    "l_orderkey::VARCHAR", "l_partkey::VARCHAR", "l_quantity::DECIMAL(38,6)::VARCHAR", "l_returnflag",
    "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f')", "l_suppkey::VARCHAR", "l_tax::DECIMAL(38,6)::VARCHAR"))


@query("result_hash", f"""SELECT n_rows, upper(substr(md5(n_rows || ':' || total), 1, 12)) AS result_hash FROM (
  SELECT count(*) AS n_rows, coalesce(sum(('0x' || substr(md5({_LINE_TEXT}), 1, 15))::BIGINT), 0) AS total FROM lineitem)""")
def result_hash(t):
    return bench.result_hash(t["lineitem"])


def _suite() -> list[str]:
    return [name for name in QUERIES if name.startswith("w")]


# a value by its JSON type: numbers with a fraction have six digits of it, times have six digits of a second
_VALUE = """CASE json_type(j, p) WHEN 'NULL' THEN '!' WHEN 'DOUBLE' THEN '=' || json_extract_string(j, p)::DECIMAL(38,6)::VARCHAR
  ELSE '=' || regexp_replace(json_extract_string(j, p), '^(\\d{4}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d)$', '\\1.000000') END"""


def _hash_sql(name: str) -> str:
    """Count and hash of a query's rows, whatever its columns are."""
    return f"""SELECT '{name}' AS query, count(*) AS n_rows, upper(substr(md5(count(*) || ':' || coalesce(sum(part), 0)), 1, 12)) AS result_hash
FROM (SELECT ('0x' || substr(md5(array_to_string(list_transform(paths, lambda p: {_VALUE}), chr(31))), 1, 15))::BIGINT AS part
  FROM (SELECT to_json(r) AS j, list_transform(list_sort(json_keys(to_json(r))), lambda k: '$."' || k || '"') AS paths
    FROM ({ORACLES[name]}) r))"""


def suite_sql() -> str:
    return " UNION ALL ".join(_hash_sql(name) for name in _suite())


def suite_run(t, runs: int = 1):
    """The whole workload, run and written as result lines; the hashes are those read back from the lines."""
    path = scratch_path(t.spark, "bench-suite")
    done = bench.run_suite(t.spark, {name: (lambda q=name: QUERIES[q](t)) for name in _suite()}, path, runs)
    lines = read_result_lines(t.spark, path).select("query", "result_hash")
    return done.select("query", "n_rows").join(lines, "query").select("query", "n_rows", "result_hash")


SIDE = 1000


@query("pi_partition_agg", f"""SELECT CAST(sum(CASE WHEN x * x + y * y < {SIDE * SIDE} THEN 1 ELSE 0 END) AS BIGINT) AS hits,
  count(*) AS total, 4.0::DOUBLE * sum(CASE WHEN x * x + y * y < {SIDE * SIDE} THEN 1 ELSE 0 END) / count(*) AS pi
FROM (SELECT l_partkey * 7919 % {SIDE} AS x, (l_orderkey * 104729 + l_linenumber) % {SIDE} AS y FROM lineitem)""")
def pi_partition_agg(t):
    points = t["lineitem"].select(
        (F.col("l_partkey") * 7919 % SIDE).alias("x"),
        ((F.col("l_orderkey") * 104729 + F.col("l_linenumber")) % SIDE).alias("y"))
    inside = partitions.lattice_hits(F.col("x"), F.col("y"), SIDE)
    return partitions.pi_from_counts(points.select(inside.cast("long").alias("hits"), F.lit(1).alias("total")))


@query("map_in_pandas", f"""SELECT CAST(sum(CASE WHEN x * x + y * y < {SIDE * SIDE} THEN 1 ELSE 0 END) AS BIGINT) AS hits,
  count(*) AS total, 4.0::DOUBLE * sum(CASE WHEN x * x + y * y < {SIDE * SIDE} THEN 1 ELSE 0 END) / count(*) AS pi
FROM (SELECT o_custkey * 7919 % {SIDE} AS x, o_orderkey * 104729 % {SIDE} AS y FROM orders)""")
def map_in_pandas(t):
    points = t["orders"].select((F.col("o_custkey") * 7919 % SIDE).alias("x"),
                                (F.col("o_orderkey") * 104729 % SIDE).alias("y"))
    return partitions.pi_from_counts(
        partitions.map_batches(points, partitions.lattice_counts(SIDE), partitions.COUNTS))


@query("map_partitions", f"""SELECT CAST(sum(CASE WHEN x * x + y * y < {SIDE * SIDE} THEN 1 ELSE 0 END) AS BIGINT) AS hits,
  count(*) AS total, 4.0::DOUBLE * sum(CASE WHEN x * x + y * y < {SIDE * SIDE} THEN 1 ELSE 0 END) / count(*) AS pi
FROM (SELECT l_suppkey * 7907 % {SIDE} AS x, (l_orderkey * 104723 + l_linenumber * 31) % {SIDE} AS y FROM lineitem)""")
def map_partitions(t):
    points = t["lineitem"].select((F.col("l_suppkey") * 7907 % SIDE).alias("x"),
                                  ((F.col("l_orderkey") * 104723 + F.col("l_linenumber") * 31) % SIDE).alias("y"))
    return partitions.pi_from_counts(
        partitions.map_batches(points, partitions.lattice_counts(SIDE), partitions.COUNTS))


@query("map_partitions_sql", f"""SELECT CAST(sum(CASE WHEN x * x + y * y < {SIDE * SIDE} THEN 1 ELSE 0 END) AS BIGINT) AS hits,
  count(*) AS total, 4.0::DOUBLE * sum(CASE WHEN x * x + y * y < {SIDE * SIDE} THEN 1 ELSE 0 END) / count(*) AS pi
FROM (SELECT l_suppkey * 7907 % {SIDE} AS x, (l_orderkey * 104723 + l_linenumber * 31) % {SIDE} AS y FROM lineitem)""")
def map_partitions_sql(t):
    """The same function called from SQL."""
    partitions.register_batches(t.spark, "lattice_counts", partitions.lattice_counts(SIDE), partitions.COUNTS)
    counts = t.spark.sql(f"""SELECT * FROM lattice_counts(TABLE(SELECT l_suppkey * 7907 % {SIDE} AS x,
        (l_orderkey * 104723 + l_linenumber * 31) % {SIDE} AS y FROM {{lines}}))""", lines=t["lineitem"])
    return partitions.pi_from_counts(counts)
