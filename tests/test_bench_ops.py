from pathlib import Path

import pytest
from pyspark.sql import functions as F

from runlens.operators import bench
from runlens.plans.workload import amount, money
from runlens.session import scratch_path
from runlens.sources.results import read_result_lines, write_result_lines

RUN_1 = """q1-v2.4,83,83,83,30D1

q10-v2.4,92,92,92,2F6C
q2-v2.4,10,10,10,AA
q14a-v2.4,5,5,5,X1
q14b-v2.4,5,5,5,X2
   \t
ss_max-v2.4,50,50,50,B3
q51-v2.4,1,1,1,HASH MISMATCH
q2-v2.4,66,66,66,BB
nodash,7,7,7,ND
"""
RUN_2 = "q1-v2.4,50,50,50,30D1\nq10-v2.4,107,107,107,DIFF\nq2-v2.4,62,62,62,BB\nq51-v2.4,1,1,1,HASH MISMATCH\nq99-a-b,1,1,1,Z\n"


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("results")
    for name, text in (("one", RUN_1), ("two", RUN_2)):
        (root / name).mkdir()
        Path(root / name / "results1").write_text(text)
    lines = read_result_lines(spark, str(root / "*"))
    best = bench.last_wins(lines, ["source", "query"], "line_order")
    return best.filter("source = 'one'").drop("source"), best.filter("source = 'two'").drop("source")


def keys(df):
    return sorted(r["query"] for r in df.collect())


def test_lines_are_parsed_and_last_wins(runs):
    first = {r["query"]: (r["seconds"], r["result_hash"]) for r in runs[0].collect()}
    assert first["q2"] == (66.0, "BB") and first["nodash"] == (7.0, "ND") and len(first) == 8
    assert "q99" in keys(runs[1])


def test_common_uncommon_mismatch(runs):
    assert keys(bench.common(*runs)) == ["q1", "q10", "q2", "q51"]
    assert {(r["query"], r["run"]) for r in bench.uncommon(*runs).collect()} == {
        ("q14a", 1), ("q14b", 1), ("ss_max", 1), ("nodash", 1), ("q99", 2)}
    assert keys(bench.hash_mismatch(*runs)) == ["q10"]
    verdicts = {r["query"]: (r["equal"], r["sentinel"]) for r in bench.hash_verdict(*runs).collect()}
    assert verdicts["q51"] == (True, True) and verdicts["q1"] == (True, False) and verdicts["q10"] == (False, False)


def test_natural_order(runs):
    names = [r["query"] for r in bench.natural_sort(runs[0].select("query")).collect()]
    assert names == ["nodash", "q1", "q2", "q10", "q14a", "q14b", "q51", "ss_max"]
    placed = {r["query"]: r["position"] for r in bench.natural_positions(runs[0].select("query")).collect()}
    assert [n for n, _ in sorted(placed.items(), key=lambda x: x[1])] == names


def test_chunks_of_35(spark):
    df = spark.range(104).selectExpr("concat('q', id) as query")
    sizes = {r["chunk"]: r["count"] for r in bench.chunked(bench.natural_positions(df)).groupBy("chunk").count().collect()}
    assert sizes == {1: 35, 2: 35, 3: 34}


def test_line_order_survives_split_files(spark, tmp_path):
    path = tmp_path / "run"
    path.mkdir()
    (path / "results1").write_text("".join(f"q{n % 10}-v1,{n},{n},{n},h{n}\n" for n in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        lines = read_result_lines(spark, str(path))
        assert lines.rdd.getNumPartitions() > 4
        best = bench.last_wins(lines, ["query"], "line_order")
        assert {r["query"]: r["seconds"] for r in best.collect()} == {f"q{n}": 4990.0 + n for n in range(10)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_result_hash_ignores_order_and_sees_values(spark):
    a = spark.range(100).selectExpr("id", "id * 2 as v")
    value = bench.result_hash(a).first()
    assert bench.result_hash(a.repartition(7).orderBy(F.desc("id"))).first() == value
    assert bench.result_hash(a.withColumn("v", F.col("v") + F.when(F.col("id") == 5, 1).otherwise(0))).first() != value
    assert bench.result_hash(a.union(a)).first() != value
    assert bench.result_hash(a.limit(0)).first()["n_rows"] == 0


def test_suite_appends_result_lines(spark):
    path = scratch_path(spark, "suite")
    named = {"q1-x": lambda: spark.range(3).toDF("id"), "q2-x": lambda: spark.range(4).toDF("id")}
    bench.run_suite(spark, named, path)
    bench.run_suite(spark, named, path)
    lines = read_result_lines(spark, path).collect()
    assert len(lines) == 4 and {r["query"] for r in lines} == {"q1", "q2"}
    assert len({r["result_hash"] for r in lines if r["query"] == "q1"}) == 1


def test_written_lines_read_back(spark):
    df = spark.createDataFrame([(1, "q1-a", 1.5, "H"), (2, "q1-a", 2.5, "I")], "at int, query string, seconds double, result_hash string")
    path = scratch_path(spark, "lines")
    write_result_lines(df, path, "at")
    best = bench.last_wins(read_result_lines(spark, path), ["query"], "line_order").first()
    assert (best["query"], best["seconds"], best["result_hash"]) == ("q1", 2.5, "I")


def test_result_hash_sees_where_a_null_stands(spark):
    a = spark.sql("select 1 as a, cast(null as int) as b")
    b = spark.sql("select cast(null as int) as a, 1 as b")
    assert bench.result_hash(a).first() != bench.result_hash(b).first()
    texts = spark.sql("select '' as a, cast(null as string) as b")
    assert bench.result_hash(texts).first() != bench.result_hash(texts.select(F.col("b").alias("a"), F.col("a").alias("b"))).first()
    maps = [spark.sql(f"select map({e}) as m, array(1.5D) as l, 1e300D as d, cast('NaN' as double) as n") for e in ("'a', 1, 'b', 2", "'b', 2, 'a', 1", "'a', 2, 'b', 1")]
    hashes = [bench.result_hash(m).first()["result_hash"] for m in maps]
    assert hashes[0] == hashes[1] != hashes[2]


def test_natural_order_of_long_numbers(spark):
    names = ["q5", "q" + "9" * 38, "q1" + "0" * 39, "q010", "q2"]
    got = [r["query"] for r in bench.natural_sort(spark.createDataFrame([(n,) for n in names], "query string")).collect()]
    assert got == ["q2", "q5", "q010", "q" + "9" * 38, "q1" + "0" * 39]


def test_suite_measures_as_often_as_it_writes(spark):
    path, calls = scratch_path(spark, "suite"), []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    lines = bench.run_suite(spark, {"q1": build}, path).collect()
    assert len(calls) == 3 and lines[0]["result_hash"] == bench.HASH_SENTINEL


def test_a_lookup_is_sent_by_rows_and_bytes(spark):
    from runlens.operators.lookup import distribute_lookup

    requests = spark.range(50).select((F.col("id") % 10).alias("line_no"))
    lookup = spark.range(10).select(F.col("id").alias("line_no"), F.repeat(F.lit("x"), 1000).alias("line"))
    plan = lambda **bounds: distribute_lookup(requests, lookup, **bounds)._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan() and "broadcast" not in plan(max_rows=9) and "broadcast" not in plan(max_bytes=10_000)
    assert distribute_lookup(requests, lookup, max_bytes=10).count() == distribute_lookup(requests, lookup).count() == 50


def test_totals_do_not_depend_on_the_order_of_the_rows(spark):
    """Sums of doubles lose cents among large amounts, and others at each order, so that hashes of one result differ."""
    rows = spark.createDataFrame([(10.0 ** 15,)] + [(0.03,)] * 1000 + [(-(10.0 ** 15),)], "l_extendedprice double").coalesce(1)
    price = F.col("l_extendedprice")
    assert rows.agg(money(price)).first()[0] == 30.0
    partial = rows.groupBy((price < 1).alias("k")).agg(amount(price).alias("total"))
    assert partial.agg(money(F.col("total"))).first()[0] == 30.0
