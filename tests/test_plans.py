"""Plans: nothing pairs everything with everything, filters and columns reach the scan."""

import pytest
from conftest import SF

import __spark_entry__ as entry
from runlens.plans import QUERIES

LAZY = sorted(n for n in QUERIES if not n.startswith(("stream_", "carried_", "event_source", "bench_suite", "conf_dir")))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_product(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_product_without_broadcast(spark, name):
    """The plan a large table gets: no side is small enough to be sent."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(entry.queries()[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_date_filter_reaches_the_scan(spark):
    text = plan(entry.queries()["w15_before_after"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in text


def test_only_used_columns_are_read(spark):
    text = plan(entry.queries()["parquet_scan"](spark, SF))
    assert "ReadSchema: struct<l_returnflag:string>" in text


def test_top_ranks_are_cut_before_the_shuffle(spark):
    for name in ("w18_rollup_top_ranks", "w22_ranked_ratios_union", "error_line_extract"):
        assert "WindowGroupLimit" in plan(entry.queries()[name](spark, SF))


def test_small_state_aggregates_by_hash(spark):
    assert "SortAggregate" not in plan(entry.queries()["state_counts"](spark, SF))
    assert "SortAggregate" not in plan(entry.queries()["loss_summary"](spark, SF))


def test_tasks_of_adjusted_join_follow_the_table(spark, monkeypatch):
    """Twice the table, twice the tasks: what one task holds does not grow."""
    import re

    from runlens.plans import workload
    from runlens.sources.tables import Tables

    def dealt(task_bytes):
        monkeypatch.setattr(workload, "TASK_BYTES", task_bytes)
        plan = workload.w27(Tables(spark, "/root/testdata/sf0.01"))._jdf.queryExecution().optimizedPlan().toString()
        return int(re.search(r"RepartitionByExpression \[l_orderkey#\d+L\], (\d+)", plan).group(1))

    assert dealt(1 << 40) == spark.sparkContext.defaultParallelism
    assert dealt(10_000) == pytest.approx(2 * dealt(20_000), abs=1) and dealt(10_000) > 50
