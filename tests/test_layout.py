"""Facts laid out by month: what is read, how files are cut, what a repeated load does."""

from conftest import rows
from test_plans import plan

from pyspark.sql import functions as F
from runlens.session import scratch_path
from runlens.sources.layout import MONTH, lay_out, open_layout


def facts(spark, n=4000):
    """A third of all rows on one day, some without a day, the others over two years."""
    day = F.expr("CASE WHEN id % 3 = 0 THEN DATE '2001-07-04' WHEN id % 50 = 1 THEN NULL ELSE date_add(DATE '2000-01-01', CAST(id % 730 AS INT)) END")
    return spark.range(n).select("id", day.cast("timestamp_ntz").alias("day"), (F.col("id") % 7).alias("v"))


def test_rows_of_months_and_spans(spark):
    df = facts(spark)
    laid = lay_out(df, scratch_path(spark, "layout"), "day", ["id"])
    assert rows(laid.during("year = 2001 AND month IN (2, 7)")) == rows(df.filter("year(day) = 2001 AND month(day) IN (2, 7)"))
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("2000-03-05", "2000-06-01"))
    assert rows(laid.between(lo, hi)) == rows(df.filter((F.col("day") >= lo) & (F.col("day") < hi)))
    assert rows(laid.facts.drop(MONTH)) == rows(df)
    assert laid.calendar.count() == 24


def test_folders_are_pruned(spark):
    path = scratch_path(spark, "layout")
    lay_out(facts(spark), path, "day", ["id"])
    laid = open_layout(spark, path, "day")
    during = laid.during("month = 11")
    assert "dynamicpruningexpression(in_month" in plan(during)
    assert "PartitionFilters: [isnotnull(in_month" in plan(laid.between(F.lit("2000-03-05").cast("timestamp_ntz"), F.lit("2000-06-01").cast("timestamp_ntz")))
    # only November is read
    during.collect()
    scans = during._jdf.queryExecution().executedPlan().toString()
    assert "SubqueryBroadcast" in scans or "ReusedSubquery" in scans


def test_a_hot_day_lies_in_several_sorted_files(spark):
    df = spark.range(0, 40000, 1, 8).select("id", F.lit("2001-07-04").cast("timestamp_ntz").alias("day"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:  # tiny partitions would be joined
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        laid = lay_out(df, scratch_path(spark, "layout"), "day", ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    spans = laid.facts.groupBy(F.input_file_name().alias("f")).agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).orderBy("lo").collect()
    assert len(spans) == 8 and max(s["n"] for s in spans) < 10000
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))


def test_a_repeated_load_replaces_its_months_only(spark):
    path, df = scratch_path(spark, "layout"), facts(spark)
    lay_out(df, path, "day", ["id"])
    again = df.filter("year(day) = 2000").withColumn("v", F.col("v") + 100)
    want = rows(df.filter("day IS NULL OR year(day) <> 2000").unionByName(again))
    for _ in range(2):
        assert rows(lay_out(again, path, "day", ["id"]).facts.drop(MONTH)) == want
    later = spark.sql("SELECT 1L AS id, TIMESTAMP_NTZ'2003-02-01 05:00:00' AS day, 1L AS v")
    laid = lay_out(later, path, "day", ["id"])
    assert laid.calendar.count() == 38 and laid.during("year = 2003").count() == 1 and laid.during("year = 2002").count() == 0


def test_without_facts_or_days(spark):
    empty = lay_out(facts(spark, 0), scratch_path(spark, "layout"), "day", ["id"])
    assert empty.during("year = 2000").count() == 0 and empty.calendar.count() == 0
    no_day = lay_out(facts(spark).filter("day IS NULL"), scratch_path(spark, "layout"), "day", ["id"])
    assert no_day.facts.count() > 0 and no_day.during("month > 0").count() == 0
