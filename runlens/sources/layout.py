"""Facts laid out by month: one folder a month, sorted files inside, and a calendar that prunes them.

A query names its months by a condition on the calendar (`year`, `month`, `quarter`, `first_day`); Spark reads only the folders
of those months (dynamic partition pruning, or plain partition filters for a span of days). Inside a file the rows are sorted,
so row groups are skipped by their minima and maxima too.

The facts are dealt by range over month, day and the sort columns: a month with a third of all rows is cut among many tasks
as long as those columns tell its rows apart, and a task writes few months. Writing facts again replaces exactly the months they
have, so a repeated load changes nothing. Facts without a day go to a folder of their own, which no calendar month matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

MONTH = "in_month"


@dataclass(frozen=True)
class Layout:
    facts: DataFrame
    calendar: DataFrame
    day: str

    def during(self, months: str | Column) -> DataFrame:
        """Facts of the calendar months for which the condition holds."""
        # at most twelve rows a year: a calendar is small whatever the facts are
        chosen = F.broadcast(self.calendar.filter(months).select(MONTH))
        return self.facts.join(chosen, MONTH, "left_semi").drop(MONTH)

    def between(self, first: Column, end: Column) -> DataFrame:
        """Facts with first <= day < end."""
        at, month = F.col(self.day), F.col(MONTH)
        span = (month >= F.trunc(first, "month")) & (month <= F.trunc(end, "month"))
        return self.facts.filter(span & (at >= first) & (at < end)).drop(MONTH)


def lay_out(facts: DataFrame, path: str, day: str, sort: list[str]) -> Layout:
    """Write `facts` below `path`, replacing the months they have, and bring the calendar up to date."""
    keys = [MONTH, day, *sort]
    dealt = facts.withColumn(MONTH, F.trunc(F.col(day), "month")).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt.write.partitionBy(MONTH).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/facts")
    spark, schema = facts.sparkSession, T.StructType([*facts.schema.fields, T.StructField(MONTH, T.DateType())])
    span = spark.read.schema(schema).parquet(f"{path}/facts").agg(F.min(MONTH).alias("lo"), F.max(MONTH).alias("hi"))
    months = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias(MONTH))
    months.select(MONTH, F.year(MONTH).alias("year"), F.quarter(MONTH).alias("quarter"), F.month(MONTH).alias("month"),
                  F.col(MONTH).alias("first_day")).coalesce(1).write.mode("overwrite").parquet(f"{path}/calendar")
    return open_layout(spark, path, day, schema)


def open_layout(spark: SparkSession, path: str, day: str, schema: T.StructType | None = None) -> Layout:
    """A layout written before. Without a `schema` (with the column `in_month`) it is read from the files, of which there must be one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return Layout(reader.parquet(f"{path}/facts"), spark.read.parquet(f"{path}/calendar"), day)
