"""Connected components by repeated grouping; no task sees a whole component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node in `links` (a, b): comp is the smallest node that can be reached.

    Large-star and small-star steps in turn: every node hands its smallest neighbour to its larger ones, then to its smaller ones,
    until every link leads straight to the smallest node. Each step is one aggregate and one join over the links.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        # large star: neighbours above u go to the smallest around u
        large = written(both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                        .filter("a <> b").distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        # small star: neighbours below u, and u, go to the smallest of them
        joined = large.join(low, F.col("a") == F.col("u")).select("a", "b", "m")
        edges = written(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
                        .filter("a <> b").distinct(), "small-star")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    return written(edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("comp"))).distinct(), "components")
