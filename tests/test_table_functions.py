"""Batch functions as table functions of SQL."""

import pandas as pd

from runlens.operators import partitions as pt


def sizes():
    def per_batch(batches):
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"part": [batch["part"].iloc[0]], "n": [len(batch)], "parts": [batch["part"].nunique()]})

    return per_batch


def test_groups_by_partition_by(spark):
    pt.register_batches(spark, "per_batch", sizes(), "part long, n long, parts long")
    points = spark.range(1000).selectExpr("id % 7 as part", "id")
    got = spark.sql("SELECT part, sum(n) AS n, max(parts) AS parts FROM per_batch(TABLE(SELECT * FROM {points}) PARTITION BY part) GROUP BY part", points=points).collect()
    assert sorted((r["part"], r["n"], r["parts"]) for r in got) == [(p, 143 if p < 6 else 142, 1) for p in range(7)]


def test_whole_table_and_empty_table(spark):
    pt.register_batches(spark, "per_batch", sizes(), "part long, n long, parts long")
    for rows in (500, 0):
        points = spark.range(rows).selectExpr("id % 7 as part", "id")
        assert (spark.sql("SELECT sum(n) AS n FROM per_batch(TABLE(SELECT * FROM {points}))", points=points).first()["n"] or 0) == rows
