"""Parquet tables by name (the star schema and the event table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def parquet_scan(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy access to the tables below one folder: `t["orders"]`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getitem__(self, name: str) -> DataFrame:
        return parquet_scan(self.spark, self.root, name)
