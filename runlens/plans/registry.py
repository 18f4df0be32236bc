"""Named queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from runlens.session import tune
from runlens.sources.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(tune(spark), sf_dir))

    run.__name__ = name
    return run
