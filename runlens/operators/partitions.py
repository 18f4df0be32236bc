"""Functions over batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

COUNTS = "hits long, total long"


def map_batches(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
                schema: str) -> DataFrame:
    """Apply a generator function to the Arrow batches of each partition."""
    return df.mapInPandas(fn, schema)


def register_batches(spark: SparkSession, name: str, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> None:
    """Make a generator function a table function of SQL: `SELECT * FROM name(TABLE(SELECT ...))`, with `PARTITION BY` where groups matter.

    The function sees one Arrow batch at a time, of one partition or, with `PARTITION BY`, of one group. The schema is fixed: table functions over Arrow
    batches cannot work it out from their input.
    """
    class Batches:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            for out in fn(iter([batch.to_pandas()])):
                yield pa.Table.from_pandas(out, preserve_index=False)

    spark.udtf.register(name, F.arrow_udtf(Batches, returnType=schema))


def count_hits(seed: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """One random point per row; (hits inside the unit circle, rows) per batch."""
    def points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # the seed comes from the data, so a task that runs again gives the same counts
            rng = np.random.default_rng([seed, len(batch), int(batch.iloc[0, 0]) if len(batch) else 0])
            xy = rng.random((len(batch), 2))
            yield pd.DataFrame({"hits": [int(((xy ** 2).sum(axis=1) < 1).sum())], "total": [len(batch)]})

    return points


def pi_from_counts(counts: DataFrame) -> DataFrame:
    """Sum partial (hits, total) and estimate pi."""
    return counts.agg(F.sum("hits").alias("hits"), F.sum("total").alias("total")).withColumn(
        "pi", F.lit(4.0) * F.col("hits") / F.col("total"))


def pi_estimate(df: DataFrame, id_column: str, seed: int = 0) -> DataFrame:
    return pi_from_counts(map_batches(df.select(F.col(id_column).cast("long")), count_hits(seed), COUNTS))


def lattice_hits(x: Column, y: Column, side: int) -> DataFrame | Column:
    """Whether the lattice point (x, y) of a `side` x `side` grid lies inside the quarter circle."""
    return x * x + y * y < side * side


def lattice_counts(side: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Batch form of `lattice_hits` over columns (x, y)."""
    def points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            inside = lattice_hits(batch["x"], batch["y"], side)
            yield pd.DataFrame({"hits": [int(inside.sum())], "total": [len(batch)]})

    return points
