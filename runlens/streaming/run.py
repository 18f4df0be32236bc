"""Running a stream up to the data that is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from runlens.session import scratch_path


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process all available data into parquet files, then stop. Run again to go on from there."""
    query = (stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
             .option("path", path).trigger(availableNow=True).start())
    query.awaitTermination()


def drain_to_table(stream: DataFrame, mode: str = "append") -> DataFrame:
    spark = stream.sparkSession
    path = scratch_path(spark, "stream-out")
    drain(stream, path, scratch_path(spark, "stream-checkpoint"), mode)
    return spark.read.schema(stream.schema).parquet(path)


def drain_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every micro-batch to `handle`, which must give the same result when a batch is repeated."""
    query = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
