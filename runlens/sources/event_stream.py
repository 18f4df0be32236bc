"""Replayable event streams from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("message_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("job_set", T.StringType()),
    T.StructField("job_id", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("cause", T.StringType()),
    T.StructField("exit_codes", T.ArrayType(T.IntegerType())),
])
QUARANTINE = "malformed"


def event_source(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of JSON event lines; a malformed line does not stop the stream, it fills `malformed`.

    The resume point is the checkpoint of the query that reads the stream.
    """
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField(QUARANTINE, T.StringType())])
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", QUARANTINE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def good_events(stream: DataFrame) -> DataFrame:
    return stream.filter(F.col(QUARANTINE).isNull() & F.col("message_id").isNotNull()).drop(QUARANTINE)


def table_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the parquet files below a folder or path pattern."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
