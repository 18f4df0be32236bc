"""Configuration files of a folder, and output lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from runlens.functions.text import ERROR_LINE, full_match

# Fixed value: file names that are taken.
CONF_FILE_NAME = "([\\w][-\\w.]*)?[\\w]"


def conf_dir_scan(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Files directly in a folder as (app, key, content) with key `prefix/name`; app is the folder."""
    meta = F.col("_metadata")
    return (
        spark.read.text(path, wholetext=True)
        .select(F.regexp_extract(meta["file_path"], "([^/]+)/[^/]+$", 1).alias("app"),
                meta["file_name"].alias("name"), F.col("value").alias("content"))
        .filter(full_match(F.col("name"), CONF_FILE_NAME))
        .select("app", F.concat(F.lit(prefix + "/"), "name").alias("key"), "content")
    )


def error_line_extract(lines: DataFrame, limit: int = 10) -> DataFrame:
    """First matching lines of each run of (run_id, line_no, line).

    The rank filter becomes a limit per group before the shuffle, so a long run is cut at the source.
    """
    place = F.row_number().over(Window.partitionBy("run_id").orderBy("line_no"))
    return lines.filter(F.col("line").rlike(ERROR_LINE)).withColumn("place", place).filter(F.col("place") <= limit)
