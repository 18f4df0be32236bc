"""Headerless benchmark result files: `query,seconds,seconds,seconds,hash` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

WHITESPACE = " \t\n\r\f\v"


def read_result_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per non-blank line: (source, query, seconds, result_hash, line_order).

    `source` is the folder of the file. `line_order` sorts by file name, then by place in the file,
    also when a file is split over several tasks.
    """
    line = F.btrim("value", F.lit(WHITESPACE))
    cols = F.split(line, ",")
    meta = F.col("_metadata")
    # block start is the offset of the split; ids grow line by line inside a split
    order = F.struct(meta["file_name"].alias("file"), meta["file_block_start"].alias("start"),
                     F.monotonically_increasing_id().alias("line"))
    return (
        spark.read.text(path)
        .select("value", order.alias("line_order"),
                F.regexp_extract(meta["file_path"], "([^/]+)/[^/]+$", 1).alias("source"))
        .filter(line != "")
        .select(
            "source",
            F.substring_index(F.get(cols, F.lit(0)), "-", 1).alias("query"),
            F.get(cols, F.lit(1)).cast("double").alias("seconds"),
            F.element_at(cols, -1).alias("result_hash"),
            "line_order",
        )
    )


def write_result_lines(rows: DataFrame, path: str, order: str, by: str | None = None) -> None:
    """Append rows (query, times or seconds, result_hash) as result lines, in `order` over the files.

    `times` holds the times of the runs; rows with `seconds` alone repeat it, as their file format has three.
    """
    if "times" in rows.columns:
        seconds = F.array_join(F.transform("times", lambda s: s.cast("string")), ",")
    else:
        seconds = F.array_join(F.array_repeat(F.col("seconds").cast("string"), 3), ",")
    line = F.concat_ws(",", "query", seconds, "result_hash")
    keep = [by] if by else []
    lines = (rows.select(order, *keep, line.alias("value"))
             .repartitionByRange(F.col(order)).sortWithinPartitions(*keep, order).drop(order))
    writer = lines.write.mode("append")
    (writer.partitionBy(by) if by else writer).text(path)
