"""Comparison of benchmark runs."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from runlens.operators.scans import sorted_positions
from runlens.sources.results import write_result_lines

# The text the runner writes when its own check failed, and the points per chart.
HASH_SENTINEL = "HASH MISMATCH"
CHUNK_SIZE = 35


def last_wins(lines: DataFrame, keys: list[str], order: str) -> DataFrame:
    """A key repeated in one run keeps its last line. Combines map-side, so a hot key is cheap."""
    return lines.groupBy(*keys).agg(
        F.max_by(F.struct("seconds", "result_hash"), order).alias("r")).select(*keys, "r.*")


def _side(df: DataFrame, n: int) -> DataFrame:
    return df.select("query", F.col("seconds").alias(f"seconds_{n}"), F.col("result_hash").alias(f"hash_{n}"))


def common(first: DataFrame, second: DataFrame) -> DataFrame:
    """Queries in both runs with both timings and hashes."""
    return _side(first, 1).join(_side(second, 2), "query")


def uncommon(first: DataFrame, second: DataFrame) -> DataFrame:
    """Queries in one run only: (query, run)."""
    def only(a: DataFrame, b: DataFrame, n: int) -> DataFrame:
        return a.join(b, "query", "left_anti").select("query", F.lit(n).alias("run"))

    return only(first, second, 1).unionByName(only(second, first, 2))


def hash_mismatch(first: DataFrame, second: DataFrame) -> DataFrame:
    """Common queries with different hashes; two equal sentinels count as equal."""
    return common(first, second).filter(F.col("hash_1") != F.col("hash_2")).select("query", "hash_1", "hash_2")


def hash_verdict(first: DataFrame, second: DataFrame) -> DataFrame:
    """(query, equal, sentinel): the verdict on the hash, and whether a run's own check had failed."""
    sentinel = (F.col("hash_1") == HASH_SENTINEL) | (F.col("hash_2") == HASH_SENTINEL)
    return common(first, second).select(
        "query", (F.col("hash_1") == F.col("hash_2")).alias("equal"), sentinel.alias("sentinel"))


def common_keys(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.select("query").intersect(second.select("query"))


def keys_only(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.select("query").subtract(second.select("query"))


def natural_key(text: Column) -> Column:
    """Sort key that orders digit runs as numbers, of any length: q1, q2, q10, q14a, q14b, ss_max."""
    pieces = F.regexp_extract_all(text, F.lit("(\\d+|\\D+)"), F.lit(1))

    def key(piece: Column) -> Column:
        # of two numbers without leading zeros the longer one is larger
        digits = F.regexp_replace(piece, "\\A0+(?=[0-9])", "")
        number = piece.rlike("\\A[0-9]+\\z")
        return F.struct(F.when(number, F.length(digits)).otherwise(-1).alias("length"),
                        F.when(number, digits).otherwise("").alias("number"), piece.alias("text"))

    return F.transform(pieces, key)


def natural_sort(df: DataFrame, column: str = "query") -> DataFrame:
    return df.orderBy(natural_key(F.col(column)))


def natural_positions(df: DataFrame, column: str = "query") -> DataFrame:
    """Add the 1-based `position` in natural order; values of `column` are unique."""
    return sorted_positions(df, [natural_key(F.col(column)), F.col(column)])


def chunked(df: DataFrame, size: int = CHUNK_SIZE) -> DataFrame:
    """Cut ordered keys into chunks: (.., position, chunk, place)."""
    at = F.col("position") - 1
    return df.withColumn("chunk", F.floor(at / F.lit(size)) + 1).withColumn("place", at % size + 1)


def chart_series(first: DataFrame, second: DataFrame, size: int = CHUNK_SIZE) -> DataFrame:
    """Long rows (chunk, place, query, run, seconds) for charts of the common queries."""
    both = common(first, second)
    placed = chunked(natural_positions(both.select("query", "seconds_1", "seconds_2")), size)
    series = F.explode(F.array(
        F.struct(F.lit(1).alias("run"), F.col("seconds_1").alias("seconds")),
        F.struct(F.lit(2).alias("run"), F.col("seconds_2").alias("seconds"))))
    return placed.select("chunk", "place", "query", series.alias("s")).select("chunk", "place", "query", "s.*")


def run_summary(first: DataFrame, second: DataFrame) -> DataFrame:
    """Totals of both runs over their common queries."""
    both = common(first, second)
    return both.agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.round(F.sum("seconds_1"), 2).alias("total_1"),
        F.round(F.sum("seconds_2"), 2).alias("total_2"),
        F.count_if(F.col("seconds_1") < F.col("seconds_2")).alias("faster_1"),
        F.count_if(F.col("seconds_1") > F.col("seconds_2")).alias("slower_1"),
        F.count_if(F.col("seconds_1") == F.col("seconds_2")).alias("equal"),
        F.count_if(F.col("hash_1") != F.col("hash_2")).alias("mismatches"),
    )


def canonical_text(column: Column, kind: T.DataType) -> Column:
    """A value as text that other engines can make too: numbers with a fraction have six digits of it."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.coalesce(column.try_cast("decimal(38,6)").cast("string"), column.cast("string"))
    if isinstance(kind, T.DecimalType):
        return column.cast("decimal(38,6)").cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, T.MapType):  # entries in the order of their keys
        return F.to_json(F.array_sort(F.map_entries(column)))
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.to_json(column)
    return column.cast("string")


def result_hash(df: DataFrame) -> DataFrame:
    """Order-insensitive hash of a query result: (n_rows, result_hash).

    A row is the text of its columns in the order of their names, each between marks of its own; a null has another mark than any
    value. The first 60 bits of the rows' MD5 are added up, so repeated rows count.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = [F.coalesce(F.concat(F.lit("="), canonical_text(F.col(f"`{c}`"), kinds[c])), F.lit("!")) for c in sorted(kinds)]
    row = F.conv(F.substring(F.md5(F.concat_ws("\x1f", *texts)), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.select(row.alias("row")).agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("row"), F.lit(0)).alias("total")).select(
        "n_rows", F.upper(F.md5(F.concat_ws(":", F.col("n_rows"), F.col("total").cast("decimal(38,0)")))).substr(1, 12).alias("result_hash"))


RUNS = 3


def run_suite(spark: SparkSession, named: dict[str, Callable[[], DataFrame]], path: str, runs: int = RUNS) -> DataFrame:
    """Run queries one after another, `runs` times each, and append a result line with all times for each to `path`.

    Returns (at, query, n_rows, seconds, result_hash); seconds are those of the best run. Runs with different hashes are marked.
    """
    rows = []
    for at, (name, build) in enumerate(named.items()):
        times, found = [], []
        for _ in range(runs):
            start = time.perf_counter()
            found.append(result_hash(build()).first())
            times.append(round(time.perf_counter() - start, 3))
        same = len({r["result_hash"] for r in found}) == 1
        rows.append((at, name, found[0]["n_rows"], min(times), times, found[0]["result_hash"] if same else HASH_SENTINEL))
    lines = spark.createDataFrame(rows, "at int, query string, n_rows long, seconds double, times array<double>, result_hash string")
    write_result_lines(lines, path, "at")
    return lines.drop("times")
