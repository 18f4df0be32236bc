"""Running totals, ranks and positions with no task that holds a whole group.

An ordered window over a group runs in one task. Here a group is cut into buckets of the order
column (an integer unique in the group, so a bucket of width w holds at most w rows): sums per
bucket, sums before each bucket, then a window inside the bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from runlens.session import written

WIDTH = 100_000


def _sums_before(totals: DataFrame, keys: list[str], cols: list[str], width: int) -> DataFrame:
    """Sum of `cols` over all earlier buckets, in two steps of at most `width` buckets per task."""
    totals = totals.withColumn("_group", F.floor(F.col("_bucket") / F.lit(width)))
    upper = totals.groupBy(*keys, "_group").agg(*[F.sum(c).alias(c) for c in cols])
    # the last level has n / width^2 rows, which is a handful for any real n
    upper_w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_group").rowsBetween(
        Window.unboundedPreceding, -1)
    upper = upper.select(*keys, "_group", *[
        F.coalesce(F.sum(c).over(upper_w), F.lit(0)).alias(f"_up_{c}") for c in cols])
    lower_w = Window.partitionBy(*keys, "_group").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    lower = totals.select(*keys, "_group", "_bucket", *[
        F.coalesce(F.sum(c).over(lower_w), F.lit(0)).alias(f"_low_{c}") for c in cols])
    return lower.join(upper, [*keys, "_group"]).select(
        *keys, "_bucket", *[(F.col(f"_low_{c}") + F.col(f"_up_{c}")).alias(f"_before_{c}") for c in cols])


def running_totals(df: DataFrame, keys: list[str], order: str, sums: dict[str, Column],
                   width: int = WIDTH) -> DataFrame:
    """Add running sums (current row included) of the `sums` expressions along `order` per `keys`.

    The rows are read twice; pass a written table when it takes work to make them.
    """
    cols = list(sums)
    rows = df.withColumn("_bucket", F.floor(F.col(order) / F.lit(width)))
    for name, expr in sums.items():
        rows = rows.withColumn(name, expr)
    totals = rows.groupBy(*keys, "_bucket").agg(*[F.sum(c).alias(c) for c in cols])
    offsets = _sums_before(totals, keys, cols, width)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    joined = rows.join(offsets, [*keys, "_bucket"])
    out = [c for c in df.columns]
    return joined.select(*out, *[(F.sum(c).over(inside) + F.col(f"_before_{c}")).alias(c) for c in cols])


def dense_rank_ids(df: DataFrame, keys: list[str], order: str, name: str, width: int = WIDTH) -> DataFrame:
    """1, 2, 3, ... along `order`, per `keys` or over the whole table."""
    return running_totals(df, keys, order, {name: F.lit(1).cast("long")}, width)


def sorted_positions(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """1-based position in a total order of any type, for rows that are unique in that order.

    The sorted rows are written to the shared folder first: the range boundaries come from a
    sample, so both passes must read one and the same layout.
    """
    placed = written(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", 33))
        .withColumn("_local", F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1),
        "sorted")
    # one row per partition
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_local") + F.col("_before")).cast("long").alias(name))
