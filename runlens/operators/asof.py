"""As-of join: every row gets the last row of another table that is not later than it, per key.

Both tables are sorted together by key and order in ranges of rows, so a key with any share of all rows is cut into many parts. Inside
a part a window carries the last value on; what a part begins with is the last value of the key's earlier parts, of which
there is one row per key and part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from runlens.session import written


def as_of(left: DataFrame, right: DataFrame, keys: list[str], order: str, payload: list[str], tie: str | None = None) -> DataFrame:
    """All rows of `left` with the `payload` of the last row of `right` with equal `keys` and an `order` not above their own.

    Of rows of `right` with equal order the one with the greatest `tie` counts. Rows without such a row, or with a null key
    or order, get nulls. Both tables call the keys and the order alike; `payload` must not name columns of `left`.
    """
    kept = right.dropna(subset=[*keys, order])
    nothing = F.lit(None)
    late = left.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(order).alias("_at"), F.lit(1).alias("_side"),
                       (F.col(tie) if tie and tie in right.columns and tie in left.columns else nothing).alias("_tie"),
                       F.struct(*left.columns).alias("_row"))
    early = kept.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(order).alias("_at"), F.lit(0).alias("_side"),
                        (F.col(tie) if tie else nothing).alias("_tie"), F.struct(*payload).alias("_found"))
    key = [f"_k{i}" for i in range(len(keys))]
    both = early.unionByName(late, allowMissingColumns=True)
    # the ranges come from a sample: they are fixed by writing, and every later step reads the same parts
    parts = written(both.repartitionByRange(*key, "_at", "_side", "_tie").withColumn("_part", F.spark_partition_id()), "as-of")
    # one row per key and part
    is_early = F.col("_side") == 0
    ends = parts.groupBy(*key, "_part").agg(F.max_by(F.when(is_early, F.col("_found")), F.when(is_early, F.struct("_at", "_tie"))).alias("_last"))
    earlier = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*[F.col(k).alias(f"_c{k}") for k in key], F.col("_part").alias("_cpart"), F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    inside = Window.partitionBy("_part", *key).orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = parts.withColumn("_inside", F.last("_found", ignorenulls=True).over(inside)).filter("_side = 1")
    same = F.col("_part") == F.col("_cpart")
    for k in key:
        same = same & (F.col(k) == F.col(f"_c{k}"))
    found = F.when(F.col("_at").isNotNull(), F.coalesce("_inside", "_carried"))
    return filled.join(carried, same, "left").select("_row.*", *[found[c].alias(c) for c in payload])
