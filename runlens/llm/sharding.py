"""Shards along a Hilbert curve through the metadata, cut into runs of nearly equal size.

Every dimension of a document is quantised to a few bits: text columns by the share of rows with smaller values (at most 2**`BITS` split values
reach the driver), sizes by their logarithm, ids linearly. The position of that point on the curve orders the documents; the order is cut into
consecutive runs. Documents of one shard are near in every dimension, so the least and greatest value that a file keeps of each column
let a reader skip most files, whichever column it filters by.

Law `bytes`: sizes are nearly equal. Copies of a text share the least position of all its copies and are moved as one unit; only a group
with more than `TOLERANCE` of a shard is cut between its rows. A unit goes where its middle lies, so a shard differs from the mean by at
most that share, or by one document if that is larger.

Texts are read once, for size and checksums; all that is sorted are narrow rows. Positions come from sums per range partition, one row
each, which are broadcast; no window spans the table. Copies of a hot text are found by a broadcast of at most 1 000 keys.

Nulls and ties: a null text is empty, a null dimension comes first; equal positions are ordered by text hash, then id, then place in the input; repeated
rows are rows of their own; an empty table gives no shards.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.packing import hilbert
from runlens.operators.scans import running_totals, sorted_positions
from runlens.operators.skew import lookup_join
from runlens.session import written

SHARDS, BITS, TOLERANCE = 16, 8, 0.05
HOT_SHARE = 1_000
LEVELS = 1 << BITS


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Narrow rows: `_id`, `_n` (place in the input), size, text_crc32, `_h` (hash of the text) and the dimensions `_d0`, `_d1`, ..."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return written(docs.select(
        F.col(f"`{id_col}`").alias("_id"), F.monotonically_increasing_id().alias("_n"), (F.octet_length(text) + 1).cast("long").alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"), F.xxhash64(text).alias("_h"),
        *[F.col(f"`{c}`").cast("string").alias(f"_d{i}") for i, c in enumerate(by)]), "measured")


def splits(rows: DataFrame, dimension: str, n_rows: int) -> tuple[list[str], list[int]]:
    """The least value of each level of a text dimension, and the level: the share of rows with smaller values, in `LEVELS` parts."""
    counts = rows.filter(F.col(dimension).isNotNull()).groupBy(dimension).agg(F.count("*").alias("_c"))
    placed = written(sorted_positions(counts, [F.col(dimension)], "_p"), "values")
    level = F.expr(f"(_upto - _c) * {LEVELS} div {max(n_rows, 1)}")
    levels = running_totals(placed, [], "_p", {"_upto": F.col("_c")}).groupBy(level.alias("_level")).agg(F.min(dimension).alias("_least"))
    found = sorted((r["_least"], r["_level"]) for r in levels.collect())
    return [f[0] for f in found], [f[1] for f in found]


def _linear(values: np.ndarray, low: float, high: float) -> np.ndarray:
    return np.clip((values - low) / max(high - low, 1e-9) * (LEVELS - 1), 0, LEVELS - 1).astype(np.int64)


def on_curve(rows: DataFrame, n_rows: int, ids: tuple[float, float] | None, sizes: tuple[int, int], n_text: int) -> DataFrame:
    """Add `_pos`, the position on the curve. `ids` and `sizes` are the least and greatest values; without `ids` that dimension is left out."""
    texts = [splits(rows, f"_d{i}", n_rows) for i in range(n_text)]
    kinds = dict(rows.dtypes)
    names = ["_id", "_n", "_size", "_crc", "_h"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            points = [_linear(np.log2(batch.column("_size").to_numpy(zero_copy_only=False).astype(float)), *np.log2(sizes))]
            if ids:
                number = batch.column("_id").cast(pa.float64(), safe=False).fill_null(ids[0])
                points.append(_linear(number.to_numpy(zero_copy_only=False), *ids))
            for i, (least, level) in enumerate(texts):
                coded = batch.column(f"_d{i}").dictionary_encode()
                codes = [level[at - 1] if (at := bisect_right(least, v)) else 0 for v in coded.dictionary.to_pylist()] + [0]
                points.append(np.array(codes)[coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)])
            keys = hilbert(np.stack(points, axis=1), BITS) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(keys, pa.int64())], names=[*names, "_pos"])

    return rows.mapInArrow(batches, ", ".join(f"{n} {kinds[n]}" for n in names) + ", _pos long")


def in_units(rows: DataFrame, n_rows: int, most: float) -> DataFrame:
    """Copies share the least key of their group and, if the group has at most `most` bytes, are one unit (`_unit` -1, `_bytes` of the group)."""
    groups = rows.groupBy("_h").agg(F.min("_pos").alias("_least"), F.sum("_size").alias("_all"), F.count("*").alias("_copies"))
    found = lookup_join(rows, groups.filter("_copies > 1"), "_h", ["_least", "_all"], "_copies", hot_rows=max(n_rows // HOT_SHARE, 1))
    whole = F.coalesce(F.col("_all") <= most, F.lit(False))
    return found.select("_id", "_n", "_size", "_crc", "_h", F.coalesce("_least", "_pos").alias("_pos"),
                        F.when(whole, F.lit(-1)).otherwise(F.col("_n")).alias("_unit"),
                        F.when(whole, F.col("_all")).otherwise(F.col("_size")).alias("_bytes"))


def along_curve(rows: DataFrame) -> DataFrame:
    """Rows in the order of the curve, with `_part`, `_row` (in the part) and `_start` (bytes before the unit in the part), written once.

    A unit lies in one part, as its rows have equal sort keys up to the unit.
    """
    own = F.when(F.col("_unit") >= 0, F.col("_id"))
    ordered = (rows.withColumn("_own", own).repartitionByRange("_pos", "_h", "_own", "_unit")
               .sortWithinPartitions("_pos", "_h", "_own", "_unit", "_id", "_n").drop("_own"))
    kinds, names = dict(ordered.dtypes), ordered.columns

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, total, start, last = TaskContext.get().partitionId(), 0, 0, 0, None
        for batch in source:
            if not batch.num_rows:
                continue
            size = batch.column("_size").to_numpy()
            before = total + np.cumsum(size) - size
            unit = np.stack([batch.column(c).to_numpy() for c in ("_pos", "_h", "_unit")])
            fresh = np.empty(len(size), bool)
            fresh[0] = last is None or bool((unit[:, 0] != last).any())
            fresh[1:] = (unit[:, 1:] != unit[:, :-1]).any(axis=0)
            starts = np.maximum.accumulate(np.where(fresh, before, start))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(size), part), pa.int32()), pa.array(n + np.arange(len(size)), pa.int64()), pa.array(starts, pa.int64())],
                names=[*names, "_part", "_row", "_start"])
            n, total, start, last = n + len(size), int(before[-1] + size[-1]), int(starts[-1]), unit[:, -1]

    return written(ordered.mapInArrow(batches, ", ".join(f"{c} {kinds[c]}" for c in names) + ", _part int, _row long, _start long"), "along-curve")


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("source", "lang"),
           n_shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot (place in the shard), grown_shard (null), curve (position), text_hash."""
    rows = measured(docs, id_col, text_col, by)
    numeric = dict(rows.dtypes)["_id"] in ("tinyint", "smallint", "int", "bigint", "float", "double")
    edge = F.col("_id").cast("double") if numeric else F.lit(None).cast("double")
    n_rows, total, small, large, low, high = rows.agg(
        F.count("*"), F.sum("_size"), F.min("_size"), F.max("_size"), F.min(edge), F.max(edge)).first()
    total = total or 0
    keyed = on_curve(rows, n_rows, None if low is None else (low, high), (small or 1, large or 1), len(by))
    placed = along_curve(in_units(written(keyed, "on-curve"), n_rows, tolerance * total / n_shards))
    # one row per partition
    sums = placed.groupBy("_part").agg(F.sum("_size").alias("_s"), F.count("*").alias("_c"))
    w = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_s").over(w), F.lit(0)).alias("_bytes_before"), F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_rows_before"))
    middle = F.expr(f"(2 * (_start + _bytes_before) + _bytes) * {n_shards} div {max(2 * total, 1)}")
    cut = placed.join(F.broadcast(offsets), "_part").select(
        "_id", "_size", "_crc", "_pos", "_h", F.least(middle, F.lit(n_shards - 1)).cast("int").alias("shard"), (F.col("_row") + F.col("_rows_before")).alias("_place"))
    # one row per shard
    first = cut.groupBy("shard").agg(F.min("_place").alias("_first"))
    return cut.join(F.broadcast(first), "shard").select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("_place") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("_pos").alias("curve"), F.col("_h").alias("text_hash"))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("source", "lang"),
                 n_shards: int = SHARDS, files_per_shard: int = 1) -> DataFrame:
    """Write the documents with all their columns to `path/shard=n`, in the order of the curve; gives the manifest: rows, bytes and the range of every dimension per shard.

    Rows that agree in id and text, if cut apart, go to the least of their shards. If the documents have a column `shard`, the folders are called `shard_`.
    """
    folder, taken = "shard", {c.lower() for c in docs.columns}
    while folder in taken:
        folder += "_"
    placed = shards(docs, id_col, text_col, by, n_shards)
    where = placed.groupBy(F.col(id_col).alias("_id"), F.col("text_hash").alias("_h")).agg(F.min(F.struct("shard", "slot")).alias("_at"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(f"`{id_col}`").alias("_i"), F.xxhash64(text).alias("_t"), F.octet_length(text).alias("_size"))
    found = keyed.join(where, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_h"))).select("_doc", "_size", F.col("_at.shard").alias("_shard"), F.col("_at.slot").alias("_slot"))
    laid = found.repartitionByRange(n_shards * files_per_shard, "_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    out = written(laid.select(F.col("_shard").alias("shard"), "_doc", "_size"), "shards-to-write")
    out.select(F.col("shard").alias(folder), "_doc.*").write.mode("overwrite").partitionBy(folder).parquet(path)
    ranges = [f(F.col(f"_doc.`{c}`")).alias(f"{n}_{c}") for c in (id_col, *by) for f, n in ((F.min, "min"), (F.max, "max"))]
    return out.groupBy("shard").agg(F.count("*").alias("rows"), F.sum(F.col("_size") + 1).alias("bytes"), F.min("_size").alias("min_bytes"), F.max("_size").alias("max_bytes"), *ranges)
