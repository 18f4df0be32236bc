"""Deep merge of nested documents.

Two forms. `merge_nodes` works on documents flattened to one row per node and is joins only, so one
huge document spreads over many tasks. `merge_documents` merges pairs of JSON texts of any depth
batch by batch. Rules: a null override keeps the base; objects merge; arrays are replaced, except
the named arrays, where base items whose name is overridden go and the override's items follow; any
other clash takes the override.

Node rows: (doc_id, path ARRAY<STRING>, kind, name, pos, value). `kind` is object, array, scalar or
null; the items of a named array are rows of kind `item` under the path of the array.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from runlens.session import written

# The arrays merged by name.
NAMED_ARRAYS = ["spec.volumes", "spec.containers", "spec.initContainers"]

NODE_SCHEMA = "doc_id {id_type}, path array<string>, kind string, name string, pos long, value string"


def spread(df: DataFrame) -> DataFrame:
    """Spread few partitions over all cores before work in Python; a large table stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# made once: json.dumps builds an encoder for every call with settings of its own
compact = json.JSONEncoder(separators=(",", ":"), sort_keys=True, ensure_ascii=False).encode


def item_name(item) -> str | None:
    """Name of an array item; nested values have no text of their own."""
    if not isinstance(item, dict) or "name" not in item:
        return None
    name = item["name"]
    if isinstance(name, str):
        return name
    return "" if isinstance(name, (dict, list)) else json.dumps(name)


def merge_values(base, over, path: str = ""):
    """Merge two parsed JSON values."""
    if over is None:
        return base
    if isinstance(base, dict) and isinstance(over, dict):
        deeper = {k: merge_values(base.get(k), v, f"{path}.{k}" if path else k) for k, v in over.items()}
        return {**base, **deeper}
    if isinstance(base, list) and isinstance(over, list) and path in NAMED_ARRAYS:
        taken = {item_name(i) for i in over} - {None}
        return [i for i in base if item_name(i) not in taken] + over
    return over


def merge_documents(base: Column, over: Column) -> Column:
    """Merged JSON text of two JSON texts; a missing text is a null document."""
    @F.pandas_udf(T.StringType())
    def merged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        def parse(text):
            return None if pd.isna(text) else json.loads(text)

        for left, right in batches:
            yield pd.Series([compact(merge_values(parse(b), parse(o))) for b, o in zip(left, right)])

    return merged(base, over)


def _nodes(value, path: list[str]):
    if isinstance(value, dict):
        yield path, "object", None, None, None
        for key, child in value.items():
            yield from _nodes(child, [*path, key])
    elif isinstance(value, list) and ".".join(path) in NAMED_ARRAYS:
        yield path, "array", None, None, None
        for pos, item in enumerate(value):
            yield path, "item", item_name(item), pos, compact(item)
    elif isinstance(value, list):
        yield path, "array", None, None, compact(value)
    else:
        yield path, "null" if value is None else "scalar", None, None, None if value is None else compact(value)


def _node_batch(ids: pa.Array, values: Iterable) -> pa.RecordBatch:
    """Node rows of a batch of parsed documents."""
    places, columns = [], ([], [], [], [], [])
    for position, value in enumerate(values):
        for node in _nodes(value, []):
            places.append(position)
            for column, field in zip(columns, node):
                column.append(field)
    texts = [pa.array(columns[i], pa.string()) for i in (1, 2, 4)]
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(places, pa.int32())), pa.array(columns[0], pa.list_(pa.string())),
         texts[0], texts[1], pa.array(columns[3], pa.int64()), texts[2]],
        ["doc_id", "path", "kind", "name", "pos", "value"])


def flatten_documents(docs: DataFrame, text: str = "doc", doc_id: str = "doc_id") -> DataFrame:
    """Node rows of JSON texts of any depth."""
    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _node_batch(batch.column(0), (json.loads(d) for d in batch.column(1).to_pylist()))

    filled = docs.filter(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("doc"))
    id_type = filled.schema["doc_id"].dataType.simpleString()
    return spread(filled).mapInArrow(nodes, NODE_SCHEMA.format(id_type=id_type))


def merged_nodes(docs: DataFrame, base: Column, over: Column, doc_id: str = "doc_id") -> DataFrame:
    """Node rows of what `merge_documents` makes of two JSON texts, in one pass: the merged text is not written and parsed again."""
    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parse(text):
            return None if text is None else json.loads(text)

        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            yield _node_batch(batch.column(0), (merge_values(parse(b), parse(o)) for b, o in pairs))

    # dealt before the texts are made
    both = spread(docs).select(F.col(doc_id).alias("doc_id"), base.alias("base"), over.alias("over"))
    return both.mapInArrow(nodes, NODE_SCHEMA.format(id_type=both.schema["doc_id"].dataType.simpleString()))


def sorted_side(df: DataFrame) -> DataFrame:
    """For the right side of a join over nodes: sorted, never a hash table of the driver or of a task.

    The planner goes by the size of files and the usual widths of columns. Files of nodes are far smaller than their rows, so large
    tables look like a few MB to it, and the driver would get them whole.
    """
    return df.hint("merge")


def merge_nodes(base: DataFrame, over: DataFrame) -> DataFrame:
    """Node rows of the merged documents, with `layer` 0 for rows of the base and 1 for the override.

    An item keeps its position within its layer; the items of layer 0 come first. Both inputs are
    read twice, so pass written tables (see `write_nodes`).
    """
    keys = ["doc_id", "path"]
    columns = [*keys, "kind", "name", "pos", "value", "layer"]
    tagged = base.withColumn("layer", F.lit(0)).unionByName(over.withColumn("layer", F.lit(1)))
    items = tagged.filter("kind = 'item'").select(*columns)

    side = F.struct("kind", "value")
    both = tagged.filter("kind <> 'item'").groupBy(*keys).agg(
        F.max(F.when(F.col("layer") == 0, side)).alias("b"), F.max(F.when(F.col("layer") == 1, side)).alias("o"))
    overridden = F.coalesce(F.col("o.kind") != "null", F.lit(False))
    from_base = F.col("b").isNotNull() & ~overridden
    chosen = F.when(from_base, F.col("b")).otherwise(F.col("o"))
    # where another kind replaces an object of the base, all nodes of the base below it go
    replaces = overridden & (F.col("b.kind") == "object") & (F.col("o.kind") != "object")
    nodes = written(both.select(
        *keys, chosen["kind"].alias("kind"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("pos"),
        chosen["value"].alias("value"), F.when(from_base, 0).otherwise(1).alias("layer"),
        F.coalesce(replaces, F.lit(False)).alias("replaces")), "merged-nodes")

    replaced = nodes.filter("replaces").select("doc_id", F.col("path").alias("above"))
    ancestors = F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice("path", F.lit(1), n - 1))
    below = (nodes.filter("layer = 0 and size(path) > 0").select(*keys, F.explode(ancestors).alias("above"))
             .join(sorted_side(replaced), ["doc_id", "above"], "left_semi").select(*keys).distinct())
    kept = nodes.filter("layer = 0").join(sorted_side(below), keys, "left_anti").unionByName(nodes.filter("layer = 1")).select(*columns)

    # items of the base stay where an array stayed, unless the override has an item of that name
    arrays = kept.filter("kind = 'array'").select(*keys)
    taken = items.filter("layer = 1 and name is not null").select(*keys, "name").distinct()
    base_items = (items.filter("layer = 0").join(sorted_side(arrays), keys, "left_semi")
                  .join(sorted_side(taken), [*keys, "name"], "left_anti").select(*columns))
    return kept.unionByName(base_items).unionByName(items.filter("layer = 1"))


def write_nodes(docs: DataFrame, text: str = "doc", doc_id: str = "doc_id") -> DataFrame:
    """Flatten once into a table in the shared folder and read it back."""
    return written(flatten_documents(docs, text, doc_id), "nodes")
