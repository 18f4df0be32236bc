"""Documents as VARIANT: flattening to node rows and rebuilding JSON texts, level by level, with nothing but column expressions.

The node rows are those of `operators.documents`, so `merge_nodes` merges them: a deep merge without Python. Flattening opens several
levels in one pass and goes on from what it wrote as long as there are deeper objects.

Numbers are written as VARIANT writes them: 1.0 as 1, 1e3 as 1000, 1e-7 as 1.0E-7. Keys of an object must differ. A null text has no nodes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from runlens.operators.documents import NAMED_ARRAYS, sorted_side
from runlens.session import written

SMALL_BYTES, LEVELS = 16 << 20, 6
OBJECT, ARRAY = "map<string,variant>", "array<variant>"


def _text(v: Column) -> Column:
    """JSON text of a variant; keys are in order there already."""
    return F.when(F.is_variant_null(v), "null").otherwise(F.to_json(v))


def _item_name(v: Column) -> Column:
    """Name of an array item; nested values have no text of their own."""
    fields = F.try_variant_get(v, "$", OBJECT)
    name = fields["name"]
    text = _text(name)
    return F.when(F.map_contains_key(fields, "name"), F.when(text.startswith('"'), F.try_variant_get(name, "$", "string"))
                  .when(text.startswith("{") | text.startswith("["), "").otherwise(text))


def _dealt(docs: DataFrame) -> DataFrame:
    """A small table over all cores, as its files may be fewer; a large one stays as it lies. Its size is the planner's estimate, no job."""
    cores = docs.sparkSession.sparkContext.defaultParallelism
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return docs.repartition(cores) if size < cores * SMALL_BYTES else docs


def _opened(nodes: DataFrame) -> DataFrame:
    """One level more: an open object with members gives way to its members as open nodes, every other node is closed.

    `firsts` counts the objects above a node whose first leaf it is: they have no row here and get it from that one.
    """
    v, key = F.col("v"), F.col("key")
    held = nodes.withColumn("_object", F.when(F.col("open") & F.try_variant_get(v, "$", OBJECT).isNotNull(), v))
    members = nodes.sparkSession.tvf.variant_explode_outer(F.col("_object").outer())
    return held.lateralJoin(members).select(
        "doc_id", F.when(key.isNull(), F.col("path")).otherwise(F.concat("path", F.array(key))).alias("path"), F.coalesce("value", v).alias("v"), key.isNotNull().alias("open"),
        F.when(key.isNull(), F.col("firsts")).when(F.col("pos") == 0, F.col("firsts") + 1).otherwise(0).alias("firsts"))


def flatten(docs: DataFrame, text: str = "doc", doc_id: str = "doc_id", levels: int = LEVELS) -> DataFrame:
    """Node rows (doc_id, path, kind, name, pos, value) of JSON texts of any depth; `levels` of them in one pass, each pass written once."""
    v, kind, n, found = F.col("v"), F.col("kind"), F.col("n"), []
    nodes = _dealt(docs.filter(F.col(text).isNotNull())).select(
        F.col(doc_id).alias("doc_id"), F.array().cast("array<string>").alias("path"), F.parse_json(F.col(text)).alias("v"))
    while True:
        nodes = nodes.select("doc_id", "path", "v", F.lit(True).alias("open"), F.lit(0).alias("firsts"))
        for _ in range(levels):
            nodes = _opened(nodes)
        kinds = nodes.withColumn("kind", F.when(F.is_variant_null(v), "null").when(F.try_variant_get(v, "$", OBJECT).isNotNull(), "object").when(
            F.try_variant_get(v, "$", ARRAY).isNotNull(), "array").otherwise("scalar"))
        named = (kind == "array") & F.array_join("path", ".").isin(NAMED_ARRAYS)
        # at n = 0 a node itself, above that the objects it stands for, at -1 its items
        each = kinds.withColumn("named", named).withColumn("n", F.explode(F.sequence(F.when(F.col("named"), -1).otherwise(0), F.col("firsts"))))
        listed = each.select(
            "doc_id", F.when(n > 0, F.slice("path", F.lit(1), F.size("path") - n)).otherwise(F.col("path")).alias("path"),
            F.when(n > 0, "object").when(n < 0, "item").otherwise(kind).alias("kind"), (F.col("open") & (kind == "object") & (n == 0)).alias("open"),
            F.when(n == 0, F.when(~F.col("named"), v)).alias("v"), F.when(n < 0, v).alias("_items"))
        items = listed.sparkSession.tvf.variant_explode_outer(F.col("_items").outer())
        item = F.col("value")
        placed = written(listed.lateralJoin(items).filter((kind != "item") | F.col("pos").isNotNull()).select(
            "doc_id", "path", "kind", F.when(kind == "item", _item_name(item)).alias("name"), F.col("pos").cast("long").alias("pos"),
            F.when(kind == "item", _text(item)).when(kind.isin("scalar", "array"), F.to_json(v)).alias("value"), F.when(F.col("open"), v).alias("v"), "open"), "variant-nodes")
        found.append(placed.filter("not open").select("doc_id", "path", "kind", "name", "pos", "value"))
        nodes = placed.filter("open").select("doc_id", "path", "v")
        if nodes.isEmpty():
            return reduce(DataFrame.unionByName, found)


def rebuild(nodes: DataFrame) -> DataFrame:
    """(doc_id, doc): the JSON text of every document, with keys in order, from its node rows (merged ones with `layer`, or plain ones).

    Values are joined to the text of their parent from the deepest level up: one aggregate per level, several levels in one pass.
    """
    layer = F.col("layer") if "layer" in nodes.columns else F.lit(0)
    item = F.col("kind") == "item"
    # one aggregate brings a named array and its items together
    own = nodes.select("doc_id", "path", "kind", "pos", "value", layer.alias("layer")).groupBy("doc_id", "path").agg(
        F.max(F.when(~item, F.struct("kind", "value"))).alias("n"), F.array_sort(F.collect_list(F.when(item, F.struct("layer", "pos", "value")))).alias("items")).filter("n is not null")
    # a named array without items is empty
    listed = F.concat(F.lit("["), F.array_join(F.transform("items", lambda i: i["value"]), ","), F.lit("]"))
    own = own.select(
        "doc_id", "path", F.size("path").alias("depth"), F.col("n.kind").alias("kind"),
        F.when(F.col("n.kind") == "null", "null").when(F.col("n.kind") == "array", F.coalesce("n.value", listed)).otherwise(F.col("n.value")).alias("text"))
    own = written(own, "node-texts")
    depth = own.agg(F.max("depth")).first()[0]
    if depth is None:
        return own.select("doc_id", F.col("text").alias("doc"))
    below = None
    for d in range(depth, -1, -1):
        here = own.filter(F.col("depth") == d)
        if below is not None:
            here = here.join(sorted_side(below), ["doc_id", "path"], "left").withColumn("text", F.coalesce("text", "members")).drop("members")
        here = here.withColumn("text", F.when(F.col("kind") == "object", F.coalesce("text", F.lit("{}"))).otherwise(F.col("text")))
        if d and d % LEVELS == 0:  # a plan of few levels at a time
            here = written(here, "texts-of-level")
        if d == 0:
            return here.select("doc_id", F.col("text").alias("doc"))
        key = F.element_at("path", -1)
        # the key as JSON text, by the writer that knows how to escape it
        quoted = F.to_json(F.to_variant_object(F.array(key)))
        member = F.struct(key.alias("key"), F.concat(F.expr("substr(_quoted, 2, length(_quoted) - 2)"), F.lit(":"), F.col("text")).alias("member"))
        below = here.withColumn("_quoted", quoted).groupBy("doc_id", F.slice("path", 1, d - 1).alias("path") if d > 1 else F.array().cast("array<string>").alias("path")).agg(
            F.array_sort(F.collect_list(member)).alias("m")).select(
            "doc_id", "path", F.concat(F.lit("{"), F.array_join(F.transform("m", lambda x: x["member"]), ","), F.lit("}")).alias("members"))
