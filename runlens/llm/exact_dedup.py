"""Exact duplicates by digest, with frequent digests split off.

Texts are equal when they are identical after lower-casing A-Z; their SHA-256 stands for them. A Misra-Gries pass
(`freqItems`) names the few digests that may cover a large share of all rows, an exact count verifies them, and the
verified ones (at most 1 / `support`, a bound that does not depend on the input) are broadcast: their rows are decided
where they lie. Only the other digests, each of them rare, are shuffled.

Nulls and repeats: a null text counts as empty; a null id is smaller than any other; of rows that repeat both id and
text exactly one is kept. Empty tables give empty results, and other columns of the input are never looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import ascii_lower, id_text, packed, unpacked
from runlens.session import written

SUPPORT = 1 / 256


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`_id`, `_digest` and `_n`, a number that tells repeated rows apart once it is written."""
    return id_text(docs, id_col, text_col).select(
        "_id", F.sha2(ascii_lower(F.col("_text")), 256).alias("_digest"), F.monotonically_increasing_id().alias("_n"))


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_digest").agg(F.max(F.struct("_id", "_n")).alias("_top"), F.count("*").alias("_size"))


def heavy_winners(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Digests with more than `support` of all rows: the winning row and the exact count. At most 1 / `support` rows."""
    names = rows.freqItems(["_digest"], support).select(F.explode("_digest_freqItems").alias("_digest"))
    counted = _groups(rows.join(F.broadcast(names.distinct()), "_digest"))
    return counted.filter(F.col("_size") > rows.agg(F.count("*") * F.lit(support)).scalar())


def duplicate_groups(rows: DataFrame, support: float = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """(heavy, rare): winning row `_top` and `_size` of every digest. `rows` must be a written table of `digests`."""
    heavy = written(heavy_winners(rows, support), "heavy-digests")
    rare = _groups(rows.join(F.broadcast(heavy.select("_digest")), "_digest", "left_anti"))
    return heavy, rare


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per input row: id, keep_id (id of the row that stays), group_size, kept, text_sha256."""
    rows = written(digests(docs, id_col, text_col), "digests")
    heavy, rare = duplicate_groups(rows, support)
    light = rows.join(F.broadcast(heavy.select("_digest")), "_digest", "left_anti").join(rare, "_digest")
    both = rows.join(F.broadcast(heavy), "_digest").unionByName(light)
    return both.select(
        F.col("_id").alias(id_col), F.col("_top._id").alias("keep_id"), F.col("_size").alias("group_size"),
        (F.col("_top._n") == F.col("_n")).alias("kept"), F.col("_digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows that stay, with all their columns. Rows of heavy digests are dropped where they lie."""
    rows = written(digests(docs, id_col, text_col), "digests")
    heavy = written(heavy_winners(rows, support), "heavy-digests")
    # counted by digest and id first, so that no task meets a group; the winning id occurs more than once only where rows repeat
    counted = rows.groupBy("_digest", "_id").agg(F.count("*").alias("_t")).groupBy("_digest").agg(
        F.max(F.struct("_id", "_t")).alias("_top"), F.sum("_t").alias("_size"))
    groups = written(counted.filter("_size > 1").select("_digest", F.col("_top._id").alias("_keep"), F.col("_top._t").alias("_tops")), "digest-groups")
    hot = groups.join(F.broadcast(heavy.select("_digest")), "_digest", "left_semi")
    cool = groups.join(F.broadcast(heavy.select("_digest")), "_digest", "left_anti")
    keyed = packed(docs, id_col, text_col).withColumn("_digest", F.sha2(ascii_lower(F.col("_text")), 256)).drop("_text")
    for part, hint in ((hot, F.broadcast), (cool, lambda df: df)):
        found = hint(part.withColumnRenamed("_tops", "_t"))
        keyed = (keyed.join(found, "_digest", "left")
                 .filter(F.col("_t").isNull() | F.col("_id").eqNullSafe(F.col("_keep"))).drop("_keep", "_t"))
    repeated = groups.filter("_tops > 1").select("_digest")
    if repeated.isEmpty():
        return unpacked(keyed)
    once = keyed.join(repeated, "_digest", "left_anti")
    first = keyed.join(repeated, "_digest", "left_semi").groupBy("_digest").agg(F.first("_row").alias("_row"))
    return unpacked(once.select("_row").unionByName(first.select("_row")))
