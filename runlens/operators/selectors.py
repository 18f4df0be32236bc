"""Many selectors against many label maps: a containment join over an inverted index.

A selector matches a row whose labels hold all its entries. The index counts, for every entry, the rows that hold it; each selector looks
up the one entry of its own that the fewest rows hold, and only those rows are compared with the whole selector. No pair meets that does
not share that entry. Entries are kept as hashes: two that share a hash only add rows to compare, as the texts decide.

A selector needs no count of an entry to prefer it to the most common ones. Those are few and known to every task, so a selector with one other
entry has its choice at once; the rest ask for counts, and only of the entries that are left. Rows of common entries stay where they are if few selectors
look those up. Otherwise a common entry is cut into parts of at most `PART_ROWS` rows, and the selectors that look it up are sent to each of its parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runlens.operators.skew import HOT_ROWS, broadcast_if_small
from runlens.session import written

PART_ROWS = 100_000
# The entries named in the plan: this many of the most common ones and all that more than PART_ROWS rows hold.
COMMON_ENTRIES = 1000
# Selectors of common entries up to this many, in so many bytes of JSON, are sent to the rows.
SENT_ROWS, SENT_BYTES = 10_000, 8 << 20


def _entries(labels: Column, of_null: Column) -> Column:
    """Hashes of all entries; a null value, which matches nothing, gives `of_null`."""
    return F.transform(F.map_entries(labels), lambda e: F.when(e["value"].isNull(), of_null).otherwise(F.xxhash64(e["key"], e["value"])))


def _every() -> Column:
    """The entry that every row holds and an empty selector looks up."""
    return F.xxhash64(F.lit(""))


def _holds(labels: Column, selector: Column) -> Column:
    """The labels hold every entry of a selector without null values."""
    held = F.coalesce(F.map_entries(labels), F.map_entries(F.create_map().cast("map<string,string>")))
    return F.size(F.array_except(F.map_entries(selector), held)) == 0


def _common(counts: DataFrame, at_least: int, above: int) -> list[int]:
    """The `at_least` entries that most rows hold, and all that more than `above` rows hold."""
    top = counts.orderBy(F.desc("n_rows"), "entry").limit(at_least).collect()
    if len(top) == at_least and (not top or top[-1]["n_rows"] > above):
        top = counts.filter(F.col("n_rows") > above).collect()
    return [r["entry"] for r in top]


def select_many(rows: DataFrame, selectors: DataFrame, labels: str = "labels", part_rows: int = PART_ROWS, hot_rows: int = HOT_ROWS,
                common_entries: int = COMMON_ENTRIES, sent_rows: int = SENT_ROWS) -> DataFrame:
    """Every row of `rows` (all columns) with the `selector_id` of each selector (selector_id, selector) its labels satisfy.

    A null or empty selector is satisfied by every row, a selector with a null value by none. An entry of more than `part_rows` or `hot_rows` rows is common.
    """
    # `explode_outer`, as `explode` would work out the arrays a second time to filter out empty ones
    held = F.array_distinct(F.concat(F.array(_every()), F.coalesce(_entries(F.col(labels), _every()), F.array().cast("array<bigint>"))))
    counts = written(rows.select(F.explode_outer(held).alias("entry")).groupBy("entry").agg(F.count(F.lit(1)).alias("n_rows")), "entry-counts")
    common = _common(counts, common_entries, min(part_rows, hot_rows))
    is_common = f"({', '.join(f'{c}L' for c in common)})" if common else "(null)"

    def chosen(entries: Column, which: str) -> DataFrame:
        """The rows once per entry of theirs that is common, or that is not."""
        each = rows.withColumn("_held", entries).withColumn("_entry", F.expr(f"explode_outer(filter(_held, e -> {which}))"))
        return each.drop("_held").filter("_entry is not null")

    asked = selectors.select("selector_id", F.coalesce("selector", F.create_map().cast("map<string,string>")).alias("_selector"))
    asked = asked.withColumn("_all", F.when(F.size("_selector") == 0, F.array(_every())).otherwise(_entries(F.col("_selector"), F.lit(None))))
    asked = asked.withColumn("_rare", F.expr(f"filter(_all, e -> not coalesce(e in {is_common}, false))"))
    # among its entries that are not common, if it has any, is the one that the fewest rows hold; one with a null value has none to look up
    asked = asked.withColumn("_common", F.size("_rare") == 0).withColumn("_from", F.when(
        F.exists("_all", lambda e: e.isNull()), F.array().cast("array<bigint>")).when(F.col("_common"), F.col("_all")).otherwise(F.col("_rare")))
    kept = written(asked.select("selector_id", "_selector", F.monotonically_increasing_id().alias("_id"), "_common", "_from", F.size("_from").alias("_n")), "selectors")
    alone = kept.filter("_n = 1").select("selector_id", "_selector", "_common", F.col("_from")[0].alias("_probe"))
    several = kept.filter("_n > 1").select("_id", "_common", F.explode_outer("_from").alias("entry"))
    known = counts.filter(f"entry in {is_common}")
    counted = several.filter("_common").join(F.broadcast(known), "entry").unionByName(several.filter("not _common").join(counts, "entry", "left"))
    # an entry that no row holds ends the selector
    rarest = counted.withColumn("n_rows", F.coalesce("n_rows", F.lit(0))).groupBy("_id").agg(
        F.min_by("entry", "n_rows").alias("_probe"), F.min("n_rows").alias("_n_rows")).filter("_n_rows > 0")
    settled = written(kept.filter("_n > 1").join(rarest, "_id").select("selector_id", "_selector", "_common", "_probe"), "settled-selectors")
    probes = alone.unionByName(settled)

    def met(placed: DataFrame, sent: DataFrame, at: Column) -> DataFrame:
        return placed.join(sent, at & _holds(F.col(labels), F.col("_selector"))).select(*rows.columns, "selector_id")

    def sendable(asking: DataFrame) -> DataFrame | None:
        """The selectors to be sent to all rows, if they are few."""
        if asking.select("_probe").limit(sent_rows + 1).count() > sent_rows:
            return None
        sent = broadcast_if_small(asking, sent_rows, SENT_BYTES)
        return None if sent is asking else sent

    # otherwise merged: the sizes of files bound neither the rows once per entry nor the selectors once per part
    same = F.col("_entry") == F.col("_probe")
    others = probes.filter("not _common")
    sent = sendable(others)
    met_others = met(chosen(held, f"not coalesce(e in {is_common}, false)"), others.hint("merge") if sent is None else sent, same)
    placed, of_common = chosen(held, f"e in {is_common}"), written(probes.filter("_common"), "common-probes")
    sent = sendable(of_common)
    if sent is not None:
        return met_others.unionByName(met(placed, sent, same))
    used = known.join(of_common.select(F.col("_probe").alias("entry")).distinct(), "entry", "left_semi").select(
        "entry", F.ceil(F.col("n_rows") / F.lit(part_rows)).alias("_parts"))
    spread = F.xxhash64(*[c for c, t in rows.dtypes if "map" not in t])
    placed = placed.join(F.broadcast(used), F.col("_entry") == F.col("entry")).withColumn("_part", F.pmod(spread, F.col("_parts"))).drop("entry", "_parts")
    parted = of_common.join(F.broadcast(used), F.col("_probe") == F.col("entry")).withColumn(
        "_at", F.explode_outer(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("entry", "_parts")
    return met_others.unionByName(met(placed, parted.hint("merge"), same & (F.col("_part") == F.col("_at"))))
