"""Benchmark passages in documents, by winnowing.

A window is `window` consecutive words of a benchmark item; a shorter item is one window. The fingerprint of a window is
the smallest hash among its `k`-grams, so two equal windows always have the same one: joining the fingerprints of
all windows loses no shared span of `window` words. Neighbouring windows mostly share their fingerprint, and a document
contributes each value once. Documents with a common fingerprint are then read again and their matching windows compared word by
word, which extends every hit to all shared words.

Only built-in expressions are used. The benchmark side is broadcast when its counted windows are few; beyond that the
same joins shuffle, and adaptive execution splits fingerprints that many documents share.

Nulls and repeats: a null text has no words; items without words match nothing; an item without an id marks words but is
not listed; repeated rows get equal answers, rows that share an id but not a text each get their own. An empty
benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import ascii_lower, id_text, packed, unpacked
from runlens.session import written

# fixed values: what stands between words, and the same once A-Z are lower case
BETWEEN_RAW = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, K = 10, 4
# benchmark windows up to which they are sent to every executor (about 100 bytes each)
SENT_WINDOWS = 200_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BETWEEN), "")


def _hashes(text: Column) -> Column:
    """A hash for each word of a text. `lower` on a single word equates all that `ascii_lower` equates, and costs less."""
    return F.transform(F.array_remove(F.split(text, BETWEEN_RAW), ""), lambda w: F.xxhash64(F.lower(w)))


def _joined(df: DataFrame, name: str, length: int, join) -> DataFrame:
    """The array column `name` joined over `length` neighbours by `join`, in steps that double what is covered.

    The last `length` - 1 positions cover less; callers either never look at them or compare words afterwards.
    """
    done = 1
    while done < length:
        step = min(done, length - done)
        rest = F.slice(name, F.lit(step + 1), F.greatest(F.size(name), F.lit(1)))
        df = df.withColumn(name, F.zip_with(name, rest, join))
        done += step
    return df


def _fingerprints(df: DataFrame, lengths: list[int], window: int, k: int) -> DataFrame:
    """From the array `_h` of word hashes, adds `_f{m}` for each window length m: fingerprint by position."""
    for m in lengths:
        df = df.withColumn(f"_f{m}", F.transform("_h", lambda h: F.xxhash64(h, F.lit(min(m, k)))))
        df = _joined(df, f"_f{m}", m if m < window else k, lambda a, b: F.xxhash64(a, b))
        if m == window:
            df = _joined(df, f"_f{m}", window - k + 1, lambda a, b: F.least(a, b))
    return df


def _windows(items: DataFrame, window: int) -> DataFrame:
    """(_item, _m, _text) of every distinct window of the benchmark."""
    n = F.size("_w")
    m = F.least(n, F.lit(window))
    return (items.withColumn("_w", words(F.col("_text"))).filter(n > 0)
            .select(F.col("_id").alias("_item"), "_w", m.alias("_m"), F.explode(F.sequence(F.lit(1), n - m + 1)).alias("_p"))
            .select("_item", "_m", F.array_join(F.slice("_w", F.col("_p"), F.col("_m")), " ").alias("_text")).distinct())


def _same_row(left: str, right: str) -> Column:
    return F.col(f"{left}._id").eqNullSafe(F.col(f"{right}._id")) & (F.col(f"{left}._key") == F.col(f"{right}._key"))


def hits(docs: DataFrame, bench: DataFrame, window: int = WINDOW, k: int = K, id_col: str = "doc_id",
         text_col: str = "text", item_col: str = "item_id", sent_windows: int = SENT_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """(rows, hits). Rows of `docs`: `_id`, `_key` (hash of the text, so that both name a row), `_n` words. Their
    matching windows: `_id`, `_key`, `_item`, `_pos` from 0, `_m` words."""
    spans = written(_windows(id_text(bench, item_col, text_col), window), "benchmark-windows")
    per_length = {r["_m"]: r["n"] for r in spans.groupBy("_m").agg(F.count("*").alias("n")).collect()}  # `window` rows at most
    lengths = sorted(per_length) or [window]
    few = sum(per_length.values()) <= sent_windows
    send = F.broadcast if few else (lambda df: df)

    known = _fingerprints(spans.withColumn("_h", _hashes(F.col("_text"))), lengths, window, k)
    # a span is as long as its window: its fingerprint is the first one, which covers it all
    own = F.coalesce(*[F.when(F.col("_m") == m, F.get(F.col(f"_f{m}"), F.lit(0))) for m in lengths])
    prints = written(known.select("_item", "_m", "_text", own.alias("_f")), "benchmark-fingerprints")

    source = id_text(docs, id_col, text_col).withColumn("_key", F.xxhash64("_text"))
    grams = _fingerprints(source.select("_id", "_key", _hashes(F.col("_text")).alias("_h")), lengths, window, k)
    # every row also contributes one null, which carries its number of words
    marked = F.concat(F.array(F.lit(None).cast("bigint")), *[F.array_distinct(f"_f{m}") for m in lengths])
    seen = grams.select("_id", "_key", F.size("_h").cast("long").alias("_n"), F.explode(marked).alias("_f"))
    listed = prints.select(F.col("_f").alias("_p")).distinct()
    if few:
        kept = seen.join(F.broadcast(listed), F.col("_f") == F.col("_p"), "left").filter("_f IS NULL OR _p IS NOT NULL").drop("_p")
    else:
        kept = seen.filter("_f IS NULL").unionByName(seen.join(listed, F.col("_f") == F.col("_p"), "left_semi"))
    kept = written(kept, "seen-fingerprints")

    found = kept.filter("_f IS NOT NULL").distinct().groupBy("_id", "_key").agg(F.collect_list("_f").alias("_found"))
    again = source.alias("s").join(found.alias("f"), _same_row("s", "f")).select(
        "s._id", "s._key", words(F.col("_text")).alias("_w"), _hashes(F.col("_text")).alias("_h"), "_found")
    again = _fingerprints(again, lengths, window, k)

    def places(m: int) -> Column:
        last = F.size("_w") - m
        within = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(F.filter(within, lambda i: F.array_contains(F.col("_found"), F.get(F.col(f"_f{m}"), i))),
                           lambda i: F.struct(i.alias("p"), F.lit(m).alias("m")))

    placed = again.select("_id", "_key", "_w", F.explode(F.concat(*[places(m) for m in lengths])).alias("_at")).select(
        "_id", "_key", F.col("_at.p").alias("_pos"), F.col("_at.m").alias("_m"),
        F.array_join(F.slice("_w", F.col("_at.p") + 1, F.col("_at.m")), " ").alias("_text"))
    same = placed.join(send(prints.select("_m", "_text", "_item")), ["_m", "_text"])
    return kept.filter("_f IS NULL").drop("_f"), same.select("_id", "_key", "_item", "_pos", "_m")


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, k: int = K, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", sent_windows: int = SENT_WINDOWS) -> DataFrame:
    """One row per input row: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows, same = hits(docs, bench, window, k, id_col, text_col, item_col, sent_windows)
    found = written(same, "benchmark-hits")
    covered = (found.select("_id", "_key", "_pos", "_m").distinct()
               .select("_id", "_key", F.explode(F.sequence(F.col("_pos"), F.col("_pos") + F.col("_m") - 1)).alias("_word"))
               .groupBy("_id", "_key", "_word").agg(F.lit(1).alias("_one"))
               .groupBy("_id", "_key").agg(F.sum("_one").alias("_hit")))
    names = (found.select("_id", "_key", F.col("_item").cast("string").alias("_item")).distinct().groupBy("_id", "_key")
             .agg(F.array_sort(F.collect_list("_item")).alias("_items")))
    both = covered.alias("c").join(names.alias("n"), _same_row("c", "n")).select("c._id", "c._key", "_hit", "_items")
    none = F.array().cast("array<string>")
    return rows.alias("r").join(both.alias("b"), _same_row("r", "b"), "left").select(
        F.col("r._id").alias(id_col), F.col("_n").alias("n_words"), F.coalesce("_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("_items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("_items", none), ","), 256).alias("items_sha256"),
        F.coalesce(F.col("_hit") > 0, F.lit(False)).alias("contaminated"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of `docs` that hold no window of the benchmark, with all their columns."""
    _, same = hits(docs, bench, id_col=id_col, text_col=text_col, **how)
    found = written(same.select("_id", "_key").distinct(), "contaminated")
    rows = packed(docs, id_col, text_col).withColumn("_key", F.xxhash64("_text")).drop("_text")
    return unpacked(rows.alias("r").join(found.alias("f"), _same_row("r", "f"), "left_anti"))
