"""Spelling variants of frequent words: a word belongs to a far more frequent word one edit away.

Words come with their number of occurrences. The bigrams of all words are ranked, rare first. A word's *prefix* is its three rarest
bigrams (with every place of the third); any two words one edit apart share a bigram of this kind, and more: of two disjoint bigrams of the
prefix, the *pivots*, one edit destroys at most one, so the other stands in the second word as well, and in its prefix
if that one reaches as far up the ranking. The pivots are the two disjoint bigrams that occur in the fewest words, found by
dynamic programming. Pivots are indexed and joined with the prefixes of all words.

The surviving pivot lies wholly left or wholly right of the edit. So either everything up to the pivot is equal, which
puts it at the same distance from the start, or everything from it on, which puts it at the same distance from the end. On the side of the
edit, the half of the letters nearer to the pivot is equal, or the farther half. The join key is the equal side with its bigram and the
equal half: position limit and unchanged letters at once, so that a key meets few words even where a bigram is in very many.
Words of the same key must differ in length by at most one, the indexed prefix must be the one that reaches less far, and the edit
distance verifies each pair.

Alphabet and so the number of ranked bigrams are fixed by the pattern of words (90 letters, at most 8 100 bigrams), whatever the input.

Nulls and ties: a null text has no words; a null id counts as empty in the damage rule; repeated rows count each; of equally frequent near words
the smaller in code-point order is the form; an empty table gives an empty result. Only the id and the text column are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import ascii_lower, id_text
from runlens.session import written

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
GRAM = 2
# counts are below 2**63 and grow at least RATIO-fold along a chain of forms: 27 links, which 5 doublings reach
DOUBLINGS = 5


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """(`_id`, word): the lower-cased runs of at least `least` letters, one row per occurrence."""
    pattern = F.lit(f"[{LETTERS}]{{{least},}}")
    found = id_text(docs, id_col, text_col).select("_id", F.explode(F.regexp_extract_all("_text", pattern, F.lit(0))).alias("_run"))
    return found.select("_id", ascii_lower(F.col("_run")).alias("word"))


def with_slips(words: DataFrame, one_in: int = 199) -> DataFrame:
    """A letter falls out of one in `one_in` words, by the checksum of id and word."""
    key = F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
    hashed = words.withColumn("_h", F.crc32(key.cast("binary")))
    size = F.char_length("word")
    at = (F.col("_h") % size).cast("int")
    shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, size))
    return hashed.select("_id", F.when(F.col("_h") % one_in == 0, shorter).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of words that are long and frequent enough."""
    counted = words.filter(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """Rank of every bigram, those of the fewest words first. Bounded by the square of the alphabet."""
    size = F.char_length("word")
    grams = F.transform(F.sequence(F.lit(1), size - GRAM + 1), lambda i: F.substring("word", i, F.lit(GRAM)))
    counted = words.select(F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    return {r["gram"]: rank for rank, r in enumerate(sorted(counted.collect(), key=lambda r: (r["n"], r["gram"])))}


def prefix(word: str, rank: dict[str, int], edits: int = 1) -> list[tuple[int, int]]:
    """(place, rank) of the `GRAM * edits + 1` rarest bigrams in order of place, and of every other place of the last of them."""
    ranked = sorted((rank[word[i:i + GRAM]], i) for i in range(len(word) - GRAM + 1))
    last = ranked[min(len(ranked), GRAM * edits + 1) - 1][0]
    return sorted((i, r) for r, i in ranked if r <= last)


def pivots(chosen: list[tuple[int, int]], edits: int = 1) -> list[int]:
    """Places of `edits + 1` disjoint bigrams of a prefix with the least sum of ranks.

    `best[k]` is the cheapest choice of k disjoint bigrams among those seen so far, kept for each place where it may end.
    """
    ends: list[list[tuple[int, list[int]]]] = []  # per bigram: cheapest choices of 0, 1, 2, ... bigrams up to this one
    for at, (place, weight) in enumerate(chosen):
        free = max((j for j in range(at) if chosen[j][0] + GRAM <= place), default=None)
        before = ends[free] if free is not None else [(0, [])]
        kept = list(ends[-1]) if ends else [(0, [])]
        for k, (cost, places) in enumerate(before[:edits + 1]):
            found = (cost + weight, [*places, place])
            if k + 1 == len(kept):
                kept.append(found)
            elif found < kept[k + 1]:
                kept[k + 1] = found
        ends.append(kept)
    return ends[-1][edits + 1][1]


def _rests(word: str, place: int) -> tuple[tuple[str, str], tuple[str, str]]:
    """What is equal if the bigram survives, and what holds the edit: with the edit on its right, and (mirrored) on its left."""
    return (f"<{word[:place + GRAM]}", word[place + GRAM:]), (f">{word[place:]}", word[:place][::-1])


def _halves(same: str, rest: str, length: int) -> tuple[str, str]:
    """The two keys of a side whose other word has a rest of `length` letters: the edit spares the nearer or the farther half of it."""
    near = length // 2
    return f"{same}{rest[:near]}", f"{same}|{rest[max(len(rest) - (length - near), 0):]}"


def index_keys(word: str, place: int) -> set[str]:
    return {key for same, rest in _rests(word, place) for key in _halves(same, rest, len(rest))}


def probe_keys(word: str, place: int) -> set[str]:
    return {key for same, rest in _rests(word, place)
            for length in range(max(len(rest) - 1, 0), len(rest) + 2) for key in _halves(same, rest, length)}


def gram_keys(words: DataFrame, rank: dict[str, int], edits: int = 1) -> DataFrame:
    """(key, word, reach, indexed): the pivots of every word as the index, the bigrams of its prefix as probes; `reach` is the
    highest rank of the prefix. Keys are strings; their hash stands for them, as every pair is verified."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out: list[tuple[str, str, int, bool]] = []
            for word in batch.column(0).to_pylist():
                chosen = prefix(word, rank, edits)
                reach = max(r for _, r in chosen)
                found = {key for place in pivots(chosen, edits) for key in index_keys(word, place)}
                out += [(key, word, reach, True) for key in found]
                found = {key for place, _ in chosen for key in probe_keys(word, place)}
                out += [(key, word, reach, False) for key in found]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["key", "word", "reach", "indexed"])

    keys = words.select("word").mapInArrow(batches, "key string, word string, reach long, indexed boolean")
    return keys.withColumn("key", F.xxhash64("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): every two words one edit apart, once. `words` must be a written table of distinct words."""
    keys = written(gram_keys(words, gram_ranks(words)), "gram-keys")
    index = keys.filter("indexed").select("key", F.col("word").alias("a"), F.col("reach").alias("ra"))
    probes = keys.filter("not indexed").select(F.col("key").alias("k"), F.col("word").alias("b"), F.col("reach").alias("rb"))
    meet = ((F.col("key") == F.col("k")) & (F.col("ra") <= F.col("rb")) & (F.col("a") != F.col("b"))
            & (F.abs(F.char_length("a") - F.char_length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1))
    return index.join(probes, meet).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): the most frequent near word of each word, if frequent enough."""
    pairs = near_pairs(words)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = words.select(F.col("word").alias("b"), F.col("n").alias("m"))
    # largest n first, then the smaller word
    best = F.min(F.struct((-F.col("m")).alias("m"), F.col("b").alias("b")))
    nearest = both.join(counts, "b").groupBy("a").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(nearest, F.col("word") == F.col("a"), "left")
    enough = -F.col("best.m") >= F.col("n") * ratio
    return found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                        F.when(enough, F.col("best.b")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n"))


def with_roots(found: DataFrame) -> DataFrame:
    """Add `root`: the end of the chain of forms that starts at the word. `found` must be a written table of `forms`."""
    links = written(found.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-links")
    for _ in range(DOUBLINGS):
        onward = links.select(F.col("word").alias("w"), F.col("root").alias("r"))
        links = written(links.join(onward, F.col("root") == F.col("w"), "left").select("word", F.coalesce("r", "root").alias("root")),
                        "spelling-links")
    return found.join(links, "word", "left").select(*found.columns, F.coalesce("root", "word").alias("root"))


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n)."""
    kept = written(words, "vocabulary")
    return with_roots(written(forms(kept, ratio), "spelling-forms")).select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slips: Column | int | None = None) -> DataFrame:
    """Variants among the words of whole documents; with `slips`, one word in so many first loses a letter."""
    found = runs(docs, id_col, text_col)
    return variants(vocabulary(with_slips(found, slips) if slips else found))
