"""Documents joined by the Jaccard similarity of their word n-gram sets, by a token-group matrix.

1. Every document becomes its set of hashed shingles (64 bits). Equal sets become one node.
2. The hash range is cut into as many slices as suit a class of sizes, and each slice of a set becomes one token: a hash of all its
   shingles there. Sets at similarity t or more differ in a bounded number of shingles, so in no more slices; the rest agree. Slices
   are put in one order, full ones first: of two such sets, the first (differing slices + `ELL`) tokens have `ELL` in common.
   A token stands for several shingles, so a passage or a common shingle alone brings no two documents together.
3. Nodes that share such tokens are partitioned into groups: the most central node they meet, and a narrow band of
   sizes. The matrix holds each group's union of tokens.
4. A node's overlap with a group's union bounds its overlap with every member: below `ELL` no member can be similar enough, nor can
   one whose size is out of reach. Only groups that may hold a partner are opened.
   A few bits of each set, the parities of its shingles per bucket, differ at most in as many places as the sets have shingles
   apart: pairs that differ in too many are dropped before any text is moved.
5. Opening a group first compares the node with the group's central member. What is then in one component is done: of
   a large group of near copies no further pair is looked at. Members in other components are compared one by one, again
   after the same bounds. All comparisons count whole sets.

No link between different sets is lost; pairs inside a component that is already joined are not listed. Nulls and small cases: a null or
wordless text has an empty set and no partner; fewer words than n are one shingle; repeated rows are in one class; rows that
share an id but not a text are nodes of their own, and report the smallest id reachable; null ids never name a component that has others.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import id_text, packed, small_batches, unpacked
from runlens.llm.graph import components
from runlens.session import written

BUCKETS = 1 << 20
PARITIES = 512
# tokens that similar sets share at least; ratio of the sizes of one class; slices to spare for each that may differ
ELL, CLASS_RATIO, SPARE = 2, Fraction(8, 5), Fraction(1, 4)
_RNG = np.random.default_rng(3)
_FACTORS = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    # fixed values: the widely used 64-bit finalizer
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles. Bytes know no letters but A-Z and no blanks but the six of ASCII."""
    from xxhash import xxh3_64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n)
    size = min(n, k)
    h = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        h += _mixed(w[j:n - size + 1 + j] * _FACTORS[j % 64] + np.uint64(j))
    return np.unique(_mixed(h))


def _needed(n: int, t: Fraction) -> int:
    """ceil(t * n): shingles that a set of n shares at least with a partner."""
    return -(-t.numerator * n // t.denominator)


def _size_classes(t: Fraction) -> list[int]:
    """Smallest size of every class. A partner of a set is in its own class or a neighbouring one."""
    ratio = max(CLASS_RATIO, 1 / t)
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(-(-bounds[-1] * ratio.numerator // ratio.denominator))
    return bounds


def _differing(n: int, t: Fraction) -> int:
    """Shingles that a set of n and a partner can have apart from each other at most: (1 - t) / t of n."""
    return n * (t.denominator - t.numerator) // t.numerator


def tokens(s: np.ndarray, t: Fraction, bounds: list[int]) -> np.ndarray:
    """The first tokens of a sorted set, for its own size class and, where a partner can be there, the next one.

    A set that can only equal its partner has none. Empty slices count as equal and come last, so that no case is lost.
    """
    n = len(s)
    apart = _differing(n, t)
    if not apart:
        return np.zeros(0, np.uint64)
    own = bisect_right(bounds, n) - 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(s, dtype=np.uint64)])
    found = []
    for c in (own, own + 1) if _needed(bounds[own + 1], t) <= n else (own,):
        most = _differing(bounds[c + 1] - 1, t)
        slices = most + ELL + -(-most * SPARE.numerator // SPARE.denominator)
        starts = np.arange(slices, dtype=np.uint64) * np.uint64((1 << 64) // slices + 1)
        at = np.append(np.searchsorted(s, starts), n)
        names = _mixed(np.arange(c << 40, (c << 40) + slices, dtype=np.uint64) * _FACTORS[0])
        each = _mixed((sums[at[1:]] - sums[at[:-1]]) ^ names)
        found.append(each[np.lexsort((each, -np.diff(at)))[:apart + ELL]])
    return np.concatenate(found)


def parities(s: np.ndarray) -> np.ndarray:
    """Whether each bucket holds an odd number of the set's shingles, as words of 64 bits."""
    odd = np.bincount((s & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _may_link(n: Column, p: Column, m: Column, q: Column, t: Fraction) -> Column:
    """Whether two sets of n and m shingles with parities p and q can be similar enough."""
    apart = sum((F.bit_count(p[i].bitwiseXOR(q[i])) for i in range(PARITIES // 64)), F.lit(0)).cast("long")
    return ((apart * (t.numerator + t.denominator) <= (n + m).cast("long") * (t.denominator - t.numerator))
            & (n.cast("long") * t.denominator >= m.cast("long") * t.numerator) & (m.cast("long") * t.denominator >= n.cast("long") * t.numerator))


def _prefixes(rows: DataFrame, k: int, t: Fraction) -> DataFrame:
    """_id, _digest of the set, _n, _odd (its parities), _prefix (its first tokens)."""
    from xxhash import xxh3_128_digest

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _size_classes(t)
        for batch in source:
            digests, sizes, odd, prefixes = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text, k)
                digests.append(xxh3_128_digest(s.tobytes()))
                sizes.append(len(s))
                odd.append(parities(s))
                prefixes.append(tokens(s, t, bounds).view(np.int64))
            offsets = np.cumsum([0, *map(len, prefixes)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(prefixes) if prefixes else [], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()),
                                              pa.array(odd, pa.list_(pa.int64())), lists], names=["_id", "_digest", "_n", "_odd", "_prefix"])

    return rows.mapInArrow(batches, f"_id {dict(rows.dtypes)['_id']}, _digest binary, _n int, _odd array<bigint>, _prefix array<bigint>")


def _texts(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, text) for the wanted (node, _digest, _least): one document of each class is read again.

    Ids are first compared by a bucket of their hash: at most `BUCKETS` of them are broadcast, and most other texts are never shuffled.
    """
    from xxhash import xxh3_128_digest

    wanted = wanted.select("node", F.col("_digest").alias("_d"), "_least", F.xxhash64("_least").alias("_k"))
    bucket = F.pmod("_k", F.lit(BUCKETS))
    some = docs.withColumn("_k", F.xxhash64("_id")).withColumn("_b", bucket).join(
        F.broadcast(wanted.select(bucket.alias("_b")).distinct()), "_b", "left_semi").withColumnRenamed("_k", "_k_doc")
    rows = some.join(wanted, (F.col("_k_doc") == F.col("_k")) & F.col("_id").eqNullSafe(F.col("_least")))
    # rows that repeat id and text are read once; the join has dealt them out by the hash of the id already
    once = rows.withColumn("_t", F.xxhash64("_text")).dropDuplicates(["_k", "node", "_t"]).select("node", "_d", "_text")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            # an id may stand for several texts
            same = [xxh3_128_digest(shingles(t, k).tobytes()) == d for d, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            kept = batch.filter(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(2)], names=["node", "text"])

    return written(once.mapInArrow(batches, "node long, text string").dropDuplicates(["node"]), "candidate-texts")


def _linked(pairs: DataFrame, texts: DataFrame, k: int, t: Fraction) -> DataFrame:
    """Pairs (a, b) whose whole sets are similar enough. Texts are moved, which are smaller than their sets."""
    left, right = texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            sets: dict[int, np.ndarray] = {}

            def of(node: int, text: str, sets=sets) -> np.ndarray:
                if node not in sets:
                    sets[node] = shingles(text, k)
                return sets[node]

            a, b, ta, tb = (c.to_pylist() for c in batch.columns)
            near = []
            for x, y, tx, ty in zip(a, b, ta, tb, strict=True):
                sx, sy = of(x, tx), of(y, ty)
                both = len(np.intersect1d(sx, sy, assume_unique=True))
                near.append(both * t.denominator >= t.numerator * (len(sx) + len(sy) - both))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(batches, "a long, b long")


def similar_sets(classes: DataFrame, docs: DataFrame, k: int, t: Fraction) -> DataFrame:
    """(node, comp) of the nodes that are linked to another one."""
    each = classes.select("node", F.explode(F.concat("_prefix")).alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1")
    # a node is central if many share its tokens
    shared = each.join(often, "token").groupBy("node").agg(F.sum(F.floor(F.log2("c") * 1000)).alias("weight"), F.collect_list("token").alias("tokens"))
    nodes = written(shared.filter(F.size("tokens") >= ELL).join(classes.select("node", F.col("_n").alias("n"), F.col("_odd").alias("odd"), F.size("_prefix").alias("p")), "node")
                    .select("node", "n", "odd", F.floor(F.col("weight") / F.col("p")).alias("central"), "tokens"), "candidate-nodes")

    listed = nodes.select("node", "n", "central", F.explode(F.concat("tokens")).alias("token"))
    leaders = listed.groupBy("token").agg(F.max(F.struct("central", "node")).alias("leader"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(1 / float(t)) / 4))).cast("int")
    home = listed.join(leaders, "token").groupBy("node").agg(F.max("leader").alias("leader"))
    homes = written(nodes.join(home, "node").select("node", "n", "odd", "central", "tokens", F.struct(F.col("leader.node").alias("l"), band.alias("b")).alias("g")),
                    "grouped-nodes")
    groups = homes.groupBy("g").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("members"),
                                    F.max(F.struct("central", "node")).alias("rep")).withColumn("rep", F.col("rep.node"))
    matrix = homes.select("g", F.explode(F.concat("tokens")).alias("token")).distinct().join(groups, "g")
    queries = homes.select("node", "n", F.explode(F.concat("tokens")).alias("token"))
    # sizes are compared in the join, before anything is counted
    possible = ((F.col("q.token") == F.col("m.token")) & (F.col("high") * t.denominator >= F.col("n") * t.numerator)
                & (F.col("n") * t.denominator >= F.col("low") * t.numerator))
    opened = (queries.alias("q").join(matrix.alias("m"), possible).groupBy("node", "n", "g", "rep", "members").agg(F.count("*").alias("c"))
              .filter(F.col("c") >= ELL).drop("c"))
    opened = written(opened, "opened-groups")

    # a node alone in the only group it opens has no partner, and its text is not needed
    useful = opened.join(homes.select("node", F.col("g").alias("own")), "node").filter("g <> own OR members > 1")
    busy = useful.select("node").union(useful.select("g").distinct().join(homes.select("node", "g"), "g").select("node")).distinct()
    texts = _texts(docs, classes.join(busy, "node", "left_semi").select("node", "_digest", "_least"), k)

    stars = opened.filter("node <> rep").select(F.least("node", "rep").alias("a"), F.greatest("node", "rep").alias("b")).distinct()
    a, b = (homes.select(F.col("node").alias(x), F.col("n").alias(f"{x}_n"), F.col("odd").alias(f"{x}_odd")) for x in "ab")
    likely = stars.join(a, "a").join(b, "b").filter(_may_link(F.col("a_n"), F.col("a_odd"), F.col("b_n"), F.col("b_odd"), t)).select("a", "b")
    first = written(_linked(likely, texts, k, t), "star-links")
    comp = components(first)

    def with_comp(df: DataFrame, node: str, name: str) -> DataFrame:
        named = comp.select(F.col("node").alias("_c_node"), F.col("comp").alias("_c_comp"))
        return df.join(named, F.col(node) == F.col("_c_node"), "left").withColumn(name, F.coalesce("_c_comp", F.col(node))).drop("_c_node", "_c_comp")

    reps = with_comp(groups.select("g", "rep"), "rep", "rep_comp").select("g", "rep_comp")
    members = with_comp(homes, "node", "y_comp").join(reps, "g").withColumn("y_out", F.col("y_comp") != F.col("rep_comp"))
    outliers = members.filter("y_out").select(F.col("node").alias("o_node"))
    asks = with_comp(opened, "node", "comp").join(reps, "g").withColumn("apart", F.col("comp") != F.col("rep_comp"))
    asks = asks.filter("apart").unionByName(asks.filter("NOT apart").join(outliers, F.col("node") == F.col("o_node"), "left_semi"))
    asks = asks.join(homes.select("node", "odd", "tokens"), "node")
    y = members.select("g", F.col("node").alias("y"), F.col("n").alias("y_n"), F.col("odd").alias("y_odd"), F.col("tokens").alias("y_tokens"), "y_comp", "y_out")
    rest = (asks.join(y, "g").filter((F.col("y_comp") != F.col("comp")) & (F.col("apart") | F.col("y_out"))
                                     & _may_link(F.col("n"), F.col("odd"), F.col("y_n"), F.col("y_odd"), t))
            .filter(F.size(F.array_intersect("tokens", "y_tokens")) >= ELL)
            .select(F.least("node", "y").alias("a"), F.greatest("node", "y").alias("b")).distinct().join(stars, ["a", "b"], "left_anti"))
    second = written(_linked(rest, texts, k, t), "other-links")
    return components(first.unionByName(second)) if not second.isEmpty() else comp


def _assigned(docs: DataFrame, k: int, t: Fraction, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    rows = id_text(docs, id_col, text_col)
    sets = written(_prefixes(rows, k, t), "set-prefixes")
    classes = sets.groupBy("_digest").agg(F.min("_id").alias("_least"), F.first("_n").alias("_n"), F.first("_odd").alias("_odd"),
                                          F.first("_prefix").alias("_prefix"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "set-classes")
    comp = similar_sets(classes, rows, k, t)
    of = classes.join(comp, "node", "left").select("_digest", "_least", F.coalesce("comp", "node").alias("comp"))
    least = of.groupBy("comp").agg(F.min("_least").alias("_component"))
    names = of.join(least, "comp").select("_digest", "_component")
    found = sets.select("_id", "_digest", "_n").join(names, "_digest")
    return found.withColumn("_component", F.when(F.col("_n") == 0, F.col("_id")).otherwise(F.col("_component")))


def join(docs: DataFrame, k: int = 3, threshold: Fraction = Fraction(9, 10), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable over links, its own included)."""
    return _assigned(docs, k, threshold, id_col, text_col).select(
        F.col("_id").alias(id_col), F.col("_n").cast("long").alias("n_shingles"), F.col("_component").alias("component_id"))


def drop_near_copies(docs: DataFrame, k: int = 5, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of each component's smallest id, with all their columns. Rows that share that id are one document and all stay."""
    lost = _assigned(docs, k, threshold, id_col, text_col).filter(~F.col("_id").eqNullSafe(F.col("_component"))).select(
        F.col("_id").alias("_lost")).distinct()
    rows = packed(docs, id_col, text_col).drop("_text")
    return unpacked(rows.join(written(lost, "near-copies"), F.col("_id").eqNullSafe(F.col("_lost")), "left_anti"))
