"""Exact duplicates, near duplicates and benchmark passages, against brute force."""

import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from llm_tables import edge, make  # noqa: F401

from runlens.llm import decontaminate, exact_dedup, graph, jaccard


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- exact ----


def hot_rows(rng, edge):
    return edge + [(100 + n, "Hot Text" if n % 3 == 0 else rng.choice(["a", "A", "b É", "B é", f"t{n}"])) for n in range(300)]


def test_exact_groups(make, edge):
    rows = hot_rows(random.Random(4), edge)
    got = [tuple(r) for r in exact_dedup.classify(make(rows)).collect()]
    groups = {}
    for i, t in rows:
        groups.setdefault(lowered(t), []).append(i)
    low = lambda i: -1 if i is None else i
    want = [(i, max(groups[lowered(t)], key=low), len(groups[lowered(t)]), hashlib.sha256(lowered(t).encode()).hexdigest()) for i, t in rows]
    assert sorted(((g[0], g[1], g[2], g[4]) for g in got), key=repr) == sorted(want, key=repr)
    assert sum(g[3] for g in got) == len(groups)
    assert all(g[0] == g[1] for g in got if g[3])
    assert exact_dedup.classify(make([])).collect() == []


@pytest.mark.parametrize("with_repeats", [True, False])
def test_one_row_of_each_text_stays(make, edge, with_repeats):
    rows = hot_rows(random.Random(5), edge)
    if not with_repeats:
        rows = list(dict.fromkeys(rows))
    docs = make(rows)
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    kept = {}
    for r in out.collect():
        assert lowered(r["text"]) not in kept
        kept[lowered(r["text"])] = r["doc_id"]
    groups = {}
    for i, t in rows:
        groups.setdefault(lowered(t), []).append(i)
    assert kept == {t: max(g, key=lambda i: -1 if i is None else i) for t, g in groups.items()}
    assert exact_dedup.drop_copies(make([])).collect() == []


def test_heavy_digests_are_bounded_and_exact(make):
    rows = exact_dedup.digests(make([(n, "hot" if n % 2 else f"t{n}") for n in range(1000)]))
    from runlens.session import written

    heavy = exact_dedup.heavy_winners(written(rows, "d"), 1 / 20).collect()
    assert [(r["_size"], r["_top"]["_id"]) for r in heavy] == [(500, 999)]


# ---- components ----


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(n, n + 1) for n in range(400, 460)] + [(500, n) for n in range(501, 560)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["comp"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {x: find(x) for x in parent}
    assert {x: c for x, c in want.items() if sum(v == c for v in want.values()) > 1} == got
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- near ----


def shingle_set(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", lowered(text)) if x]
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])


def brute_components(rows, k, t):
    sets = [shingle_set(x, k) for _, x in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and n * t.denominator >= t.numerator * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        c = find(n)
        least[c] = i if least.get(c) is None else least[c] if i is None else min(i, least[c])
    return [(i, len(s), i if not s else least[find(n)]) for n, ((i, _), s) in enumerate(zip(rows, sets))]


def near_rows(rng, groups, copies, length, edits):
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(40)}" for _ in range(length)]
        for c in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(words))
                if rng.random() < 0.3:
                    del words[at]
                else:
                    words[at] = f"x{rng.randrange(1000)}"
            rows.append((1000 * g + c + 10, " ".join(words)))
    return rows


@pytest.mark.parametrize("k, t, length, edits", [(3, Fraction(9, 10), 80, 5), (5, Fraction(4, 5), 60, 4), (2, Fraction(1, 2), 12, 6), (1, Fraction(3, 4), 8, 3)])
def test_near_components_equal_brute_force(make, edge, k, t, length, edits):
    rng = random.Random(7)
    shared = " ".join(f"c{n}" for n in range(40))  # a passage that many documents share
    rows = edge + near_rows(rng, 6, 25, length, edits) + [(9000 + n, f"{shared} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randint(3, 30)))) for n in range(80)]
    rows += [(9500 + n, "A B C" if n % 2 else "a b  c") for n in range(40)] + [(10, "another text under an id that was used before")]
    got = sorted((tuple(r) for r in jaccard.join(make(rows), k, t).collect()), key=repr)
    assert got == sorted(brute_components(rows, k, t), key=repr)


def test_near_join_on_nothing(make):
    assert jaccard.join(make([])).collect() == []
    assert sorted(tuple(r) for r in jaccard.join(make([(1, None), (2, ""), (3, "one")])).collect()) == [(1, 0, 1), (2, 0, 2), (3, 1, 3)]


def test_one_document_of_each_near_group_stays(make):
    rows = near_rows(random.Random(8), 5, 10, 60, 2)
    docs = make(rows)
    out = jaccard.drop_near_copies(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.collect()} == {c for _, _, c in brute_components(rows, 5, Fraction(4, 5))}


# ---- benchmark ----


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text)) if w]


def brute_hits(docs, items, window=10):
    spans = set()
    for i, t in items:
        w = words(t)
        m = min(len(w), window)
        spans |= {(i, tuple(w[p:p + m])) for p in range(len(w) - m + 1) if m}
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, span in spans:
            for p in range(len(w) - len(span) + 1):
                if tuple(w[p:p + len(span)]) == span:
                    hit |= set(range(p, p + len(span)))
                    found.add(str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def bench_table(spark, items):
    return spark.createDataFrame([(*x, "n") for x in items], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("sent", [10**6, 0])
def test_contamination_equals_brute_force(spark, make, edge, sent):
    rng = random.Random(9)
    items = [(n, " ".join(f"q{rng.randrange(300)}" for _ in range(rng.randint(11, 30)))) for n in range(12)]
    items += [(50, "Short Item"), (51, "one"), (52, None), (53, "--"), (54, items[0][1]), (55, "ΑΣ ß straße ÉCOLE x y z q w e r")]
    docs = edge[:-2]
    for n in range(120):
        filler = lambda: " ".join(f"q{rng.randrange(300)}" for _ in range(rng.randint(0, 25)))
        item = rng.choice(items)[1] or ""
        w = item.split()
        part = " ".join(w[rng.randrange(max(1, len(w) - 10)):][:rng.randint(5, 30)])
        docs.append((100 + n, f"{filler()}, {part.upper() if n % 5 == 0 and n % 2 else part}! {filler()} {'short-item' if n % 7 == 0 else ''}"))
    docs.append((100, "same id, another text: ONE"))
    got = sorted((tuple(r) for r in decontaminate.contamination(make(docs), bench_table(spark, items), sent_windows=sent).collect()), key=repr)
    want = sorted(brute_hits(docs, items), key=repr)
    assert [g[:4] + (g[5],) for g in got] == [w[:4] + (w[5],) for w in want]
    assert got == want


def test_clean_documents_stay(spark, make, edge):
    items = [(1, " ".join(f"b{n}" for n in range(15)))]
    rows = edge + [(30, "x " + items[0][1][4:50]), (31, items[0][1] + " tail")]
    docs = make(rows)
    out = decontaminate.drop_contaminated(docs, bench_table(spark, items))
    assert out.columns == docs.columns
    clean = [i for i, *_, bad in brute_hits(rows, items) if not bad]
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == sorted(clean, key=repr)
    assert decontaminate.drop_contaminated(docs, bench_table(spark, [])).count() == len(rows)
    assert decontaminate.contamination(make([]), bench_table(spark, items)).collect() == []


@pytest.mark.parametrize("t", [Fraction(9, 10), Fraction(4, 5), Fraction(3, 4), Fraction(1, 2)])
def test_similar_sets_share_tokens(t):
    rng = np.random.default_rng(9)
    bounds = jaccard._size_classes(t)
    checked = 0
    for _ in range(600):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        for grow in (0, 0.5, 1):  # as far apart as can be: more of one, less of the other, or some of both
            apart = int((1 - t) / t * n)
            more = int(apart * grow)
            b = np.unique(np.concatenate([rng.permutation(a)[:len(a) - max(0, int((n + more) * (1 - t)) - more)], rng.integers(0, 1 << 64, more, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            near = both * t.denominator >= t.numerator * (len(a) + len(b) - both)
            if near and not np.array_equal(a, b):
                checked += 1
                assert len(np.intersect1d(jaccard.tokens(a, t, bounds), jaccard.tokens(b, t, bounds))) >= jaccard.ELL
                differ = int(np.bitwise_count((jaccard.parities(a) ^ jaccard.parities(b)).view(np.uint64)).sum())
                assert differ <= len(a) + len(b) - 2 * both
    assert checked > 500
