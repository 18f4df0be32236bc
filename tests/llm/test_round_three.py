"""Spelling variants, conversation repair and shards, against brute force."""

import heapq
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from llm_tables import edge, make  # noqa: F401

from runlens.llm import repair, sharding, spelling
from runlens.session import written


# ---- spelling variants ----


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long_ = sorted((a, b), key=len)
    return len(long_) - len(short) == 1 and any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))


def brute_variants(counts):
    near = {a: [b for b in counts if one_edit(a, b)] for a in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= 5 * counts[word] else None
    rows = []
    for word in counts:
        root = word
        while form[root] is not None:
            root = form[root]
        rows.append((word, form[word], root, counts[word], len(near[word]), counts[form[word]] if form[word] else None))
    return sorted(rows)


def slipped(doc_id, run):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
    if h % 199 == 0:
        at = h % len(low)
        low = low[:at] + low[at + 1:]
    return low


def brute_words(rows):
    found = Counter(slipped(i, run) for i, text in rows for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""))
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def word_rows(seed):
    """Words of few letters in steps of five times the frequency, so that chains of forms arise; with repeats of one letter."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 8))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "ababab", "bababa", "÷×÷×÷×"]
    words = []
    for word in base:
        times = rng.choice([5, 6, 30, 160])
        words += [word] * times
        at = rng.randrange(len(word))
        for changed in (word[:at] + word[at + 1:], word[:at] + "c" + word[at:], word[:at] + "d" + word[at + 1:], "z" + word, word + "z"):
            words += [changed] * max(times // 6, 1)
    rng.shuffle(words)
    rows = [(n, " ".join(words[n::37]) + rng.choice([" THE Él", "", "1x2"])) for n in range(37)]
    return rows + [(None, " ".join(["abcabcabc"] * 7)), (40, None), (41, ""), (42, "short words only"), (42, "short words only"), (43, "q" * 20_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(make, seed):
    rows = word_rows(seed)
    got = sorted(tuple(r) for r in spelling.spelling_variants(make(rows), slips=199).collect())
    want = brute_variants(brute_words(rows))
    assert got == want
    assert any(r[1] for r in want) and any(r[1] and r[2] != r[1] for r in want)


def test_variants_of_nothing(make):
    assert spelling.spelling_variants(make([])).collect() == []
    assert spelling.spelling_variants(make([(1, None), (2, "")])).collect() == []


def test_a_word_alone_has_no_form(make):
    got = spelling.spelling_variants(make([(n, "Einzige") for n in range(5)])).collect()
    assert [tuple(r) for r in got] == [("einzige", None, "einzige", 5, 0, None)]


def test_chains_of_many_forms(spark):
    words = [("abcdef" + "g" * k, 6 ** k * 5) for k in range(20)]
    got = {r["word"]: r["root"] for r in spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert set(got.values()) == {words[-1][0]}


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(3)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randint(3, 6)))
        chosen = [(p, rng.randrange(20)) for p in places]
        weight = dict(chosen)
        found = spelling.pivots(chosen)
        best = min(weight[a] + weight[b] for a, b in itertools.combinations(places, 2) if b - a >= 2)
        assert len(found) == 2 and found[1] - found[0] >= 2 and sum(weight[p] for p in found) == best


# ---- conversation repair ----


def brute_repair(turns):
    """Cheapest edits by Dijkstra over (row, roles so far), ties by the audit."""
    seen, rows = set(), []
    for role, text in turns:
        shown = text.strip(" \t\n\v\f\r")
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        rows.append((role, text, fault))
    lawful = re.compile(r"(s?(ua)*u?)?")

    def shape(roles):
        return "" if not roles else roles if roles == "s" else roles[-1]

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, out = heapq.heappop(heap)
        if (at, roles) in done:
            continue
        done.add((at, roles))
        if at == len(rows) and roles in ("", "a"):
            return cost, audit, list(out), [r[2] for r in rows]
        steps = [("I", 2, at, r) for r in ("user", "assistant")]
        if at < len(rows):
            role, text, fault = rows[at]
            more = fault == "truncated"
            steps.append(("D", 3, at + 1, None))
            if fault not in ("blank", "duplicate"):
                steps.append(("K", more, at + 1, role))
                steps += [("R", 2 + more, at + 1, r) for r in ("user", "assistant")]
        for letter, price, then, role in steps:
            if role is None:
                heapq.heappush(heap, (cost + price, audit + letter, then, roles, out))
                continue
            after = {"": "", "s": "s", "u": "u", "a": "ua"}[roles] + role[:1]
            if role[:1] and lawful.fullmatch(after):
                line = (role, "" if letter == "I" else rows[at][1])
                heapq.heappush(heap, (cost + price, audit + letter, then, shape(after), out + (line,)))


TEXTS = ["Fine.", "Really?", "cut off", "", " \t", "Ends. \n", "No-break ", "…", "Ok!"]


def chat_rows(seed):
    rng = random.Random(seed)
    rows = [(conv, turn if rng.random() < 0.9 else None, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User", None]),
             rng.choice([*TEXTS, f"Text {conv} {turn}.", None])) for conv in range(60) for turn in range(rng.randint(1, 8))]
    rows += [(None, 3, "user", "Hi."), (None, 9, "assistant", "Yes."), (70, 5, "user", "One."), (70, 5, "user", "One."), (70, 1, "system", "Be brief.")]
    rows += [(80 + n, t, "user" if t % 2 == 0 else "assistant", f"Hot {n} {t}.") for n in range(40) for t in range(4)]
    return rows


def chats(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, _conv string, cost long").repartition(3)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repair_equals_brute_force(spark, seed):
    rows = chat_rows(seed)
    got = {r["conv_id"]: r for r in repair.repaired(chats(spark, rows)).collect()}
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    assert set(got) == set(by_conv)
    for conv, turns in by_conv.items():
        turns.sort()
        cost, audit, lines, faults = brute_repair([t[2:] for t in turns])
        r = got[conv]
        assert (r["cost"], r["audit"], [tuple(x) for x in r["repaired"]]) == (cost, audit, lines), conv
        assert [r["blank"], r["duplicate"], r["truncated"]] == [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        numbers = {t[1] for t in turns if t[0]}
        assert r["gaps"] == (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0)
        initials = [t[2][:1] for t in turns]
        assert r["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def test_repair_of_nothing_and_of_dropped_rows(spark):
    from pyspark.sql import functions as F

    assert repair.repaired(chats(spark, chat_rows(1)).limit(0)).collect() == []
    (row,) = repair.digests(repair.repaired(chats(spark, [(1, 0, "user", "Hi.")]), copies=F.lit(0))).collect()
    assert row.asDict() == {"conv_id": 1, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
                            "repaired_sha256": "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"}


def test_a_very_long_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(30_000)] + [(2, 0, "user", "x" * 200_000 + ".")]
    got = {r["conv_id"]: r for r in repair.repaired(chats(spark, rows)).collect()}
    assert got[1]["cost"] == 0 and got[1]["audit"] == "K" * 30_000
    assert (got[2]["cost"], got[2]["audit"]) == (2, "KI")


def test_every_node_is_worked_on_once(monkeypatch):
    """The path of one task: words in order of their reversed letters share the nodes of equal ends."""
    words, made = sorted({"".join(w) for n in range(5) for w in itertools.product("suax", repeat=n)}, key=lambda w: w[::-1]), []
    real = repair.node
    monkeypatch.setattr(repair, "node", lambda letter, then: made.append(letter) or real(letter, then))
    path, before = [repair.LAST], ""
    for word in words:
        back = word[::-1]
        shared = next((i for i, (a, b) in enumerate(zip(before, back, strict=False)) if a != b), min(len(before), len(back)))
        del path[shared + 1:]
        for letter in back[shared:]:
            path.append(repair.node(letter, path[-1]))
        before = back
    assert len(made) == len({w[i:] for w in words for i in range(len(w))})


# ---- shards ----


def doc_rows(seed=5, n=900):
    rng = random.Random(seed)
    rows = [(i, "Hot text" if i % 3 == 0 else "copy " * (i % 7) if i % 5 == 0 else "w" * rng.randint(0, 400) + f" {i}",
             rng.choice(["en", "de", None, "fr"]), rng.choice(["web", "web", "web", "book", None, f"s{i % 9}"])) for i in range(n)]
    return rows + [(None, "x", "en", "web"), (5, None, "en", "web"), (5, None, "en", "web"), (6, "", None, None), (7, "é" * 900, "fr", "web")]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, lang string, source string, _n long, shard long, _h long").repartition(4)


def brute_curve(rows):
    """Positions by the stated rules, from plain Python."""
    import numpy as np

    from runlens.llm.packing import hilbert

    def levels(values):
        known = sorted(v for v in values if v is not None)
        before = {v: known.index(v) * 256 // len(values) for v in set(known)}
        least = {}  # values of one level
        for v in sorted(before):
            least.setdefault(before[v], v)
        return [0 if v is None else before[v] for v in values]

    sizes = [len((t or "").encode()) + 1 for _, t, _, _ in rows]
    ids = [i for i, *_ in rows if i is not None]

    def linear(v, low, high):
        return int(min(max((v - low) / max(high - low, 1e-9) * 255, 0), 255))

    log = [linear(np.log2(float(s)), np.log2(min(sizes)), np.log2(max(sizes))) for s in sizes]
    by_id = [linear(float(min(ids) if i is None else i), min(ids), max(ids)) for i, *_ in rows]
    points = np.array([log, by_id, levels([r[3] for r in rows]), levels([r[2] for r in rows])]).T
    keys = hilbert(points, 8)
    least = {}
    for (_, text, _, _), key in zip(rows, keys, strict=True):
        least[text or ""] = min(least.get(text or "", key), key)
    return [int(least[t or ""]) for _, t, _, _ in rows], sizes


def test_shards_follow_the_curve_and_are_equal(spark):
    rows = doc_rows()
    got = sharding.shards(table(spark, rows)).collect()
    keys, sizes = brute_curve(rows)
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"], r["curve"]) for r in got) == sorted(
        (i or -1, s, zlib.crc32((t or "").encode()), k) for (i, t, _, _), s, k in zip(rows, sizes, keys, strict=True))
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    mean = sum(sizes) / 16
    per, order = Counter(), {}
    for r in got:
        per[r["shard"]] += r["size"]
        order.setdefault(r["shard"], []).append(r)
    assert set(per) == set(range(16)) and all(abs(v - mean) <= 0.05 * mean + max(sizes) for v in per.values())
    place = []
    for shard in sorted(order):
        order[shard].sort(key=lambda r: r["slot"])
        assert [r["slot"] for r in order[shard]] == list(range(len(order[shard])))
        place += [(r["curve"], r["text_hash"]) for r in order[shard]]
    assert place == sorted(place)
    # groups of at most a twentieth of a shard are whole
    where, size = {}, Counter()
    for r in got:
        where.setdefault(r["text_hash"], set()).add(r["shard"])
        size[r["text_hash"]] += r["size"]
    assert all(len(where[h]) == 1 for h in where if size[h] <= 0.05 * mean)
    hot = max(size, key=size.get)
    assert size[hot] > 0.05 * mean


def test_shards_of_few_or_no_rows(spark):
    assert sharding.shards(table(spark, doc_rows()).limit(0)).collect() == []
    (one,) = sharding.shards(table(spark, [(1, None, None, None)])).collect()
    assert (one["size"], one["text_crc32"], one["slot"]) == (1, 0, 0) and 0 <= one["shard"] < 16
    same = sharding.shards(table(spark, [(1, "a", None, None)] * 50)).collect()
    assert Counter(r["shard"] for r in same).most_common(1)[0][1] <= 4 and len(same) == 50


def test_ids_that_are_text(spark):
    rows = [(f"id-{n}", f"text {n}", "en", "web") for n in range(60)]
    docs = spark.createDataFrame(rows, "name string, body string, lang string, source string")
    got = sharding.shards(docs, "name", "body", by=("source",), n_shards=3).collect()
    assert {r["name"] for r in got} == {r[0] for r in rows} and {r["shard"] for r in got} == {0, 1, 2}


def test_files_of_shards_can_be_skipped(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, "t" * rng.randint(1, 3000) + str(i), rng.choice(["de", "en", "es", "fr"]), f"src{rng.randrange(12):02d}") for i in range(4000)] + [(3, "again", "en", "src01")] * 2
    docs = table(spark, rows)
    path = str(tmp_path / "shards")
    manifest = sharding.write_shards(docs, path).collect()
    back = spark.read.parquet(path)
    assert back.drop("shard_").select(*docs.columns).exceptAll(docs).count() == 0 and back.count() == len(rows)
    assert {r["shard_"] for r in back.select("shard_").distinct().collect()} == {m["shard"] for m in manifest}
    assert sum(m["rows"] for m in manifest) == len(rows) and sum(m["bytes"] for m in manifest) == sum(len(r[1]) + 1 for r in rows)
    hits = [sum(m["min_lang"] <= v <= m["max_lang"] for m in manifest) for v in ("de", "en", "es", "fr")]
    hits += [sum(m["min_source"] <= f"src{s:02d}" <= m["max_source"] for m in manifest) for s in range(12)]
    hits += [sum(m["min_doc_id"] <= i <= m["max_doc_id"] for m in manifest) for i in range(0, 4000, 100)]
    assert sum(hits) / len(hits) < 0.75 * 16 and min(hits) < 8


def test_levels_follow_the_share_of_rows(spark):
    rows = written(spark.createDataFrame([("a",)] * 50 + [("b",)] * 25 + [("c",)] * 25 + [(None,)] * 100, "_d0 string"), "d")
    assert sharding.splits(rows, "_d0", 200) == (["a", "b", "c"], [0, 64, 96])
