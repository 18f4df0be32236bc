"""Packing, language, quality, the pipeline and the registered queries."""

import random
import zlib

import numpy as np
import pytest
from llm_tables import edge, make  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from runlens.llm import language, packing, quality
from runlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# ---- packing ----


def test_hilbert_curve_visits_neighbours():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    key = packing.hilbert(grid, 3)
    assert sorted(key) == list(range(512))
    path = grid[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_library(library):
    rng = np.random.default_rng(0)
    parts = [" ", "  ", "\n", "\t", "a", "Word", "it's", "é", "𝔘", "12", "<|endoftext|>", "!!", " ", " ", "-", "x" * 30]
    texts = ["".join(rng.choice(parts, rng.integers(0, 15))) for _ in range(3000)]
    tokens = packing.Tokens()
    for t in texts:
        assert list(np.frombuffer(tokens.ids(t), np.uint16)) == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_cover_every_document_once(make, edge, library):
    rows = edge + [(100 + n, "some words " * (n * 7 % 900)) for n in range(60)]
    got = packing.packed_pieces(make(rows)).toPandas()
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4"))
    assert got.length.sum() == sum(len(x) for v in ids.values() for x in v)
    for i, copies in ids.items():
        if len(copies) == 1 and i is not None:
            own, at = got[got.doc_id == i].sort_values("start"), 0
            for r in own.itertuples():
                assert (r.start, r.doc_tokens) == (at, len(copies[0]))
                assert zlib.crc32(copies[0][at:at + r.length].tobytes()) == r.ids_crc32
                at += r.length
            assert at == len(copies[0])
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert list(s.offset) == [0, *s.length.cumsum()[:-1]]
        n = int(s.length.sum())
        assert n <= 1024 and n & (n - 1) == 0
    assert packing.packed_pieces(make([])).collect() == []


# ---- language ----


def test_tables_equal_the_convolution():
    rng = np.random.default_rng(1)
    model = {"names": ["a", "b"], "embed": rng.normal(size=(256, language.EMBEDDED)).astype(np.float32),
             "out": rng.normal(size=(len(language.WIDTHS) * language.FILTERS, 2)).astype(np.float32), "bias": np.zeros(2, np.float32)}
    for w in language.WIDTHS:
        model[f"w{w}"] = rng.normal(size=(w * language.EMBEDDED, language.FILTERS)).astype(np.float32)
        model[f"b{w}"] = rng.normal(size=language.FILTERS).astype(np.float32)
    windows = rng.integers(0, 256, (5, language.WINDOW)).astype(np.uint8)
    x = model["embed"][windows]
    h = np.concatenate([np.maximum((language._columns(x, w) @ model[f"w{w}"] + model[f"b{w}"]).max(1), 0) for w in language.WIDTHS], 1)
    logits = h @ model["out"]
    want = np.exp(logits - logits.max(1, keepdims=True))
    assert np.allclose(language.Network(model).probabilities(windows), want / want.sum(1, keepdims=True), atol=1e-4)


def test_language_on_held_out_rows(spark):
    got = QUERIES["op9_language_id"](spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id")
    held = [i for i in docs.index if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(got.index[got.held_out]) == sorted(held) and len(got) == len(docs)
    assert (got.lang_pred[held] == docs.lang[held]).mean() >= 0.9
    assert got.score.between(0, 1).all()


def test_language_sample_is_bounded_in_rows_and_languages(make):
    rows = [(7, f"text number {i} of one id", "en") for i in range(400)] + [(100 + i, "wort und satz", f"l{i % 3}") for i in range(90)]
    docs = make(rows + [(8, None, "en"), (None, "no id", "en"), (9, "no language", None)])
    got = language.training_windows(docs, F.lit(True), per_language=20, per_doc=2)
    assert sum(lang == "en" for lang, _ in got) == 2  # two windows of one row of id 7
    assert {w for lang, w in got if lang == "en"} <= {w for i in range(400) for t in [f"text number {i} of one id"] for w in (t, t[len(t) // 2:])}
    assert all(sum(lang == f"l{k}" for lang, _ in got) == 40 for k in range(3))
    assert got == language.training_windows(docs.repartition(5), F.lit(True), per_language=20, per_doc=2)
    with pytest.raises(ValueError):
        language.training_windows(docs, F.lit(True), max_languages=3)


def test_language_of_odd_texts(make, edge):
    rows = edge + [(n + 10, "the and of " * 20 if n % 2 else "der und die " * 20, "en" if n % 2 else "de") for n in range(40)] + [(60, "123 !!", None)]
    got = {}
    for r in language.learn_and_identify(make(rows)).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert all(got[i][0] == ("und", 0.0) for i in (1, 2, 3, 60)) and len(got[4]) == 2
    assert got[11][0][0] == "en" and got[10][0][0] == "de"
    assert language.learn_and_identify(make([])).collect() == []
    assert [r["lang_pred"] for r in language.learn_and_identify(make([(1, "a b", None)])).collect()] == ["und"]


# ---- quality ----


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op5_quality_classifier"](spark, sf).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id").quality
    assert all(got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index])
    held = got[got.held_out].join(labels, how="inner")
    assert (held.predicted == held.quality).mean() >= 0.93
    assert got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()


def test_labels_of_held_out_rows_are_not_read(spark, make):
    rows = [(n, "good words in a row " * 5 if n % 2 else "%% $$ && ## " * 9) for n in range(200)]
    labels = [(n, n % 2) for n in range(200)]
    flipped = [(n, q if zlib.crc32(str(n).encode()) % 4 != 2 else 1 - q) for n, q in labels]
    a, b = (quality.fit(make(rows), spark.createDataFrame(x, "doc_id long, quality int"), quality.learnable()) for x in (labels, flipped))
    assert a["shift"] == b["shift"] and all(np.array_equal(x[k], y[k]) for x, y in zip(a["networks"], b["networks"], strict=True) for k in x)


def test_quality_without_any_negative_label(spark):
    """Rows of label 0 change nothing: prior and scores come from positives and unlabelled text."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    all_, ones = (quality.fit(docs, x, quality.learnable()) for x in (labels, labels.filter("quality = 1")))
    assert all_["shift"] == ones["shift"] and all(np.array_equal(x[k], y[k]) for x, y in zip(all_["networks"], ones["networks"], strict=True) for k in x)


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.86])
def test_the_class_prior_is_estimated(prior):
    rng = np.random.default_rng(4)
    good, bad = (lambda n: rng.normal(0, 1, (n, 6))), (lambda n: rng.normal(0, 1, (n, 6)) + [3, 2, 0, 0, 0, 0])
    n = int(3000 * prior)
    found = quality.class_prior(good(2000), rng.permutation(np.concatenate([good(n), bad(3000 - n)])))
    assert abs(found - prior) < 0.06


def test_one_row_of_an_id_is_learned_from(spark, make):
    rows = [(n, "good words in a row " * (1 + n % 5) if n % 2 else "%% $$ && ## " * 9) for n in range(200)]
    labels = spark.createDataFrame([(n, n % 2) for n in range(200)], "doc_id long, quality int")
    hot = next(n for n in range(1, 200, 2) if zlib.crc32(str(n).encode()) % 4 != 2)
    a, b = (quality.fit(make(x), labels, quality.learnable()) for x in (rows, rows + [rows[hot]] * 400))
    assert a["shift"] == b["shift"]


def test_quality_of_odd_texts(spark, make, edge):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = [tuple(r) for r in quality.learn_and_score(make(edge), none).collect()]
    assert len(got) == len(edge) and {(g[2], g[3]) for g in got} == {(0.5, 0)}
    labels = spark.createDataFrame([(4, 1), (6, None), (99, 0), (1, 1)], "doc_id long, quality int")
    assert len(quality.learn_and_score(make(edge), labels).collect()) == len(edge)
    assert quality.learn_and_score(make([]), labels).collect() == []
    docs = make(edge)
    assert quality.keep_good(docs, None).count() == len(edge)
    model = quality.fit(docs, labels, quality.learnable())
    assert quality.keep_good(docs, model).columns == docs.columns


# ---- pipeline and queries ----


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        after = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert all(before[i] == r for i, r in after.items()) and 0.7 * len(before) <= len(after), name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == set(after)


def test_pipeline_on_nothing(spark, make):
    docs = make([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


NATIVE = ("op2_", "op4_", "op6_", "op7_", "op10_")


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(NATIVE)])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_ids_equal_the_library_for_every_white_space(library):
    """Runs of up to six spaces of every kind, between, before and after words."""
    tokens, rng = packing.Tokens(), random.Random(21)
    spaces = [c for c in map(chr, range(0x3001)) if c.isspace()]
    assert set(packing.SPACES) <= set(spaces)
    texts = [" \xa0 \xa0", "\xa0 a", " \u3000", "a \n b"]
    for _ in range(6000):
        kinds = [" ", *rng.sample(spaces, 2)]
        texts.append("".join(rng.choice(["a", "word", "\u00e9", "1", ".", ""]) + "".join(rng.choice(kinds) for _ in range(rng.randint(0, 6))) for _ in range(4)))
    for text in texts:
        assert np.frombuffer(tokens.ids(text), np.uint16).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
