"""Language of a text by a small convolutional network over bytes.

Bytes of the lower-cased text are embedded, filters of several widths slide over windows of fixed length, each filter's largest value
in a window goes to a softmax layer, and a document's answer is the mean over all its windows, weighted by their bytes. The network
is trained in numpy on a bounded sample: at most `DOCS_PER_LANGUAGE` labelled documents of each language, one row of each, `WINDOWS_PER_DOC`
windows of each, and at most `MAX_LANGUAGES` languages (more raise an error). It is then applied to every window of every whole text.

For speed a trained filter becomes tables over pairs of bytes; sums of table rows equal the convolution.

Nulls: a null text, or one without a letter, is `und` with score 0. Rows without a language teach nothing; if no row
teaches, every text is `und`. Repeated rows give equal rows. Only id, text and (to learn) lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import id_text, small_batches

WINDOW = 256
WIDTHS, FILTERS, EMBEDDED = (2, 3, 4), 16, 8
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC, MAX_LANGUAGES = 1000, 4, 200
STEPS, BATCH, RATE = 1200, 64, 0.004
UNKNOWN = "und"


def fold(id_: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.crc32(id_.cast("string").cast("binary")) % folds


def _sampled_ids(able: DataFrame, per_language: int, max_languages: int) -> DataFrame:
    """(_id, _lang) of the ids with the least hashes of each language, at most `per_language` of each.

    A share of the hashes that holds about twice as many is cut first, where the rows lie, so that the ranking meets a few thousand ids
    of a language however many rows it has. The ids are counted apart from their repeats.
    """
    sizes = able.groupBy("_lang").agg(F.approx_count_distinct("_id").alias("_ids"))
    found = sizes.limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages to learn; pass a larger max_languages")
    known = able.sparkSession.createDataFrame(found, sizes.schema)
    place = F.xxhash64("_id") / F.lit(2.0**64) + 0.5
    least = able.join(F.broadcast(known), "_lang").filter(place * F.col("_ids") <= 2 * per_language).select("_id", "_lang").distinct()
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id")
    return least.withColumn("_nr", F.row_number().over(order)).filter(F.col("_nr") <= per_language).drop("_nr")


def training_windows(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     per_language: int = DOCS_PER_LANGUAGE, per_doc: int = WINDOWS_PER_DOC,
                     max_languages: int = MAX_LANGUAGES) -> list[tuple[str, str]]:
    """(lang, text of a window) of the sampled documents: at most max_languages * per_language * per_doc windows.

    Of rows that share id and language the one whose text has the least hash teaches, so that repeats reach neither driver nor weights.
    """
    rows = docs.filter(learn).select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{lang_col}`").alias("_lang"), F.col(f"`{text_col}`").alias("_text"))
    rows = rows.filter("_id IS NOT NULL AND _lang IS NOT NULL")
    chosen = _sampled_ids(rows.select("_id", "_lang"), per_language, max_languages)
    texts = rows.join(F.broadcast(chosen), ["_id", "_lang"], "left_semi").filter("length(_text) > 0")
    spread = F.transform(F.sequence(F.lit(0), F.lit(per_doc - 1)), lambda j: F.col("_text").substr(
        (F.floor(F.char_length("_text") * j / per_doc) + 1).cast("int"), F.lit(WINDOW)))
    one = texts.select("_id", "_lang", F.struct(F.xxhash64("_text").alias("h"), spread.alias("w")).alias("_w")).groupBy("_id", "_lang").agg(F.min("_w").alias("_w"))
    return [(r["_lang"], w) for r in one.select("_id", "_lang", "_w.w").sort("_id", "_lang").collect() for w in r["w"] if w]


def to_windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (n, WINDOW), the text each window belongs to, and its number of bytes."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    counts = [max(1, -(-len(r) // WINDOW)) for r in raw]
    joined = b"".join(r.ljust(c * WINDOW, b"\0") for r, c in zip(raw, counts, strict=True))
    owner = np.repeat(np.arange(len(raw)), counts)
    start = np.arange(len(owner)) - np.repeat(np.cumsum([0, *counts[:-1]]), counts)
    size = np.minimum(WINDOW, np.repeat([len(r) for r in raw], counts) - start * WINDOW)
    return np.frombuffer(joined, np.uint8).reshape(-1, WINDOW), owner, size


def _columns(x: np.ndarray, width: int) -> np.ndarray:
    steps = x.shape[1] - width + 1
    return np.concatenate([x[:, j:j + steps] for j in range(width)], axis=2)


def train(labelled: list[tuple[str, str]], steps: int = STEPS, seed: int = 7) -> dict:
    """Weights of the network, by Adam on balanced batches; all languages weigh the same."""
    names = sorted({lang for lang, _ in labelled})
    rng = np.random.default_rng(seed)
    texts = [t for _, t in labelled]
    data = np.stack([to_windows([t])[0][0] for t in texts]) if texts else np.zeros((0, WINDOW), np.uint8)
    of = np.array([names.index(lang) for lang, _ in labelled], int)
    groups = [np.flatnonzero(of == c) for c in range(len(names))]
    p = {"embed": rng.normal(0, 0.5, (256, EMBEDDED)), "out": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, max(1, len(names)))),
         "bias": np.zeros(max(1, len(names)))}
    for w in WIDTHS:
        p[f"w{w}"] = rng.normal(0, (2 / (w * EMBEDDED)) ** 0.5, (w * EMBEDDED, FILTERS))
        p[f"b{w}"] = np.zeros(FILTERS)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    for step in range(1, steps + 1 if len(names) > 1 else 1):
        want = rng.integers(0, len(names), BATCH)
        rows = data[[rng.choice(groups[c]) for c in want]]
        x = p["embed"][rows]
        pooled, best, cols = [], {}, {}
        for w in WIDTHS:
            cols[w] = _columns(x, w)
            z = cols[w] @ p[f"w{w}"] + p[f"b{w}"]
            best[w] = z.argmax(1)
            pooled.append(np.take_along_axis(z, best[w][:, None], 1)[:, 0])
        h = np.concatenate(pooled, 1)
        active = np.maximum(h, 0)
        logits = active @ p["out"] + p["bias"]
        prob = np.exp(logits - logits.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        prob[np.arange(BATCH), want] -= 1
        prob /= BATCH
        grads = {"out": active.T @ prob, "bias": prob.sum(0), "embed": np.zeros_like(p["embed"])}
        back = (prob @ p["out"].T) * (h > 0)
        for n, w in enumerate(WIDTHS):
            g = back[:, n * FILTERS:(n + 1) * FILTERS]
            picked = np.take_along_axis(cols[w], best[w][:, :, None], 1)  # (batch, filter, width * embedded)
            grads[f"w{w}"] = np.einsum("bf,bfk->kf", g, picked)
            grads[f"b{w}"] = g.sum(0)
            to_x = (g[:, :, None] * p[f"w{w}"].T[None]).reshape(BATCH, FILTERS, w, EMBEDDED)
            for j in range(w):
                np.add.at(grads["embed"], np.take_along_axis(rows, best[w] + j, 1), to_x[:, :, j])
        rate = RATE * (1 - step / (steps + 1))
        for k, g in grads.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return {"names": names, **p}


class Network:
    """A trained network as tables over pairs of bytes."""

    def __init__(self, model: dict):
        self.model, self.tables = model, {}
        for w in WIDTHS:
            part = [model["embed"] @ model[f"w{w}"][j * EMBEDDED:(j + 1) * EMBEDDED] for j in range(w)]
            pairs = [(part[j][:, None] + part[j + 1][None]).reshape(-1, FILTERS) for j in range(0, w - 1, 2)]
            self.tables[w] = ([np.ascontiguousarray(t, np.float32) for t in pairs], part[-1] if w % 2 else None)

    def probabilities(self, windows: np.ndarray, chunk: int = 64) -> np.ndarray:
        out = np.empty((len(windows), len(self.model["names"])), np.float32)
        for at in range(0, len(windows), chunk):
            b = windows[at:at + chunk]
            pair = (b[:, :-1].astype(np.int64) << 8) | b[:, 1:]
            pooled = []
            for w in WIDTHS:
                steps, (pairs, single) = WINDOW - w + 1, self.tables[w]
                z = pairs[0].take(pair[:, :steps], axis=0)
                for n, t in enumerate(pairs[1:], 1):
                    z += t.take(pair[:, 2 * n:2 * n + steps], axis=0)
                if single is not None:
                    z += single.take(b[:, w - 1:w - 1 + steps], axis=0)
                pooled.append(z.max(axis=1) + self.model[f"b{w}"])
            logits = np.maximum(np.concatenate(pooled, 1), 0) @ self.model["out"] + self.model["bias"]
            e = np.exp(logits - logits.max(1, keepdims=True))
            out[at:at + chunk] = e / e.sum(1, keepdims=True)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        has_letter = [any(c.isalpha() for c in t) for t in texts]
        if not self.model["names"] or not texts:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        windows, owner, size = to_windows(texts)
        total = np.zeros((len(texts), len(self.model["names"])))
        np.add.at(total, owner, self.probabilities(windows) * size[:, None])
        mean = total / np.maximum(np.bincount(owner, size, len(texts)), 1)[:, None]
        best = mean.argmax(1)
        return ([self.model["names"][b] if ok else UNKNOWN for b, ok in zip(best, has_letter, strict=True)],
                [min(1.0, float(mean[i, b])) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, has_letter, strict=True))])


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score."""
    small_batches(docs.sparkSession)
    rows = id_text(docs, id_col, text_col)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(model)
        for batch in source:
            names, scores = network.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[id_col, "lang_pred", "score"])

    return rows.mapInArrow(batches, f"`{id_col}` {dict(rows.dtypes)['_id']}, lang_pred string, score double")


def learn_and_identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5,
                       held: int = 0) -> DataFrame:
    """Learns from all folds but `held`, and answers for every row: id, held_out, lang_pred, score."""
    out_of = fold(F.col(f"`{id_col}`"), folds) == held
    model = train(training_windows(docs, ~F.coalesce(out_of, F.lit(False)), id_col, text_col, lang_col))
    told = identify(docs, model, id_col, text_col)
    return told.select(id_col, F.coalesce(fold(F.col(f"`{id_col}`"), folds) == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
