"""Quality of texts, learned from trusted positives and unlabelled text.

A few small networks over the shape of a text are trained by the non-negative unbiased risk of positive-unlabelled learning: the
risk of unlabelled text as negatives, less the share of positives in it (the class prior), is kept from falling below zero.
The prior is estimated from positives and unlabelled text (`class_prior`); labels of negatives are never read. The mean
of the networks is then shifted so that `THRESHOLD` lies in the widest gap that the scores of the unlabelled sample leave near this share:
that suits text in two clusters; elsewhere the threshold accepts about the estimated share.

Training reads at most `SAMPLE` positives and `SAMPLE` unlabelled documents, chosen by a hash of their id, one row of each id; scoring reads
every whole text, in small Arrow batches. Inputs of a score are the bytes of the text alone.

Nulls and repeats: a null text is empty and gets the score of an empty text; rows with a null id are scored and never learned from;
repeated rows give equal rows. Without positives every score is 0.5; a sample of fewer than four texts
counts as a prior of 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import id_text, packed, small_batches, unpacked
from runlens.llm.language import fold

SAMPLE = 4000
THRESHOLD = 0.7
NETWORKS, HIDDEN, STEPS, BATCH, RATE = 3, 24, 1500, 256, 0.005
CONFIDENCE = 0.1


def _mask(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_CLASSES = np.stack([_mask(bytes(range(65, 91))), _mask(bytes(range(97, 123))), _mask(bytes(range(48, 58))), _mask(b" "), _mask(b"\n"),
                     _mask(b".,;:'\"()-"), _mask(b"!?"), _mask(b"#$%&*+/<=>@[\\]^_`{|}~"), _mask(bytes(range(128, 256)))], axis=1)


def features(text: str) -> np.ndarray:
    """Shares of byte classes, repetition of words and lines, length of words and text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(1, len(raw))
    classes = np.bincount(raw, minlength=256) @ _CLASSES / n
    words, lines = text.split(), text.split("\n")
    w = max(1, len(words))
    shape = [len(set(words)) / w, sum(map(eq, words, words[1:])) / w, len(set(lines)) / max(1, len(lines)), min(n / w, 40) / 10, np.log1p(n) / 10]
    return np.concatenate([np.sqrt(classes), shape])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _network(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int, seed: int) -> dict:
    """Non-negative unbiased risk with the logistic loss, by Adam; without a prior, the plain risk of telling the samples apart."""
    rng = np.random.default_rng(seed)
    mean, std = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    xp, xu = (positive - mean) / std, (unlabelled - mean) / std
    p = {"w1": rng.normal(0, xu.shape[1] ** -0.5, (xu.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": rng.normal(0, 0.2, HIDDEN), "b2": np.zeros(1)}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    for step in range(1, steps + 1):
        a, b = xp[rng.integers(0, len(xp), BATCH)], xu[rng.integers(0, len(xu), BATCH)]
        x = np.concatenate([a, b])
        h = np.maximum(x @ p["w1"] + p["b1"], 0)
        z = h @ p["w2"] + p["b2"]
        s = _sigmoid(z)
        # loss as a positive: log(1 + exp(-z)); as a negative: log(1 + exp(z))
        negative_risk = np.logaddexp(0, z[BATCH:]).mean() - (prior or 0) * np.logaddexp(0, z[:BATCH]).mean()
        as_positive, as_negative_p, as_negative_u = (s[:BATCH] - 1) / BATCH, s[:BATCH] / BATCH, s[BATCH:] / BATCH
        if prior is None:  # tell the two samples apart
            g = np.concatenate([as_positive, as_negative_u])
        elif negative_risk >= 0:
            g = np.concatenate([prior * as_positive - prior * as_negative_p, as_negative_u])
        else:  # go back up where the estimate fell below zero
            g = np.concatenate([prior * as_negative_p, -as_negative_u])
        gh = np.outer(g, p["w2"]) * (h > 0)
        grads = {"w2": h.T @ g, "b2": np.array([g.sum()]), "w1": x.T @ gh + 1e-4 * p["w1"], "b1": gh.sum(0)}
        rate = RATE * (1 - step / (steps + 1))
        for k, d in grads.items():
            m, v = moments[k]
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            p[k] = p[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p | {"mean": mean, "std": std}


def _raw(model: dict, x: np.ndarray) -> np.ndarray:
    h = np.maximum((x - model["mean"]) / model["std"] @ model["w1"] + model["b1"], 0)
    return h @ model["w2"] + model["b2"]


def logits(model: dict, x: np.ndarray) -> np.ndarray:
    return np.mean([_raw(m, x) for m in model["networks"]], axis=0) + model["shift"]


def _gap(scores: np.ndarray, share: float) -> float | None:
    """Middle of the widest gap, passed over by one score in a hundred, where about `share` of all scores lie below."""
    ordered, over = np.sort(scores), max(1, len(scores) // 100)
    low, high = int(0.5 * share * len(scores)), int(1.3 * share * len(scores))
    if high <= low or high + over > len(scores):
        return None
    at = low + int((ordered[low + over:high + over] - ordered[low:high]).argmax())
    return float(ordered[at] + ordered[at + over]) / 2


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS, seed: int = 5) -> float:
    """Share of positives in unlabelled text, from two samples without a label of a negative.

    Above any score lie at least as many of the unlabelled as the positives' share of all times the share of positives there. So the
    least ratio of the two shares bounds the prior, and meets it where few negatives score as high. Scores are those of a network that tells
    the samples apart, each half scored by the network of the other half; the score is chosen with what chance may do to both shares.
    """
    if min(len(positive), len(unlabelled)) < 4:
        return 0.5
    found = []
    for half in (0, 1):
        model = _network(positive[half::2], unlabelled[half::2], None, steps, seed + half)
        p, u = (np.sort(_raw(model, x[1 - half::2])) for x in (positive, unlabelled))
        above_p = np.arange(len(p), 0, -1) / len(p)
        above_u = 1 - np.searchsorted(u, p) / len(u)
        chance = np.sqrt(np.log(4 / CONFIDENCE) / 2 / len(p)) + np.sqrt(np.log(4 / CONFIDENCE) / 2 / len(u))
        best = ((above_u + chance) / above_p).argmin()
        found.append(above_u[best] / above_p[best])
    return float(np.clip(np.mean(found), 0.01, 0.99))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, seed: int = 5) -> dict:
    model = {"networks": [_network(positive, unlabelled, prior, steps, seed + n) for n in range(NETWORKS)], "shift": 0.0}
    gap = _gap(logits(model, unlabelled), 1 - prior)
    if gap is not None:
        model["shift"] = float(np.log(THRESHOLD / (1 - THRESHOLD))) - gap
    return model


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = SAMPLE) -> dict | None:
    """Model from rows for which `learn`, an expression over the id column, holds; None without any positive."""
    def first(df: DataFrame) -> DataFrame:
        return df.orderBy(F.xxhash64("_id"), "_id").limit(sample)

    ids = docs.filter(learn).select(F.col(f"`{id_col}`").alias("_id")).filter("_id IS NOT NULL")
    told = labels.filter(learn).filter(F.col(f"`{label_col}`") == 1).select(F.col(f"`{id_col}`").alias("_id")).distinct()
    # both samples are bounded, and fetched by one scan
    chosen = first(told.join(ids, "_id", "left_semi")).withColumn("_part", F.lit("p")).unionByName(
        first(ids.distinct()).withColumn("_part", F.lit("u")))
    texts = id_text(docs.filter(learn), id_col, text_col).join(F.broadcast(chosen), "_id")
    small_batches(docs.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = [features(t).astype(np.float32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array(rows, pa.binary())], names=["part", "id", "x"])

    kind = dict(texts.dtypes)["_id"]
    rows = texts.select("_id", "_text", "_part").mapInArrow(batches, f"part string, id {kind}, x binary")
    # an id may have any number of rows: one of them, the least, reaches the driver
    found = rows.groupBy("part", "id").agg(F.min("x").alias("x")).collect()
    if not any(r["part"] == "p" for r in found):
        return None
    found.sort(key=lambda r: (r["part"], r["id"]))
    part = {k: np.stack([np.frombuffer(r["x"], np.float32) for r in found if r["part"] == k]).astype(np.float64) for k in "pu"}
    return train(part["p"], part["u"], class_prior(part["p"], part["u"]))


def _scores(model: dict | None, texts: list[str]) -> np.ndarray:
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    return _sigmoid(logits(model, np.stack([features(t) for t in texts])))


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score, predicted (1 from `THRESHOLD` on)."""
    small_batches(docs.sparkSession)
    rows = id_text(docs, id_col, text_col)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            s = _scores(model, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array(s >= THRESHOLD, pa.bool_()).cast(pa.int32())],
                                             names=[id_col, "score", "predicted"])

    return rows.mapInArrow(batches, f"`{id_col}` {dict(rows.dtypes)['_id']}, score double, predicted int")


def learnable(id_col: str = "doc_id", folds: int = 4, held: int = 2) -> Column:
    return F.coalesce(fold(F.col(f"`{id_col}`"), folds) != held, F.lit(False))


def learn_and_score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Learns from the folds that are not held out, and scores every row: id, held_out, score, predicted."""
    told = score(docs, fit(docs, labels, learnable(id_col), id_col, text_col, label_col), id_col, text_col)
    held = F.coalesce(fold(F.col(f"`{id_col}`"), 4) == 2, F.lit(False))
    return told.select(id_col, held.alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score at least `THRESHOLD`, with all their columns. Without a model all stay."""
    if model is None:
        return docs
    small_batches(docs.sparkSession)
    rows = packed(docs, id_col, text_col).select("_row", "_text")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            good = _scores(model, batch.column(1).to_pylist()) >= THRESHOLD
            kept = batch.filter(pa.array(good, pa.bool_()))
            if kept.num_rows:
                yield kept.select(["_row"])

    return unpacked(rows.mapInArrow(batches, rows.select("_row").schema))
