"""Quality by positive-unlabelled learning.

A small network is fitted to trusted positives and to unlabelled documents by minimising the non-negative
unbiased risk (Kiryo et al., 2017). The class prior comes first: a classifier of positives against
unlabelled rows is fitted on one half, and on the other half the prior is the least ratio, over thresholds
and with a confidence margin, of the shares of both samples above (best bin estimation, Garg et al., 2021).
Labels other than the trusted positives are not used, and no id, language or source is a feature.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import bounded
from siltstone.llm.labelled import SAMPLE_ROWS, drawn, held_out, training_labels

#: Ids of the held-out part, and the score from which a document counts as good.
PARTS, PART, LEAST_SCORE = 4, 2, 0.7
HIDDEN, STEPS, RATE, SEED = 16, 900, 0.02, 7
N_FEATURES = 17
BATCH_ROWS = 512

_CLASSES = np.zeros((256, 8))
for _i, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:'\"()-", b"!?", b"#$%&*+/<=>@[\\]^_`{|}~", b"\n", bytes(range(128, 256)))):
    _CLASSES[list(_bytes), _i] = 1


def features(text: str) -> list[float]:
    """Shape of a whole text: sizes, shares of character classes, and how much of it repeats. Of an empty text all are 0 but the share of
    distinct lines, the rate of distinct words and the mark of a text without words."""
    raw = text.encode()
    words = text.split()
    n, nw = max(len(raw), 1), max(len(words), 1)
    share = (np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES / n).tolist()
    letters = max(share[0] + share[1] + share[7], 1e-9)
    repeats = sum(map(operator.eq, words, words[1:])) / nw
    distinct = len(set(words))
    lines = text.split("\n")
    marks = share[4] + share[5]
    return [
        np.log1p(len(words)) / 5, min(n / nw, 30) / 10, share[0] / letters, *(share[i] for i in (2, 3, 6, 7)), min(marks * n / nw, 3), min(share[4] * n / nw, 3), min(share[5] * n / nw, 3),
        repeats, distinct / nw, np.log1p(distinct) / max(np.log1p(len(words)), 1e-9), len(set(lines)) / len(lines), min(share[3] * n / nw, 3), float(share[0] > 0), float(not words),
    ]


@dataclass(frozen=True)
class Model:
    """Standardising constants, the network's weights, and the prior it was fitted with."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w1 + self.b1) @ self.w2 + self.b2
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(pos: np.ndarray, unl: np.ndarray, prior: float | None) -> Model:
    """prior None: plain positives against unlabelled; else the non-negative risk with the logistic loss."""
    rng = np.random.default_rng(SEED)
    both = np.vstack([pos, unl])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    x = np.clip((both - mean) / scale, -8, 8)
    n = len(pos)
    p = [rng.normal(0, 0.4, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.4, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    is_pos = np.arange(len(x)) < n
    for step in range(1, STEPS + 1):
        h = np.tanh(x @ p[0] + p[1])
        z = np.clip(h @ p[2] + p[3], -30, 30)
        s = 1 / (1 + np.exp(-z))
        if prior is None:
            g = np.where(is_pos, (s - 1) / n, s / len(unl))
        else:
            loss = np.log1p(np.exp(z))
            negative = loss[n:].mean() - prior * loss[:n].mean()
            if negative >= 0:
                g = np.where(is_pos, prior * (s - 1) / n - prior * s / n, s / len(unl))
            else:  # the step back that keeps the negative risk from going below 0
                g = np.where(is_pos, prior * s / n, -s / len(unl))
        gh = np.outer(g, p[2]) * (1 - h * h)
        grads = [x.T @ gh + 1e-4 * p[0], gh.sum(0), h.T @ g + 1e-4 * p[2], g.sum(keepdims=True)]
        for a, grad, m_, v_ in zip(p, grads, m, v):
            m_ += 0.1 * (grad - m_)
            v_ += 0.001 * (grad * grad - v_)
            a -= RATE * (m_ / (1 - 0.9**step)) / (np.sqrt(v_ / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, p[0], p[1], p[2], float(p[3][0]), prior if prior is not None else 0.0)


def estimated_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives in the unlabelled rows, from 0.05 to 0.99."""
    half = _fit(pos[::2], unl[::2], None)
    sp, su = np.sort(half.score(pos[1::2])), np.sort(half.score(unl[1::2]))
    cuts = np.unique(np.quantile(sp, np.linspace(0, 0.9, 91)))
    above = lambda s: 1 - np.searchsorted(s, cuts) / len(s)
    margin = lambda k: np.sqrt(np.log(4 / 0.1) / (2 * k))
    ratio = (above(su) + margin(len(su)) + margin(len(sp))) / np.maximum(above(sp), 1e-9)
    best = int(np.argmin(ratio))
    return float(np.clip(above(su)[best] / above(sp)[best], 0.05, 0.99))


def _sample(docs: DataFrame, ids: DataFrame, rows: int) -> np.ndarray:
    """Features of a sample's whole texts, found by the executors, in the order of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    sample = drawn(docs, ids, rows)
    got = sample.select("doc_id", "text").mapInArrow(run, f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, x array<double>")
    return np.array([r["x"] for r in got.orderBy("doc_id").collect()], float).reshape(-1, N_FEATURES)


def fit_quality(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fits on at most sample_rows positives and as many unlabelled documents. None if there are under 8 of either."""
    pos = _sample(docs, training_labels(labels, "quality", PARTS, PART).where("y = 1"), sample_rows)
    unl = _sample(docs, docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.lit(0).alias("y")), sample_rows)
    return _fit(pos, unl, estimated_prior(pos, unl)) if min(len(pos), len(unl)) >= 8 else None


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of each row; without a model 0.5. A null text is empty; an empty text gets the score of its (zero) features.
    Rows are scored by themselves: repeated ids, null ids and empty tables need no rule; only doc_id and text are read."""
    kind = next(f.dataType.simpleString() for f in docs.schema if f.name == "doc_id")
    if model is None:
        return docs.select("doc_id", F.lit(0.5).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 1, BATCH_ROWS):
            x = np.array([features(t or "") for t in batch.column(1).to_pylist()]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs."""
    scored = score_documents(docs, fit_quality(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id"), PARTS, PART).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score LEAST_SCORE at least, with all their columns and no shuffle. Without documents there is
    nothing to keep; documents without enough labels to fit on are an error, as keeping all or none of them would be a guess."""
    model = fit_quality(docs, labels)
    if model is None:
        if docs.isEmpty():
            return docs
        raise ValueError("quality: at least 8 documents labelled 1 outside the held-out part, and 8 in all, are needed to fit")
    schema, names = docs.schema, docs.columns
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, place, BATCH_ROWS):
            x = np.array([features(t or "") for t in batch.column(place).to_pylist()]).reshape(-1, N_FEATURES)
            yield batch.filter(pa.array(model.score(x) >= LEAST_SCORE))

    return docs.mapInArrow(run, schema)
