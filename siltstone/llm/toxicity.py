"""Toxicity by multiple-instance learning: a document is a bag of sentences.

A sentence's evidence comes from the lexical features that it holds: p = 1 - (1 - s(b + w)) / (1 - s(b)) for the logistic s, the
bias b and the sum w of its weights, so a sentence without weighted features has p = 0. The document's probability is
their noisy-or with a leak for what no sentence shows, 1 - (1 - leak) * prod(1 - p); it doesn't grow with sentences
that show nothing. Weights, bias and leak are fitted to document labels alone by the likelihood, with an L1 step that
leaves few features. The same weights then point at the sentences that offend.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import bounded
from siltstone.llm.labelled import SAMPLE_ROWS, drawn, held_out, training_labels

PARTS, PART, LEAST_SCORE = 3, 1, 0.7
#: Features kept for fitting, documents of either label that must hold one, steps, step size and the L1 weight.
MOST_FEATURES, LEAST_DOCUMENTS, STEPS, RATE, L1 = 4000, 4, 250, 0.1, 0.008
#: A sentence below this probability counts as 0, so that many weak hints in a long text don't add up.
FLOOR = 0.1
BEGINNINGS = (3, 4, 5, 6, 7)
BATCH_ROWS, COUNTED_AT_ONCE = 512, 300_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def _parts(word: str) -> tuple[str, ...]:
    """A word stands for itself and for its beginnings of 3 to 7 letters."""
    return (word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k))


def _softplus(z: np.ndarray | float) -> np.ndarray | float:
    return np.logaddexp(0, z)


@dataclass(frozen=True)
class Model:
    bias: float
    leak: float
    weights: dict[str, float]

    def word_weights(self, words: set[str]) -> dict[str, float]:
        get = self.weights.get
        found = {}
        for w in words:
            x = get(w, 0.0)
            for k in BEGINNINGS:
                if len(w) > k:
                    x += get(w[:k] + "*", 0.0)
            if x:
                found[w] = x
        return found

    def judged(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The score of a whole text, and (start, end, probability) of each sentence with evidence of FLOOR or more."""
        low = text.lower()
        if len(low) != len(text):  # a few letters become two in lower case; places are those of the text
            low = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
        known = self.word_weights(set(_WORD.findall(low)))
        log_none, spans, base = np.log1p(-self.leak), [], _softplus(self.bias)
        if known:
            hit = known.keys()
            for m in _SENTENCE.finditer(low):
                if met := hit & set(_WORD.findall(m.group())):
                    less = _softplus(self.bias + sum(known[w] for w in sorted(met))) - base
                    p = float(-np.expm1(-less))
                    if p >= FLOOR:
                        log_none -= less
                        spans.append((m.start(), m.end(), p))
        return float(-np.expm1(log_none)), spans


def _features(sample: DataFrame) -> list[str]:
    """Features that many toxic documents have and few others, the most telling first. Executors count whole texts document
    by document; only features that pass, MOST_FEATURES at most, come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            batch = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[f] for f in names], pa.int64()) for c in counts)], ["feature", "clean", "toxic"])
            counts[0].clear(), counts[1].clear()
            return batch

        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[y].update({p for w in set(_WORD.findall(t.lower())) for p in _parts(w)})
                if len(counts[0]) + len(counts[1]) > COUNTED_AT_ONCE:
                    yield out()
        yield out()

    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n0, n1 = float(sizes[0]), float(sizes[1])
    least = max(LEAST_DOCUMENTS, int(n1) // 200)
    c = sample.select("y", "text").mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    c = c.where((F.col("t") >= least) & (F.col("t") / n1 > 4 * (F.col("c") + 1) / n0))
    gain = F.col("t") * F.log((F.col("t") / n1) / ((F.col("c") + 0.5) / n0))
    return [r["feature"] for r in c.select("feature", gain.alias("g")).orderBy(F.desc("g"), "feature").limit(MOST_FEATURES).collect()]


def _bags(sample: DataFrame, names: list[str]) -> list[tuple[int, list[tuple[list[int], int]]]]:
    """(y, [(features, sentences that hold just these)]) of each document, by id."""
    at = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("f", pa.list_(pa.int32())), ("n", pa.int64())]))
        for batch in batches:
            rows = []
            for t in batch.column(2).to_pylist():
                bag = Counter(tuple(sorted({at[p] for w in set(_WORD.findall(s)) for p in _parts(w) if p in at})) for s in _SENTENCE.findall(t.lower()))
                rows.append([{"f": list(f), "n": n} for f, n in sorted(bag.items()) if f])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, kind)], ["doc_id", "y", "bag"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    got = sample.select("doc_id", "y", "text").mapInArrow(run, f"doc_id {kind}, y int, bag array<struct<f:array<int>,n:bigint>>")
    return [(r["y"], [(x["f"], x["n"]) for x in r["bag"]]) for r in got.orderBy("doc_id").collect()]


def _fit(names: list[str], rows: list[tuple[int, list[tuple[list[int], int]]]]) -> Model:
    y = np.array([v for v, _ in rows])
    n1, n0 = int(y.sum()), int((1 - y).sum())
    doc = np.array([d for d, (_, bag) in enumerate(rows) for _ in bag], int)
    times = np.array([n for _, bag in rows for _, n in bag], float)
    sent = np.repeat(np.arange(len(doc)), [len(f) for _, bag in rows for f, _ in bag])
    feat = np.array([i for _, bag in rows for f, _ in bag for i in f], int)
    w, b, a = np.full(len(names), 0.5), -5.0, -4.0
    weight = np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * n0)) / len(y)
    p = np.concatenate([w, [b, a]])
    m, v = np.zeros_like(p), np.zeros_like(p)
    logistic = lambda z: 1 / (1 + np.exp(-z))
    for step in range(1, STEPS + 1):
        w, b, a = p[:-2], p[-2], p[-1]
        z = np.clip(b + np.bincount(sent, w[feat], minlength=len(doc)), -30, 30)
        none = np.exp(-_softplus(a) - np.bincount(doc, times * (_softplus(z) - _softplus(b)), minlength=len(y)))
        pull = np.where(y == 1, -none / np.maximum(1 - none, 1e-9), 1.0) * weight
        s = logistic(z)
        g = times * pull[doc]
        grad = np.concatenate([np.bincount(feat, (g * s)[sent], minlength=len(w)), [(g * (s - logistic(b))).sum(), logistic(a) * pull.sum()]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        p = p - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        p[:-2] = np.maximum(p[:-2] - RATE * L1 * 10, 0)
        p[-1] = min(p[-1], -2.0)  # without any evidence a text stays below 0.12
    return Model(float(p[-2]), float(logistic(p[-1])), {f: float(x) for f, x in zip(names, p[:-2]) if x > 0.05})


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fits on at most sample_rows documents of each label outside the held-out part, whole texts of any length; None without both labels."""
    y = training_labels(labels, "toxic", PARTS, PART)
    sample = drawn(docs, y.where("y = 1"), sample_rows).unionByName(drawn(docs, y.where("y = 0"), sample_rows))
    if {r["y"] for r in sample.select("y").distinct().collect()} != {0, 1}:
        return None
    names = _features(sample)
    return _fit(names, _bags(sample, names))


def judge_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score and spans of each row: (start, end, score) in code points of the sentences with evidence.

    A null or empty text has no sentence and scores the leak, as does any text without evidence, however long; without a
    model all score 0. Rows are scored by themselves: repeated ids, null ids and empty tables need no rule; only doc_id and text are read."""
    kind = next(f.dataType.simpleString() for f in docs.schema if f.name == "doc_id")
    ddl = "array<struct<start:int,end:int,score:double>>"
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.array().cast(ddl).alias("spans"))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 1, BATCH_ROWS):
            got = [model.judged(t or "") for t in batch.column(1).to_pylist()]
            rows = [[{"start": a, "end": b, "score": p} for a, b, p in spans] for _, spans in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for s, _ in got], pa.float64()), pa.array(rows, span)], ["doc_id", "score", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, spans {ddl}")


def offending_sentences(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """doc_id and spans of the sentences that score least or more; none without a model."""
    return judge_documents(docs, model).select("doc_id", F.filter("spans", lambda s: s["score"] >= least).alias("spans"))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and sentences (start:end of those with a probability of half or more, comma-joined) of each row of docs."""
    scored = judge_documents(docs, fit_toxicity(docs, labels))
    worst = F.filter("spans", lambda s: s["score"] >= 0.5)
    listed = F.array_join(F.transform(worst, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return scored.select("doc_id", held_out(F.col("doc_id"), PARTS, PART).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"), listed.alias("sentences"))
