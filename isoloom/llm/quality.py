"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text is shared by all grades; ordered thresholds cut its score into grades:
``P(grade > k) = sigmoid(score - threshold_k)``. The expected grade and the tail probability follow, and rows are
selected by the tail.

Text is hashed into byte trigrams and lower-case words, each as a share of the document's trigrams or words; two more
features hold the share of repeated lines and of words equal to the word before.
Null and empty texts have no features and get the probabilities of a score of zero. Ties and repeated rows are scored
alike; an empty table gives an empty result; without any usable label the score is zero and the thresholds are even.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import (
    bounded_sample,
    encoded,
    joined,
    mixed,
    prefix_hashes,
    runs,
    slices,
    span_hashes,
    with_scores,
    words_in,
)

BUCKETS = 2048
WIDTH = 2 * BUCKETS + 2
SAMPLE_BOUND = 4000
STEPS = 250
CLIP = 4.0
CLIP_REPEATS = 20.0
ROWS_AT_ONCE = 256


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, blobs: list[bytes]) -> np.ndarray:
        out = [np.zeros(0)]
        for i in range(0, len(blobs), ROWS_AT_ONCE):
            out.append(_scaled(_matrix(blobs[i : i + ROWS_AT_ONCE]), self.mean, self.scale) @ self.weights)
        return np.concatenate(out)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade > k)`` for each threshold k; falls with k as the thresholds are ordered."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -40, 40)))


def _grams(blobs: list[bytes]):
    """Yields (document, bucket, share) arrays of one slice: trigrams, words, repetition."""
    n = len(blobs)
    data, starts = joined(blobs)
    if len(data) < 3:
        return
    wide = data.astype(np.uint32)
    codes = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D)
    codes = (codes ^ (codes >> np.uint32(15))) * np.uint32(0x27D4EB2F)
    codes = (codes >> np.uint32(21)).astype(np.int64)
    whole = np.flatnonzero((data[:-2] != 0) & (data[1:-1] != 0))
    owner = np.repeat(np.arange(n), np.diff(starts))[whole]
    yield owner, codes[whole], None
    begin, doc, words = words_in(data, starts)
    yield doc, (words >> np.uint64(53)).astype(np.int64) + BUCKETS, None
    same = np.flatnonzero((words[1:] == words[:-1]) & (doc[1:] == doc[:-1])) + 1
    yield doc[same], np.full(len(same), 2 * BUCKETS), np.bincount(doc, minlength=n)
    first, last = runs((data != 10) & (data != 0))
    lines = span_hashes(prefix_hashes(data), first, last)
    line_doc = np.searchsorted(starts, first, side="right") - 1
    key = mixed(lines ^ (line_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, index = np.unique(key, return_index=True)
    again = np.ones(len(key), dtype=bool)
    again[index] = False
    yield line_doc[again], np.full(int(again.sum()), 2 * BUCKETS + 1), np.bincount(line_doc, minlength=n)


def _matrix(blobs: list[bytes]) -> np.ndarray:
    out = np.zeros((len(blobs), WIDTH), dtype=np.float32)
    for a, b in slices([len(x) for x in blobs]):
        for doc, bucket, totals in _grams(blobs[a:b]):
            total = np.bincount(doc, minlength=b - a) if totals is None else totals
            counts = np.bincount(doc * WIDTH + bucket, minlength=(b - a) * WIDTH).reshape(b - a, WIDTH)
            out[a:b] += counts / np.maximum(total, 1)[:, None]
    return out


def _scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Unit deviation, and no feature of an odd text may outweigh all others."""
    bound = np.full(x.shape[1], CLIP, dtype=np.float32)
    bound[2 * BUCKETS :] = CLIP_REPEATS
    return np.clip((x - mean) / scale, -bound, bound)


def _train(x: np.ndarray, grades: np.ndarray, top: int, l2: float = 2e-2) -> OrdinalModel:
    """Maximum likelihood by Adam over all rows at once. Features are scaled to unit deviation for the search; gaps
    between thresholds are exponentials, which keeps them ordered."""
    mean, scale = x.mean(0), x.std(0) + 1e-4
    z = _scaled(x, mean, scale)
    n = max(len(x), 1)
    params = np.zeros(x.shape[1] + top)
    params[-top] = -1.0
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        w, raw = params[:-top], params[-top:]
        cuts = np.concatenate([raw[:1], raw[0] + np.cumsum(np.exp(raw[1:]))])
        score = z @ w.astype(np.float32)
        tail = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts[None, :], -40, 40)))
        edge = np.concatenate([np.ones((len(x), 1)), tail, np.zeros((len(x), 1))], axis=1)
        rows = np.arange(len(x))
        prob = np.maximum(edge[rows, grades] - edge[rows, grades + 1], 1e-9)
        slope = np.concatenate([np.zeros((len(x), 1)), tail * (1 - tail), np.zeros((len(x), 1))], axis=1)
        low, high = slope[rows, grades] / prob, slope[rows, grades + 1] / prob
        by_cut = np.zeros(top)
        np.subtract.at(by_cut, grades[grades > 0] - 1, low[grades > 0])
        np.add.at(by_cut, grades[grades < top], high[grades < top])
        grad_raw = np.concatenate([[by_cut.sum()], np.cumsum(by_cut[::-1])[::-1][1:] * np.exp(raw[1:])])
        grad = np.concatenate([z.T @ (low - high).astype(np.float32), grad_raw]) / n
        grad[:-top] -= l2 * w
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        params += 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    w, raw = params[:-top], params[-top:]
    cuts = np.concatenate([raw[:1], raw[0] + np.cumsum(np.exp(raw[1:]))])
    return OrdinalModel(w.astype(np.float32), cuts, mean, scale)


def untrained(top: int) -> OrdinalModel:
    flat = np.zeros(WIDTH, dtype=np.float32)
    return OrdinalModel(flat, np.linspace(-1, 1, top), flat, flat + 1)


def fit(docs: DataFrame, labels: DataFrame, grade: str, top: int, bound: int = SAMPLE_BOUND) -> OrdinalModel:
    """Train on at most ``bound`` labelled rows that are not held out. ``grade`` is an SQL expression over the labels
    that gives 0 to ``top``. The sample, bounded whatever the table's size, is worked on in one task; only the weights
    come to the driver."""

    def train(frames):
        import pandas as pd

        parts = list(frames)
        rows = pd.concat(parts) if parts else pd.DataFrame({"text": [], "grade": [], "doc_id": []})
        rows = rows.sort_values(["doc_id", "grade"], kind="stable")
        model = untrained(top)
        if len(rows):
            grades = rows["grade"].astype(int).clip(0, top).to_numpy()
            model = _train(_matrix(encoded(rows["text"])), grades, top)
        parts = (model.weights, model.mean, model.scale)
        yield pd.DataFrame({"w": [np.concatenate(parts).astype(np.float32).tobytes()], "t": [model.thresholds.tolist()]})

    sample = bounded_sample(labels, docs, {"grade": grade}, bound)
    row = sample.repartition(1).mapInPandas(train, "w binary, t array<double>").first()
    if row is None:  # no labelled row at all
        return untrained(top)
    weights, mean, scale = np.frombuffer(row["w"], dtype=np.float32).reshape(3, WIDTH)
    return OrdinalModel(weights, np.array(row["t"]), mean, scale)


def rate(docs: DataFrame, model: OrdinalModel, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` plus ``expected_grade`` and ``tails``, an array of ``P(grade >= 1)``, ``P(grade >= 2)`` and so
    on. One pass over the texts, no shuffle."""
    top = len(model.thresholds)

    def score(blobs: list[bytes]) -> list[np.ndarray]:
        tails = model.tails(model.scores(blobs))
        return [tails.sum(1), *tails.T]

    fields = "expected_grade double, " + ", ".join(f"__tail{k} double" for k in range(top))
    tails = [F.col(f"__tail{k}") for k in range(top)]
    kept = [c for c in keep if c.lower() != "tails"]
    rated = with_scores(docs, text, kept, fields, score)
    return rated.withColumn("tails", F.array(*tails)).drop(*[f"__tail{k}" for k in range(top)])


def select(rated: DataFrame, grade: int, least: float) -> DataFrame:
    """Rows whose probability of at least ``grade`` is ``least`` or more."""
    return rated.where(F.element_at("tails", grade) >= least)
