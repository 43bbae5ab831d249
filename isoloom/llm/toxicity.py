"""Toxicity by multiple-instance learning: a document is a bag of sentences and toxic when any of them is.

A logistic score over hashed words and their first five bytes rates each sentence; the noisy-or ``1 - prod(1 - p)`` of its sentences rates the
document, and only document labels train the weights. The sentence scores then locate the offending sentences.

Sentences end at ``.``, ``!``, ``?``, a line end or the end of the text. Null and empty texts have no sentence and
score 0. Repeated rows and ties score alike; an empty table gives an empty result; without usable labels all score 0.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import bounded_sample, encoded, joined, slices, with_scores, words_in

BITS = 18
SAMPLE_BOUND = 6000
STEPS = 80
START_BIAS = -6.0
LEAST_SHARE = 0.01
STEM = 5
ENDS = np.zeros(256, dtype=bool)
ENDS[[0, 10, 33, 46, 63]] = True


def _sentences(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """Per word its bucket and sentence; per sentence that has words its document, start and end in the document."""
    data, starts = joined(blobs)
    begin, doc, hashes, stems = words_in(data, starts, stem=STEM)
    stops = np.flatnonzero(ENDS[data])
    rank = np.searchsorted(stops, begin)
    used, sentence = np.unique(rank, return_inverse=True)
    first = np.searchsorted(rank, used)
    owner = doc[first]
    bucket = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    bucket, sentence = np.concatenate([bucket, (stems >> np.uint64(64 - BITS)).astype(np.int64)]), np.tile(sentence, 2)
    return bucket, sentence, owner, begin[first] - starts[owner], stops[used] - starts[owner]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sentence_scores(blobs: list[bytes], weights: np.ndarray):
    bucket, sentence, owner, start, end = _sentences(blobs)
    z = np.bincount(sentence, weights=weights[bucket], minlength=len(owner)) + weights[-1]
    return z, owner, start, end


def _document_scores(blobs: list[bytes], weights: np.ndarray) -> list[np.ndarray]:
    z, owner, _, _ = _sentence_scores(blobs, weights)
    return [-np.expm1(-np.bincount(owner, weights=_softplus(z), minlength=len(blobs)))]


def _train(blobs: list[bytes], toxic: np.ndarray, l1: float = 1e-5) -> np.ndarray:
    """Likelihood of the document labels under the noisy-or, by Adam over all rows at once. Buckets seen in
    fewer than three or one per cent of the toxic documents stay without weight; the others shrink a little each step
    and never fall below zero: words are evidence for toxicity or none, so a long sentence can't hide an offending word."""
    buckets, sentences, owners, done, lines = [], [], [], 0, 0
    for a, b in slices([len(x) for x in blobs]):
        bucket, sentence, owner, _, _ = _sentences(blobs[a:b])
        buckets.append(bucket.astype(np.int32))
        sentences.append((sentence + lines).astype(np.int32))
        owners.append(owner + done)
        lines, done = lines + len(owner), done + b - a
    bucket, sentence, owner = map(np.concatenate, (buckets, sentences, owners))
    pairs = np.unique(owner[sentence].astype(np.int64) << BITS | bucket)
    toxic_pairs = pairs[toxic[pairs >> BITS] == 1] & (2**BITS - 1)
    common = np.bincount(toxic_pairs, minlength=2**BITS) >= max(3, LEAST_SHARE * (toxic == 1).sum())
    w = np.zeros(2**BITS + 1)
    w[-1] = START_BIAS
    first, second = np.zeros_like(w), np.zeros_like(w)
    share = np.where(toxic == 1, 0.5 / max(toxic.sum(), 1), 0.5 / max((toxic == 0).sum(), 1))
    share = 0.75 * share + 0.25 / len(toxic)
    for step in range(1, STEPS + 1):
        z = np.bincount(sentence, weights=w[bucket], minlength=lines) + w[-1]
        total = np.maximum(np.bincount(owner, weights=_softplus(z), minlength=len(blobs)), 1e-12)
        pull = np.where(toxic == 1, 1 / np.expm1(np.minimum(total, 50)), -1.0) * share
        by_sentence = pull[owner] / (1 + np.exp(-np.clip(z, -40, 40)))
        grad = np.append(np.bincount(bucket, weights=by_sentence[sentence], minlength=2**BITS), by_sentence.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        step_size = 0.3 / (np.sqrt(second / (1 - 0.999**step)) + 1e-5)
        w += step_size * first / (1 - 0.9**step)
        w[:-1] = np.maximum(w[:-1] - np.minimum(step_size[:-1] * l1, 0.05), 0) * common
    return w


def untrained() -> np.ndarray:
    """Weights by which every text scores (nearly) 0."""
    weights = np.zeros(2**BITS + 1)
    weights[-1] = -40.0
    return weights


def fit(docs: DataFrame, labels: DataFrame, toxic: str = "toxic", bound: int = SAMPLE_BOUND) -> np.ndarray:
    """Weights learnt from at most ``bound`` labelled rows that are not held out; the bounded sample is one task."""

    def train(frames):
        import pandas as pd

        parts = [f for f in frames if len(f)]
        weights = untrained()
        if parts:
            rows = pd.concat(parts).sort_values(["doc_id", "toxic"], kind="stable")
            weights = _train(encoded(rows["text"]), rows["toxic"].astype(int).to_numpy())
        yield pd.DataFrame({"w": [weights.astype(np.float32).tobytes()]})

    sample = bounded_sample(labels, docs, {"toxic": toxic}, bound)
    row = sample.repartition(1).mapInPandas(train, "w binary").first()
    return np.frombuffer(row["w"], dtype=np.float32).astype(np.float64) if row else untrained()


def score(docs: DataFrame, weights: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` plus ``score``, the probability that any sentence is toxic. One pass, no shuffle."""
    slim = weights.astype(np.float32)
    return with_scores(docs, text, keep, "score double", lambda blobs: _document_scores(blobs, slim))


def locate(docs: DataFrame, weights: np.ndarray, least: float = 0.5) -> DataFrame:
    """The offending sentences: doc_id, start and end (bytes of the UTF-8 text), sentence, probability."""
    slim = weights.astype(np.float32)

    def run(frames):
        import pandas as pd

        for frame in frames:
            blobs, ids = encoded(frame["text"]), frame["doc_id"].tolist()
            for a, b in slices([len(x) for x in blobs]):
                z, owner, start, end = _sentence_scores(blobs[a:b], slim)
                p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                rows = [
                    (ids[a + owner[i]], int(start[i]), int(end[i]),
                     blobs[a + owner[i]][start[i] : end[i]].decode("utf-8", "replace"), float(p[i]))
                    for i in np.flatnonzero(p >= least)
                ]
                yield pd.DataFrame(rows, columns=["doc_id", "start", "end", "sentence", "probability"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, start long, end long, sentence string, probability double"
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, shape)
