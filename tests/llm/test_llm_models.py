"""Classifiers: accuracy on held-out rows, odd texts, empty tables."""

import math
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from isoloom.llm import embedding_dedup, quality, queries, toxicity
from isoloom.llm.common import table

SF = "/root/testdata/sf0.1"
HELD_OUT = "crc32(cast(doc_id as string)) % 3 = 1"


@pytest.fixture(scope="module")
def labelled(spark):
    return table(spark, SF, "labels").where(HELD_OUT)


def odd(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "word " * 60000, "c"), (3, "word " * 60000, "c"), (None, "x", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, SCORE string")


def test_quality_on_held_out_rows(spark, labelled):
    docs = table(spark, SF, "documents")
    model = quality.fit(docs, table(spark, SF, "labels"), queries.GRADE, top=2)
    assert model.thresholds[0] < model.thresholds[1]
    rated = quality.rate(docs, model, ["doc_id"]).join(labelled, "doc_id")
    kept = F.avg((F.element_at("tails", 1) >= queries.KEEP_TAIL).cast("int")).alias("kept")
    share = {r["quality"]: r["kept"] for r in rated.groupBy("quality").agg(kept).collect()}
    assert share[1] > 0.98 and share[0] < 0.3
    by_toxic = {r["toxic"]: r["g"] for r in rated.where("quality = 1").groupBy("toxic").agg(F.avg("expected_grade").alias("g")).collect()}
    assert by_toxic[0] > by_toxic[1]
    rows = quality.rate(odd(spark), model, ["doc_id", "SCORE"]).collect()
    assert len(rows) == 5 and all(0 <= r["tails"][1] <= r["tails"][0] <= 1 for r in rows)
    assert quality.rate(odd(spark).limit(0), model, ["doc_id"]).count() == 0
    empty = quality.fit(docs, table(spark, SF, "labels").limit(0), queries.GRADE, top=2)
    assert quality.rate(odd(spark), empty, ["doc_id"]).count() == 5


def test_toxicity_on_held_out_rows(spark, labelled):
    docs = table(spark, SF, "documents")
    weights = toxicity.fit(docs, table(spark, SF, "labels"))
    scored = toxicity.score(docs, weights, ["doc_id"]).join(labelled, "doc_id")
    share = {r["toxic"]: r["p"] for r in scored.groupBy("toxic").agg(F.avg((F.col("score") >= 0.7).cast("int")).alias("p")).collect()}
    assert share[1] > 0.9 and share[0] < 0.03
    rows = toxicity.score(odd(spark), weights, ["doc_id", "SCORE"]).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    text = "Nice day here. You are a worthless idiot! Good night."
    found = toxicity.locate(spark.createDataFrame([(9, text), (10, None)], "doc_id long, text string"), weights).collect()
    assert [r["sentence"] for r in found] == ["You are a worthless idiot"] and text.encode()[found[0]["start"] : found[0]["end"]].decode() == found[0]["sentence"]
    assert toxicity.score(odd(spark).limit(0), weights, ["doc_id"]).count() == 0
    nothing = toxicity.fit(docs, table(spark, SF, "labels").where("toxic is null"))
    assert all(r["score"] < 1e-9 for r in toxicity.score(odd(spark), nothing, ["doc_id"]).collect())


def test_held_out_rows_are_not_learnt_from(spark):
    docs = spark.createDataFrame([(i, f"idiot {i}") for i in range(40)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "1 as toxic").where(HELD_OUT)
    assert all(r["score"] < 1e-9 for r in toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id"]).collect())
    assert duckdb.sql("select 1").fetchall()


def test_noisy_or_by_hand():
    rng = np.random.default_rng(2)
    weights = np.append(rng.gamma(0.3, 2.0, 2**toxicity.BITS), -2.5)

    def of_word(word):
        bucket, sentence, *_ = toxicity._sentences([word.encode()])
        assert len(bucket) == 2 and set(sentence.tolist()) == {0}
        return weights[bucket].sum()

    texts = ["", "one", "One TWO three. Four; five?six\nseven eight", "!!! ... ?", "same same. same same", "Ünï cödé. 12 ab3", "a" * 300 + ". b"]
    for text in texts:
        clean = 1.0
        for sentence in re.split(r"[.!?\n]", text):
            words = re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", sentence)
            if words:
                clean *= 1 - 1 / (1 + math.exp(-(weights[-1] + sum(map(of_word, words)))))
        assert toxicity._document_scores([text.encode()], weights)[0][0] == pytest.approx(1 - clean, abs=1e-9)


def test_ordinal_likelihood_by_hand():
    rng = np.random.default_rng(7)
    x = rng.random((60, quality.WIDTH)).astype(np.float32) * 0
    x[:, :4] = rng.random((60, 4))
    grades = (x[:, 0] * 2 + x[:, 1] + rng.random(60) * 0.8 > np.array([[1.0], [2.0]])).sum(0)
    model = quality._train(x, grades, 2)
    z = np.clip((x - model.mean) / model.scale, -quality.CLIP, quality.CLIP)[:, :4].astype(float)

    def tails(w, cuts):
        return [[1 / (1 + math.exp(cut - sum(a * b for a, b in zip(row, w)))) for cut in cuts] for row in z]

    def objective(w, cuts, l2=2e-2):
        each = ([1, *t, 0] for t in tails(w, cuts))
        return sum(math.log(e[g] - e[g + 1]) for e, g in zip(each, grades)) / len(z) - l2 / 2 * sum(a * a for a in w)

    w, cuts = model.weights[:4].astype(float), model.thresholds
    scores = z @ w
    assert np.allclose(model.tails(scores), tails(w, cuts)) and cuts[0] < cuts[1] and not model.weights[4:].any()
    best = objective(w, cuts)
    for _ in range(200):
        near = objective(w + rng.normal(0, 0.2, 4), np.sort(cuts + rng.normal(0, 0.2, 2)))
        assert near < best + 0.01  # the search ends after a fixed number of steps
    assert np.bincount(grades, minlength=3).min() > 5


def test_forest_recall_on_planted_links(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(3000, 48))
    for k in range(0, 600, 2):  # pairs at cosine 0.98 to 0.99
        a = vectors[k] / np.linalg.norm(vectors[k])
        side = rng.normal(size=48)
        side -= side @ a * a
        cosine = rng.uniform(0.9805, 0.99)
        vectors[k + 1] = cosine * a + math.sqrt(1 - cosine**2) * side / np.linalg.norm(side)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = {(a, b) for a, b in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.98, 1)))}
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["component_id"] for r in embedding_dedup.link(df, threshold=0.98).collect()}
    found = sum(got[a] == got[b] for a, b in linked)
    assert len(linked) >= 300 and found >= 0.995 * len(linked)
    assert all((got[i], i) in linked or got[i] == i for i in got)
