"""The classifier: risk, held-out rows, and documents made for it."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity

SYLLABLES = ["the", "er", "tion", "ing", "and", "re", "en", "ed", "ha", "es", "or", "st"]


def made(rng, n):
    """Documents, a tenth of them with toxic words, and labels for two in five."""
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(SYLLABLES, rng.integers(1, 4))) for _ in range(rng.integers(5, 200))]
        toxic = i % 10 == 3
        if toxic:
            for _ in range(max(1, len(words) // 40)):
                words.insert(rng.integers(0, len(words)), str(rng.choice(["scumbag", "idiotic", "worthless"])))
        rows.append((i, " ".join(words)))
        if rng.random() < 0.4:
            labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = made(np.random.default_rng(2), 3000)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    told = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    return docs, told, toxicity.fit(docs, told)


def test_finds_toxic_documents(learned):
    docs, _, model = learned
    out = toxicity.toxicity(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    toxic = [r for r in held if r.doc_id % 10 == 3]
    assert sum(r.predicted for r in toxic) >= 0.95 * len(toxic)
    assert sum(r.predicted for r in held if r.doc_id % 10 != 3) <= 0.01 * len(held)


def test_labels_of_held_out_rows_are_not_read(spark, learned):
    docs, told, model = learned
    turned = told.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, turned) == model


def test_as_many_unlabelled_documents_as_stated(spark, monkeypatch):
    """The draw is out of the documents that are not held out, so their part does not lessen it."""
    drawn = []

    def counted(sample):
        drawn.append(sample.where("toxic = 0").count())
        return sample.limit(0)

    monkeypatch.setattr(toxicity, "_without_copies", counted)
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
    toxicity.fit(docs, spark.createDataFrame([(i, 1) for i in range(10)], "doc_id bigint, toxic int"), unlabelled=3000)
    assert 2800 <= drawn[0] <= 3200


def test_length_does_not_hide_a_word(learned):
    _, _, model = learned
    score = model.scorer()
    rng = np.random.default_rng(3)
    clean = " ".join("".join(rng.choice(SYLLABLES, 3)) for _ in range(20000))
    assert score(clean) < 0.7
    assert score(clean + " scumbag idiotic worthless") > score(clean)


def test_risk_is_stepped_back():
    """With a prior far too high the plain risk falls below zero; the estimator keeps both sides apart all the same."""
    rng = np.random.default_rng(4)
    positive = rng.standard_normal((300, 2)) + 3
    unlabelled = np.vstack((rng.standard_normal((900, 2)), rng.standard_normal((100, 2)) + 3))
    for prior in (0.05, 0.1, 0.4):
        w = toxicity.train(positive, unlabelled, prior, seed=1)
        assert np.isfinite(w).all()
        scores = np.hstack((unlabelled, np.ones((1000, 1)))) @ w
        assert (scores[900:].mean() - scores[:900].mean()) > 1


def test_odd_documents(odd_docs, no_docs, learned):
    _, _, model = learned
    rows = odd_docs.collect()
    out = toxicity.toxicity(odd_docs, model).collect()
    score = model.scorer()
    assert sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 9)) for r in out) == sorted(
        (r.doc_id is None, r.doc_id or 0, round(score(r.text or ""), 9)) for r in rows
    )
    assert not any(r.held_out for r in out if r.doc_id is None)
    assert toxicity.toxicity(no_docs, model).collect() == []
    scored = model.score(odd_docs, name="other")
    assert scored.columns == [*odd_docs.columns, "other"] and scored.count() == len(rows)


def test_nothing_to_learn_from(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 0), (None, 1), (1, None)], "doc_id bigint, toxic int")
    some = spark.createDataFrame([(2, 1), (3, 1), (2, 0)], "doc_id bigint, toxic int")
    for model in (toxicity.fit(odd_docs, labels), toxicity.fit(odd_docs, labels.limit(0)), toxicity.fit(no_docs, some)):
        assert {r.predicted for r in toxicity.toxicity(odd_docs, model).collect()} == {0}
    toxicity.toxicity(odd_docs, toxicity.fit(odd_docs, some)).collect()


def test_scores_beside_columns_of_any_case(spark):
    model = toxicity.Model(["=bad"], [1.0, 1.0, 1.0, -2.0])
    docs = spark.createDataFrame([(1, "bad bad", "x", "y"), (2, None, "x", None)], "doc_id int, text string, `__TEXT` string, `_score` string")
    rows = model.score(docs, name="Score").collect()
    assert [r["__TEXT"] for r in rows] == ["x", "x"]
    assert rows[0]["Score"] > 0.5 > rows[1]["Score"]


def test_counting_remembers_a_fixed_number_of_bytes(monkeypatch):
    monkeypatch.setattr(toxicity, "MEMO_BYTES", 1000)
    count = toxicity.Counts(["=bad", "^very"])
    for i in range(300):
        word = "".join(chr(97 + int(d)) for d in f"{i:05d}")
        assert count(f"bad {word} verybad " + "x" * 500)[0] == {0: 1, 1: 1}
        assert len(count.memo) < 12
