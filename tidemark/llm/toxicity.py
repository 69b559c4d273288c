"""Toxicity from positive and unlabelled documents.

A classifier learns from documents known to be toxic and from documents about
which nothing is assumed.  Its risk on the clean ones is what it loses on the
unlabelled ones less the toxic share of them, and where that estimate falls
below zero it is stepped back: the non-negative estimator of Kiryo et al.,
"Positive-Unlabeled Learning with Non-Negative Risk Estimator" (2017).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.functions.ordering import col
from tidemark.functions.sizes import small_side
from tidemark.llm.frames import id_text, unused_name
from tidemark.llm.memo import ENTRY_BYTES, KEY_BYTES, MEMO_BYTES
from tidemark.workspace import materialise

_WORD = re.compile(r"[^\W\d_]+")
AFFIXES = range(4, 9)


def parts(word: str) -> list[str]:
    """The word itself, its beginnings and its ends."""
    longer = [n for n in AFFIXES if n < len(word)]
    return ["=" + word, *["^" + word[:n] for n in longer], *[word[-n:] + "$" for n in longer]]


class Counts:
    """How often each of a fixed set of parts occurs in a text."""

    def __init__(self, features: list[str]) -> None:
        self.features = {f: i for i, f in enumerate(features)}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.held = 0

    def __call__(self, text: str) -> tuple[dict[int, int], int]:
        """Counts by number of feature, and the number of words."""
        words = _WORD.findall(text.lower())
        if self.held > MEMO_BYTES:
            self.memo.clear()
            self.held = 0
        known, of, out = self.memo, self.features, {}
        for word, n in Counter(words).items():
            found = known.get(word)
            if found is None:
                found = tuple(of[p] for p in parts(word) if p in of)
                if len(word) <= KEY_BYTES:
                    known[word] = found
                    self.held += ENTRY_BYTES + len(word) + 8 * len(found)
            for i in found:
                out[i] = out.get(i, 0) + n
        return out, len(words)


def shares(counts: np.ndarray, words: int) -> np.ndarray:
    """Parts among the words, from 0 to 1 at one word in fifty."""
    return np.minimum(1.0, 50.0 * counts / max(1, words))


def vector(found: dict[int, int], words: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's vector: for each of ``n`` features that it is there, that it is repeated, and its share."""
    at, counts = np.fromiter(found, int, len(found)), np.fromiter(found.values(), float, len(found))
    values = np.concatenate((np.ones(len(at)), (counts > 1).astype(float), shares(counts, words)))
    return np.concatenate((at, n + at, 2 * n + at)), values


def _loss_slope(z: np.ndarray) -> np.ndarray:
    """The slope of log(1 + exp(-z))."""
    return -1 / (1 + np.exp(np.clip(z, -500, 500)))


def train(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    prior: float,
    seed: int,
    steps: int = 800,
    rate: float = 0.05,
    ridge: float = 2e-5,
    lasso: float = 2e-5,
) -> np.ndarray:
    """Weights and, last, the bias of a linear classifier with non-negative risk, by Adam on a bootstrap of the rows."""
    rng = np.random.default_rng(seed)
    p = np.hstack((positive[rng.integers(0, len(positive), len(positive))], np.ones((len(positive), 1))))
    u = np.hstack((unlabelled[rng.integers(0, len(unlabelled), len(unlabelled))], np.ones((len(unlabelled), 1))))
    w = np.zeros(p.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        fp, fu = p @ w, u @ w
        clean = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        clean_slope = u.T @ -_loss_slope(-fu) / len(u) - prior * (p.T @ -_loss_slope(-fp)) / len(p)
        if clean >= 0:
            slope = prior * (p.T @ _loss_slope(fp)) / len(p) + clean_slope
        else:
            slope = -clean_slope
        slope[:-1] += ridge * w[:-1]
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        pace = rate / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w -= pace * mean / (1 - 0.9**step)
        w[:-1] = np.sign(w[:-1]) * np.maximum(0, np.abs(w[:-1]) - lasso * rate)
    return w


@dataclass
class Model:
    """Features, the weights of their vector and, last, the bias."""

    features: list[str]
    weights: list[float]

    def scorer(self):
        count, n = Counts(self.features), len(self.features)
        weights = np.array(self.weights)

        def score(text: str) -> float:
            found, words = count(text)
            at, values = vector(found, words, n)
            z = weights[-1] + weights[at] @ values
            return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

        return score

    def score(self, df: DataFrame, text_col: str = "text", name: str = "score") -> DataFrame:
        """``df`` with the score of each row's whole text, 0 to 1; null texts are empty."""
        text = unused_name(df.withColumn(name, F.lit(0.0)), "__text")
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            score = model.scorer()
            for batch in batches:
                scores = pa.array([score(x.as_py()) for x in batch.column(text)], pa.float64())
                kept = [c for c in batch.schema.names if c != text]
                yield pa.record_batch([*(batch.column(c) for c in kept), scores], [*kept, name])

        schema = df.select("*").withColumn(name, F.lit(0.0)).schema
        return df.withColumn(text, F.coalesce(col(text_col).cast("string"), F.lit(""))).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _drawn(doc_id: Column, about: int, of: int) -> Column:
    """A fixed random choice of ``about`` out of ``of`` ids."""
    return F.pmod(F.xxhash64(doc_id, F.lit("sample")), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, about / max(1, of))))


def _without_copies(sample: DataFrame) -> DataFrame:
    """One of the texts that share their least shingle of three words, as most near copies do.

    Else what a group of copies happens to say would look like a sign of its label.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for text in batch.column("text"):
                words = text.as_py().encode().lower().split()
                keys.append(min(xxh64_intdigest(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))))
            key = pa.array(np.array(keys, np.uint64).view(np.int64))
            yield pa.record_batch([batch.column("toxic"), batch.column("text"), key], ["toxic", "text", "key"])

    keyed = sample.select("toxic", "text").mapInArrow(run, "toxic int, text string, key bigint")
    return keyed.groupBy("toxic", "key").agg(F.min_by("text", F.xxhash64("text")).alias("text")).drop("key")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    positives: int = 4_000,
    unlabelled: int = 8_000,
    max_parts: int = 20_000,
    max_features: int = 300,
    members: int = 3,
    prior: float | None = None,
) -> Model:
    """A model from ``labels`` (``doc_id, toxic``) and the texts of ``docs``.

    Labels of held-out rows are not read.  About ``positives`` of the documents
    labelled 1 and about ``unlabelled`` of all documents that are not held out
    are drawn by a hash of their ids, whatever the size of the tables, and
    near copies among them count once; the latter are used without labels.  ``prior``, the toxic share, is that of the
    labels if it is not given.  Features are parts of words: up to
    ``max_parts`` that toxic documents hold most often, of them the
    ``max_features`` whose share of the words differs most surely.  ``members``
    classifiers are trained on bootstraps of the sample, one task each, and
    averaged.  Null labels and ids are not learned from; a document labelled
    more than once is toxic if any label says so; other columns are not read.
    Without positive labels or documents every score is 0.
    """
    told = (
        labels.select(col(id_col).cast("bigint").alias("doc_id"), col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n_told, n_toxic = told.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    never = Model([], [-1000.0])
    if not n_toxic:
        return never
    prior = min(0.5, max(1e-3, prior or n_toxic / n_told))
    texts = id_text(docs, id_col, text_col).where("doc_id is not null").where(~held_out(F.col("doc_id")))
    chosen = told.where((F.col("toxic") == 1) & _drawn(F.col("doc_id"), positives, n_toxic)).select("doc_id")
    toxic = texts.join(small_side(chosen), "doc_id", "left_semi").withColumn("toxic", F.lit(1))
    rest = texts.where(_drawn(F.col("doc_id"), unlabelled, texts.count())).withColumn("toxic", F.lit(0))
    sample = materialise(_without_copies(toxic.unionByName(rest)), "toxicity-sample")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return never

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                words = set(_WORD.findall(text.as_py().lower()))
                found.update({p for w in words for p in parts(w)})
        yield pa.record_batch([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["part", "n"])

    least = max(3, n[1] // 200)
    held = sample.where("toxic = 1").select("text").mapInArrow(holding, "part string, n bigint")
    common = held.groupBy("part").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    candidates = [r["part"] for r in common.orderBy(F.desc("n"), "part").limit(max_parts).collect()]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, out = Counts(candidates), np.zeros((2, 2, len(candidates)))
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text")):
                found, words = count(text.as_py())
                at, counts = np.fromiter(found, int, len(found)), np.fromiter(found.values(), float, len(found))
                share = shares(counts, words)
                out[toxic, 0, at] += share
                out[toxic, 1, at] += share**2
        yield pa.record_batch(
            [pa.array(np.arange(len(candidates))), *(pa.array(out[t, k]) for t in (0, 1) for k in (0, 1))],
            ["part", "u", "uu", "p", "pp"],
        )

    added = sample.mapInArrow(sums, "part bigint, u double, uu double, p double, pp double").groupBy("part")
    mean = lambda c, t: F.sum(c) / n[t]
    spread = (mean("pp", 1) - mean("p", 1) ** 2) / n[1] + (mean("uu", 0) - mean("u", 0) ** 2) / n[0]
    surely = added.agg(
        ((mean("p", 1) - mean("u", 0)) / F.sqrt(F.greatest(spread, F.lit(1e-12)))).alias("z"),
        F.round(mean("p", 1), 9).alias("p"),
        F.round(mean("u", 0), 9).alias("u"),
    ).where("z > 1.6")
    alike = surely.groupBy("p", "u").agg(F.max("z").alias("z"), F.min("part").alias("part"))  # such as parts of one word
    best = alike.orderBy(F.desc("z"), "part").limit(max_features).collect()
    features = [candidates[r["part"]] for r in best]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counts(features)
        for batch in batches:
            found = [vector(*count(text.as_py()), len(features)) for text in batch.column("text")]
            at = pa.array([a for a, _ in found], pa.list_(pa.int64()))
            values = pa.array([v for _, v in found], pa.list_(pa.float64()))
            yield pa.record_batch([batch.column("toxic"), at, values], ["toxic", "at", "value"])

    def learn(member: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(member), 3 * len(features)))
        for i, (at, values) in enumerate(zip(member["at"], member["value"])):
            x[i, at] = values
        toxic, seed = member["toxic"].to_numpy() == 1, int(member["member"].iloc[0])
        order = np.lexsort(x.T)  # so that the result doesn't depend on the order of rows
        x, toxic = x[order], toxic[order]
        return pd.DataFrame({"member": [seed], "weights": [train(x[toxic], x[~toxic], prior, seed).tolist()]})

    each = F.explode(F.sequence(F.lit(0), F.lit(members - 1))).alias("member")
    vectors = sample.mapInArrow(rows, "toxic int, at array<bigint>, value array<double>").select("*", each)
    trained = vectors.groupBy("member").applyInPandas(learn, "member int, weights array<double>").collect()
    return Model(features, np.mean([r["weights"] for r in sorted(trained)], axis=0).tolist())


def toxicity(
    docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    ``predicted`` is 1 from a score of ``threshold``.  Nothing but the text
    enters a score; null and empty texts get that of a text without words; null
    ids stay null and are not held out; repeated rows come out as often as they
    go in; an empty table gives an empty result.  Nothing is shuffled.
    """
    scored = model.score(id_text(docs, id_col, text_col), "text").drop("text")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
