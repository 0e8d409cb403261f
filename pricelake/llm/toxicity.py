"""Toxicity by non-negative positive-unlabelled learning.

Training sees confirmed toxic documents (positives) and a sample of all
documents, their labels unseen (unlabelled, toxic ones among them). With the class prior p, the
risk of calling everything right is estimated as

    p * R_pos(+) + max(0, R_unl(-) - p * R_pos(-))

where R_x(s) is the mean loss of sample x against sign s; whenever the second
term falls below zero the step ascends on it instead, which keeps a flexible
model from explaining the positives away. The model is a linear
classifier over the words that tell the two samples apart, trained with numpy
on samples of bounded, documented size. Everything else covers all rows:
sampling reads every document, and scoring reads every whole text.

The score is the probability that a document is toxic. A sum of word weights
decides, so a few telling words in a very long text count as much as in a short
one. Labels, languages, sources and ids are never inputs of a score.

Defined results: a null or empty text has no words and gets the model's score
of no words; repeated rows repeat; ids may be null; without a positive
in training every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import arrow_rows, pieces, stored

_LETTERS = re.compile(r"[^\W\d_]+")
#: Lengths of the word beginnings that count as features beside whole words: inflected forms share them.
STEMS = (5, 6, 7, 8)


@dataclass(frozen=True)
class Settings:
    """Bounds of the training samples and of the model."""

    max_positive: int = 6_000
    max_unlabelled: int = 12_000
    features: int = 400
    min_docs: int = 5
    rounds: int = 600
    learning_rate: float = 0.05
    l2: float = 1e-3
    threshold: float = 0.7
    seed: int = 7


@dataclass
class Model:
    """Weights of words, and the bias."""

    weight: dict[str, float] = field(default_factory=dict)
    bias: float = -30.0

    def score(self, words: set[str]) -> float:
        total = self.bias + sum([self.weight[w] for w in words & self.weight.keys()])
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30)))) if self.weight else 0.0


def words_of(text: str | None) -> set[str]:
    """Distinct lower-cased runs of letters, and their beginnings: with one star, or more if two or three words share it."""
    words = set(_LETTERS.findall((text or "").lower()))
    found = set(words)
    for n in STEMS:
        shared = Counter([w[:n] for w in words if len(w) >= n])
        found.update([stem + "*" for stem in shared])
        found.update([stem + "**" for stem, k in shared.items() if k > 1])
        found.update([stem + "***" for stem, k in shared.items() if k > 2])
    return found


def _sample(rows: DataFrame, bound: int, by: Column) -> DataFrame:
    """At most ``bound`` rows, those of least hash: the same rows on every run, and every row has its chance."""
    return rows.withColumn("__order", by).orderBy("__order").limit(bound).drop("__order")


def training_texts(docs: DataFrame, labels: DataFrame, learn: Column, settings: Settings) -> tuple[DataFrame | None, float]:
    """(toxic, text) of the positive and the unlabelled sample, and the class prior.

    ``learn`` tells, on a column ``doc_id``, which rows may be learnt from. The prior is the
    share of positives among the labelled rows that may be learnt from.
    """
    known = labels.filter(learn).filter(F.col("toxic").isNotNull())
    total, toxic = known.agg(F.count(F.lit(1)), F.sum((F.col("toxic") == 1).cast("long"))).first()
    if not toxic:
        return None, 0.0
    mixed = F.xxhash64(F.col("doc_id"), F.lit(settings.seed))
    confirmed = known.filter("toxic = 1").select("doc_id").distinct()
    # The unlabelled sample stands for all text, toxic documents included: that is what the prior speaks of.
    others = docs.filter(learn).select("doc_id").distinct()
    chosen = _sample(confirmed, settings.max_positive, mixed).withColumn("toxic", F.lit(True)).unionByName(
        _sample(others, settings.max_unlabelled, mixed).withColumn("toxic", F.lit(False)))
    # The list is bounded by the settings, so its join with the documents is a broadcast.
    chosen = stored(chosen.coalesce(1), "pu-sample")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text"), toxic / total


def feature_counts(texts: DataFrame) -> DataFrame:
    """(word, k1, k0): positive and unlabelled texts that hold each feature. Tasks add up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: tuple[Counter, Counter] = (Counter(), Counter())
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[0 if toxic else 1].update(words_of(text))
            words = list(sums[0].keys() | sums[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), *[pa.array([c[w] for w in words], pa.int64()) for c in sums]], names=["word", "k1", "k0"])

    return (texts.mapInArrow(count, "word string, k1 long, k0 long")
            .groupBy("word").agg(F.sum("k1").alias("k1"), F.sum("k0").alias("k0")))


def choose_features(counts: DataFrame, n1: int, n0: int, settings: Settings) -> list[str]:
    """The features commoner in positives whose counts differ most between the samples (G statistic).

    A feature must stand out beyond chance among as many features as were tried.
    """
    seen = counts.filter(F.col("k1") + F.col("k0") >= settings.min_docs)
    tried = max(2, seen.count())
    p = (F.col("k1") + F.col("k0")) / (n1 + n0)

    def part(k: Column, expected: Column) -> Column:
        return F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)

    gain = sum((part(F.col(k), n * p) + part(n - F.col(k), n * (1 - p)) for k, n in (("k1", n1), ("k0", n0))), F.lit(0.0)) * 2
    best = (seen.filter(F.col("k1") * n0 > F.col("k0") * n1).withColumn("gain", gain).filter(F.col("gain") > 2 * np.log(tried))
            .orderBy(F.desc("gain"), F.desc(F.length("word")), "word").limit(settings.features))
    return [r["word"] for r in best.select("word").collect()]


def presence(texts: DataFrame, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(toxic, matrix of which features each text holds) of the bounded training sample."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {w: i for i, w in enumerate(words)}
        for batch in batches:
            found = [sorted(at[w] for w in words_of(t) & at.keys()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "at"])

    rows = texts.mapInArrow(place, "toxic boolean, at array<int>").collect()
    out = np.zeros((len(rows), len(words)), dtype=bool)
    for r, row in enumerate(rows):
        out[r, row["at"]] = True
    return np.array([r["toxic"] for r in rows], dtype=bool), out


def train(toxic: np.ndarray, held: np.ndarray, words: list[str], prior: float, settings: Settings = Settings()) -> Model:
    """Fit the linear classifier by full-batch Adam on the non-negative risk (logistic loss).

    Equal rows are one row with a weight, and of features held by the same texts the first stands for all.
    """
    if not len(words) or not toxic.any():
        return Model()
    kept = np.sort(np.unique(held, axis=1, return_index=True)[1])
    words, held = [words[i] for i in kept], held[:, kept]
    x1, w1 = np.unique(held[toxic], axis=0, return_counts=True)
    x0, w0 = np.unique(held[~toxic], axis=0, return_counts=True)
    x1, x0 = x1.astype(float), x0.astype(float)
    w1, w0 = w1 / w1.sum(), w0 / max(1, w0.sum())
    weight, bias = np.zeros(len(words)), float(np.log(prior / max(1e-6, 1 - prior)))
    moment, second = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    for t in range(1, settings.rounds + 1):
        z1, z0 = x1 @ weight + bias, x0 @ weight + bias
        up1, up0 = w1 / (1 + np.exp(-z1)), w0 / (1 + np.exp(-z0))  # slopes of the loss against sign -
        slope_pos = np.append(x1.T @ (up1 - w1), (up1 - w1).sum()) * prior
        slope_neg = np.append(x0.T @ up0, up0.sum()) - np.append(x1.T @ up1, up1.sum()) * prior
        negative = (w0 * np.logaddexp(0, z0)).sum() - prior * (w1 * np.logaddexp(0, z1)).sum()
        slope = slope_pos + slope_neg if negative >= 0 else -slope_neg
        slope[:-1] += settings.l2 * weight * prior
        moment = 0.9 * moment + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        step = settings.learning_rate * (moment / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        weight -= step[:-1]
        bias -= float(step[-1])
    return Model({w: float(v) for w, v in zip(words, weight, strict=True) if v != 0}, bias)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, settings: Settings = Settings()) -> Model:
    """Train on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    arrow_rows(docs.sparkSession)
    texts, prior = training_texts(docs, labels, learn, settings)
    if texts is None:
        return Model()
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(True, 0), sizes.get(False, 0)
    if not n1 or not n0:
        return Model()
    words = choose_features(feature_counts(texts), n1, n0, settings)
    return train(*presence(texts, words), words, prior, settings) if words else Model()


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 at ``threshold`` or more); columns of those names are replaced."""
    arrow_rows(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop("score", "predicted")
    schema = T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            found = [sent.value.score(words_of(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64()), pa.array([int(s >= threshold) for s in found], pa.int32())],
                names=schema.names)

    return rest.mapInArrow(score, schema)
