"""Toxicity by non-negative positive-unlabelled learning.

The learner sees confirmed toxic texts and unlabelled texts, no confirmed clean
ones. With class prior ``p``, risk of the positives as positive ``P+`` and as
negative ``P-`` and of the unlabelled as negative ``U-``, it minimises
``p P+ + max(0, U- - p P-)`` for a linear logistic model; where the corrected
negative risk falls below zero, a step undoes it instead.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, smallest, words

PREFIXES = (3, 4, 5, 6)
SPACE = (1 << 24) - 1
MOST_WORDS = 200_000  # kept in a task's table of words; what is dropped is made again


@dataclass(frozen=True)
class Model:
    """``weights`` of the features that a text has, ``bias``, and the class ``prior`` it was learnt with."""

    weights: dict[int, float]
    bias: float
    prior: float


def word_features(word: str) -> list[int]:
    """The word itself and its beginnings, hashed."""
    own = [zlib.crc32(word.encode("utf-8", "surrogatepass")) & SPACE]
    return own + [zlib.crc32((word[:n] + "*").encode("utf-8", "surrogatepass")) & SPACE for n in PREFIXES if len(word) > n]


def words_of(text: str | None) -> set[str]:
    return set().union(*words(text))


def text_features(text: str | None) -> set[int]:
    return {f for w in words_of(text) for f in word_features(w)}


def select_features(positive: list[np.ndarray], unlabelled: list[np.ndarray], least_z: float, most: int) -> np.ndarray:
    """Features that stand in more of the positives, by the z-score of the two shares of texts.

    The score says little of features that fewer than three positives have.
    """
    n1, n0 = len(positive), len(unlabelled)
    every, counts = np.unique(np.concatenate([*positive, np.empty(0, np.int64)]), return_counts=True)
    others, other_counts = np.unique(np.concatenate([*unlabelled, np.empty(0, np.int64)]), return_counts=True)
    at = np.searchsorted(others, every)
    found = np.zeros(len(every))
    inside = at < len(others)
    inside[inside] = others[at[inside]] == every[inside]
    found[inside] = other_counts[at[inside]]
    share = (counts + found) / (n1 + n0)
    z = (counts / n1 - found / max(1, n0)) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / max(1, n0)) + 1e-12)
    keep = np.flatnonzero((z >= least_z) & (counts >= min(3, n1)))
    return every[keep[np.argsort(-z[keep], kind="stable")][:most]]


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, least_z: float = 4.0, most: int = 1500,
        steps: int = 400, rate: float = 0.05, decay: float = 1.0) -> Model:
    """Adam on the non-negative risk, averaged over the second half of the steps.

    ``decay`` over the number of positives is the weight of the ridge: the fewer there are, the less is learnt of each.
    """
    if not positive or prior <= 0:
        return Model({}, -np.inf, 0.0)
    prior = min(prior, 0.999)
    chosen = select_features(positive, unlabelled, least_z, most)
    order = np.argsort(chosen)
    ranked = chosen[order]
    n1, n0, k = len(positive), len(unlabelled), len(chosen)
    x = np.zeros((n1 + n0, k + 1), dtype=np.float32)
    x[:, k] = 1
    for i, f in enumerate([*positive, *unlabelled]):
        at = np.searchsorted(ranked, f)
        hit = at[(at < k) & (ranked[np.minimum(at, max(k - 1, 0))] == f)] if k else at[:0]
        x[i, order[hit]] = 1
    theta = np.zeros(k + 1)
    theta[k] = np.log(prior / (1 - prior))
    first, second, mean = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    ridge = np.full(k + 1, decay / n1)
    ridge[k] = 0
    kept = range(steps // 2, steps)
    for t in range(steps):
        z = (x @ theta.astype(np.float32)).astype(np.float64)
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        negative = (np.logaddexp(0, z[n1:]).mean() if n0 else 0.0) - prior * np.logaddexp(0, z[:n1]).mean()
        g = np.empty(n1 + n0)
        if negative >= 0:  # prior * P+ + U- - prior * P-
            g[:n1], g[n1:] = -prior / n1, p[n1:] / max(1, n0)
        else:  # back from a negative risk that cannot be
            g[:n1], g[n1:] = prior * p[:n1] / n1, -p[n1:] / max(1, n0)
        slope = (x.T @ g.astype(np.float32)).astype(np.float64) + ridge * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope ** 2
        theta = theta - rate * (first / (1 - 0.9 ** (t + 1))) / (np.sqrt(second / (1 - 0.999 ** (t + 1))) + 1e-8)
        if t in kept:
            mean += theta / len(kept)
    return Model(dict(zip(chosen.tolist(), mean[:k].tolist())), float(mean[k]), prior)


def train(docs: DataFrame, labels: DataFrame, max_positive: int = 1500, max_unlabelled: int = 4500, seed: int = 7) -> Model:
    """Fit on documents outside the held-out fold.

    Positives: at most ``max_positive`` documents with a label toxic = 1; unlabelled:
    at most ``max_unlabelled`` documents of any kind, both those with the smallest
    hash of the id. The prior is the share of toxic labels. These bounds keep the
    features that the driver gets and the broadcast ids small at any input size.
    Null labels and labels of unknown documents are passed over; a document
    labelled twice is toxic if either label says so; an id that stands for
    several rows is learnt from once, by its smallest text. Without positives
    the model gives score 0.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    draw = F.xxhash64(F.col("doc_id"), F.lit(seed))
    positive = smallest(known.where("toxic = 1").select("doc_id"), draw, max_positive, "doc_id")
    unlabelled = smallest(docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id").distinct(), draw,
                          max_unlabelled, "doc_id")
    drawn = positive.select("doc_id", F.lit(1).alias("toxic")).union(unlabelled.select("doc_id", F.lit(0)))
    drawn = F.broadcast(drawn.groupBy("doc_id").agg(F.max("toxic").alias("is_p"), F.min("toxic").alias("least")))
    texts = docs.select("doc_id", "text").join(drawn, "doc_id").groupBy("doc_id", "is_p", "least").agg(F.min("text").alias("text"))

    def features(batches):
        for batch in batches:
            made = [sorted(text_features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("is_p"), batch.column("least"), pa.array(made, pa.list_(pa.int32()))],
                                             names=["is_p", "least", "found"])

    rows = texts.mapInArrow(features, "is_p int, least int, found array<int>").toArrow()
    found = [np.asarray(f.values, dtype=np.int64) for f in rows["found"]]
    is_p, least = rows["is_p"].to_pylist(), rows["least"].to_pylist()
    return fit([f for f, p in zip(found, is_p) if p == 1], [f for f, u in zip(found, least) if u == 0], prior)


class Scorer:
    """Scores of whole texts, with a bounded table of the words seen."""

    def __init__(self, model: Model):
        self.weights, self.bias = model.weights, model.bias
        self.table: dict[str, tuple[int, ...]] = {}

    def known(self, word: str) -> tuple[int, ...]:
        got = self.table.get(word)
        if got is None:
            if len(self.table) >= MOST_WORDS:
                self.table.clear()
            got = self.table[word] = tuple(f for f in word_features(word) if f in self.weights)
        return got

    def score(self, text: str | None) -> float:
        found = {f for w in words_of(text) for f in self.known(w)}
        z = self.bias + sum(self.weights[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-z))) if z > -700 else 0.0


def score(docs: DataFrame, model: Model, threshold: float = 0.3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``score`` (0 to 1) and ``predicted`` for every row, from its whole ``text`` alone.

    Null and empty texts have no features and score what the bias gives; repeated
    rows score alike; an empty table gives no rows; other columns are not read.
    """
    chosen = docs.select(*keep, F.col("text").alias("__text"))
    schema = chosen.drop("__text").schema.add("score", "double").add("predicted", "integer")

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            made = [scorer.score(t.as_py()) for t in batch.column("__text")]
            columns = [batch.column(i) for i in range(len(keep))] + [
                pa.array(made, pa.float64()), pa.array([int(s >= threshold) for s in made], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return chosen.mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they were; rows are not shuffled.

    A null or empty text scores as a text without words does; whole texts are scored, however long; a score equal to the
    threshold goes; repeated rows stay or go alike; an empty table gives no rows.
    """
    at = docs.columns.index("text")

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            kept = [scorer.score(t.as_py()) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
