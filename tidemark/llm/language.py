"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1. A logistic classifier over byte
n-grams predicts each bit; a text is given the language whose codeword has the
smallest loss, each bit weighted by how well its classifier does on that
language in training. A small lead over the next language flags ambiguity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import held_out, settle, share_of, share_that_holds

LETTER = regex.compile(r"\p{L}")
NONE = "und"
ORDERS = (1, 2, 3, 4)
DIMS = 1 << 12
# ASCII that is no letter reads as a blank, capitals as small letters
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
MIX = 2654435761  # odd multiplier of the n-gram hash


@dataclass(frozen=True)
class Model:
    """``codes`` (languages x bits, +1/-1), classifier ``weights`` (features + 1 x bits), ``trust`` (languages x bits)."""

    languages: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray
    trust: np.ndarray


def ngram_features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte n-grams in the whole text; unit length."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8").translate(PLAIN) + b" ", dtype=np.uint8)
    counts = np.zeros(DIMS, dtype=np.int64)
    for at in range(0, len(data), 1 << 20):  # long texts by pieces that overlap by an n-gram
        rolled = np.zeros(min(len(data) - at, (1 << 20) + max(ORDERS) - 1), dtype=np.uint32)
        piece = data[at:at + len(rolled)]
        for n in range(1, max(ORDERS) + 1):
            if len(piece) < n:
                break
            rolled = rolled[:len(piece) - n + 1] * np.uint32(257) + piece[n - 1:].astype(np.uint32)
            if n in ORDERS:
                slots = ((rolled + np.uint32(n)) * np.uint32(MIX)) >> np.uint32(32 - DIMS.bit_length() + 1)
                counts += np.bincount(slots[:1 << 20], minlength=DIMS)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def codewords(languages: int, seed: int = 11) -> np.ndarray:
    """The best spread of random codes: largest least distance of two rows, no bit alike for all."""
    bits = max(15, int(np.ceil(10 * np.log2(max(2, languages)))))
    draw = np.random.default_rng(seed)
    best, spread = None, -1
    for _ in range(200 if languages <= 200 else 5):
        codes = draw.choice(np.array([-1, 1], dtype=np.int8), size=(languages, bits))
        if languages > 1:
            flat = np.abs(codes.sum(axis=0, dtype=np.int64)) == languages
            codes[0, flat] *= -1
            apart = (bits - codes.astype(np.int64) @ codes.T.astype(np.int64)) // 2 + np.eye(languages, dtype=np.int64) * bits
            if apart.min() > spread:
                best, spread = codes, apart.min()
        else:
            best = codes
    return best


def fit(x: np.ndarray, y: list[str], steps: int = 150, rate: float = 0.2, decay: float = 1e-5) -> Model:
    """Train all bit classifiers at once; ``x`` has unit rows."""
    languages = tuple(sorted(set(y)))
    codes = codewords(len(languages))
    row = np.array([languages.index(v) for v in y])
    share = np.bincount(row, minlength=len(languages)).astype(np.float64)
    balance = (len(y) / len(languages) / share[row] / len(y)).astype(np.float32)[:, None]
    target = codes[row].astype(np.float32)
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    w = np.zeros((x.shape[1], codes.shape[1]), dtype=np.float32)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(steps):
        margin = target * (x @ w)
        slope = x.T @ (-target * balance / (1 + np.exp(np.clip(margin, -40, 40)))) + decay * w
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope ** 2
        w = w - rate * (first / (1 - 0.9 ** (t + 1))) / (np.sqrt(second / (1 - 0.999 ** (t + 1))) + 1e-8)
    right = (target * (x @ w) > 0).astype(np.float64)
    trust = np.stack([right[row == i].mean(axis=0) + 1e-3 for i in range(len(languages))])
    return Model(languages, codes, w.astype(np.float32), trust / trust.sum(axis=1, keepdims=True))


def decode(model: Model, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the language of least weighted loss, and the chances of all, for rows of classifier outputs."""
    margin = bits[:, None, :] * model.codes[None].astype(np.float64)
    loss = (model.trust[None] * np.logaddexp(0, -margin)).sum(axis=2)
    chance = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * model.codes.shape[1])
    return loss.argmin(axis=1), chance / chance.sum(axis=1, keepdims=True)


def train(docs: DataFrame, per_language: int = 500, max_rows: int = 3000, seed: int = 5) -> Model | None:
    """Fit on text and non-null ``lang`` of documents outside the held-out fold.

    The sample holds at most ``per_language`` texts with a letter of each language
    and about ``max_rows`` in all, at least one of each language: those of the
    smallest hash of the id. Null without any such document.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        "lang", "text", F.xxhash64(F.col("doc_id"), "text", F.lit(seed)).alias("draw"), F.xxhash64("text").alias("tie"))
    usable = usable.where(F.col("text").rlike(r"\p{L}"))
    counts = settle(usable.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    languages = counts.count()
    if not languages:
        return None
    most = max(1, min(per_language, max_rows // languages))
    near = usable.select("lang", "draw", "tie").join(counts, "lang").where(
        share_of(F.col("draw")) <= share_that_holds(most, F.col("n")))
    ids = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "tie"))).where(F.col("rank") <= most)
    ids = F.broadcast(ids.select("lang", "draw", "tie").distinct())
    texts = usable.join(ids, ["lang", "draw", "tie"]).groupBy("lang", "draw", "tie").agg(F.min("text").alias("text"))

    def features(batches):
        for batch in batches:
            made = [ngram_features(t.as_py()) for t in batch.column("text")]
            flat = np.concatenate(made) if made else np.empty(0, np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1) * DIMS, pa.int32()), pa.array(flat, pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("draw"), batch.column("tie"), lists],
                                             names=["lang", "draw", "tie", "x"])

    rows = texts.mapInArrow(features, "lang string, draw long, tie long, x array<float>").toArrow()
    rows = rows.sort_by([("lang", "ascending"), ("draw", "ascending"), ("tie", "ascending")]).combine_chunks()
    x = np.concatenate([np.asarray(c.flatten()) for c in rows["x"].chunks]).reshape(-1, DIMS)
    return fit(x, rows["lang"].to_pylist())


def predict(docs: DataFrame, model: Model | None, ambiguous_below: float = 0.6, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``lang_pred, score, ambiguous`` for every row, from its whole ``text`` alone.

    Null texts, texts without a letter, and all texts if there is no model, are
    ``und`` with score 0. ``ambiguous`` marks a chance of the chosen language below
    the bound. Equal losses go to the first language by name. Repeated rows are
    predicted alike; an empty table gives no rows; other columns are not read.
    """
    chosen = docs.select(*keep, F.col("text").alias("__text"))
    schema = chosen.drop("__text").schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    plain = model and (model.languages, model.codes, model.weights, model.trust)
    sent = docs.sparkSession.sparkContext.broadcast(plain)  # some hundred KB: features x bits

    def one(m, text):
        if m is None or text is None or not LETTER.search(text):
            return NONE, 0.0, True
        x = ngram_features(text)
        some = np.flatnonzero(x)
        bits = x[some] @ m.weights[some] + m.weights[-1]
        best, chance = decode(m, bits[None].astype(np.float64))
        top = float(chance[0, best[0]])
        return m.languages[best[0]], top, top < ambiguous_below

    def run(batches):
        m = sent.value and Model(*sent.value)
        for batch in batches:
            made = [one(m, t.as_py()) for t in batch.column("__text")]
            columns = [batch.column(i) for i in range(len(keep))] + [
                pa.array([v[0] for v in made], pa.string()), pa.array([v[1] for v in made], pa.float64()),
                pa.array([v[2] for v in made], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return chosen.mapInArrow(run, schema)
