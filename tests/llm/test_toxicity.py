import math
import random

import numpy as np

from tidemark.llm import toxicity
from tidemark.llm.common import held_out, table

SF = "/root/testdata/sf0.1"


def test_held_out_quality(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.train(docs, labels)
    unseen = docs.join(labels.where(held_out()).select("doc_id", "toxic"), "doc_id")
    rows = toxicity.score(unseen, model, keep=("doc_id", "toxic")).collect()
    hits = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    assert hits >= 0.85 * sum(r["toxic"] for r in rows)
    assert hits >= 0.70 * sum(r["predicted"] for r in rows)
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == t] for t in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) > 0.95


def test_hidden_positives_among_the_unlabelled():
    r = random.Random(2)
    plain = lambda: {f"w{r.randrange(3000)}" for _ in range(60)}
    toxic = lambda: plain() | {f"bad{r.randrange(6)}" for _ in range(3)}
    code = lambda words: np.array(sorted({f for w in words for f in toxicity.word_features(w)}))
    positive = [code(toxic()) for _ in range(200)]
    unlabelled = [code(toxic() if i % 5 == 0 else plain()) for i in range(1000)]
    model = toxicity.fit(positive, unlabelled, prior=0.2)
    scorer = toxicity.Scorer(model)
    score = lambda words: scorer.score(" ".join(words))
    assert np.mean([score(toxic()) >= 0.5 for _ in range(200)]) > 0.95
    assert np.mean([score(plain()) < 0.3 for _ in range(200)]) > 0.95


def test_nothing_is_learnt_from_held_out_labels(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - toxic else toxic end as toxic")
    assert toxicity.train(docs, labels) == toxicity.train(docs, turned)


def test_edge_rows(spark):
    rows = [(i, f"idiot trash {i}" if i % 4 == 0 else f"fine words {i}", "x") for i in range(200)]
    docs = spark.createDataFrame([*rows, (None, None, "x"), (5, "", None), (5, "", None)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([*((i, int(i % 4 == 0)) for i in range(0, 200, 2)), (None, 1), (3, None), (10 ** 6, 1), (8, 1), (8, 0)],
                                   "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 203 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] is None}) == 1
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.where("text like 'idiot%'").count() == 0
    long = spark.createDataFrame([(1, "word " * 1_000_000 + "idiot trash", "")], docs.schema)
    assert toxicity.score(long, model).first()["predicted"] == 1
    assert toxicity.score(docs.limit(0), model).count() == 0
    none = toxicity.train(docs, labels.limit(0))
    assert {(r["score"], r["predicted"]) for r in toxicity.score(docs, none).collect()} == {(0.0, 0)}
    assert toxicity.train(docs.limit(0), labels).prior >= 0


def plain_fit(positive, unlabelled, prior, chosen, steps, decay):
    """The non-negative risk by its definition, text by text; its slope by differences; the same optimiser in plain loops."""
    texts = [([c for c in chosen if c in set(f.tolist())], True) for f in positive] + [
        ([c for c in chosen if c in set(f.tolist())], False) for f in unlabelled]
    softplus = lambda v: math.log1p(math.exp(-abs(v))) + max(v, 0.0)
    names = [*chosen, "bias"]

    def parts(w):
        z = [(sum(w[f] for f in found) + w["bias"], p) for found, p in texts]
        mean = lambda sign, p: sum(softplus(sign * v) for v, q in z if q == p) / sum(q == p for _, q in z)
        return prior * mean(-1, True), mean(1, False) - prior * mean(1, True)  # positive risk, negative risk

    def risk(w, back):
        ridge = sum(decay / len(positive) * w[f] ** 2 / 2 for f in chosen)
        plus, minus = parts(w)
        return (-minus if back else plus + minus) + ridge

    w = {**{f: 0.0 for f in chosen}, "bias": math.log(prior / (1 - prior))}
    m, v, total, backs = {n: 0.0 for n in names}, {n: 0.0 for n in names}, {n: 0.0 for n in names}, 0
    for t in range(steps):
        back = parts(w)[1] < 0
        backs += back
        slope = {}
        for n in names:
            hi, lo = dict(w), dict(w)
            hi[n] += 1e-5
            lo[n] -= 1e-5
            slope[n] = (risk(hi, back) - risk(lo, back)) / 2e-5
        for n in names:
            m[n] = 0.9 * m[n] + 0.1 * slope[n]
            v[n] = 0.999 * v[n] + 0.001 * slope[n] ** 2
            w[n] -= 0.05 * (m[n] / (1 - 0.9 ** (t + 1))) / (math.sqrt(v[n] / (1 - 0.999 ** (t + 1))) + 1e-8)
        if t >= steps // 2:
            for n in names:
                total[n] += w[n] / (steps - steps // 2)
    return total, backs


def test_training_equals_the_risk_by_its_definition():
    r = np.random.default_rng(3)
    positive = [np.unique(np.concatenate([[1, 2], r.integers(3, 12, 2)])) for _ in range(12)]
    unlabelled = [np.unique(r.integers(3, 12, 3)) for _ in range(30)] + [np.array([1, 2, 5])]
    steps = 60
    model = toxicity.fit(positive, unlabelled, 0.4, least_z=1.0, most=5, steps=steps)
    want, backs = plain_fit(positive, unlabelled, 0.4, sorted(model.weights), steps, 1.0)
    assert backs > 0  # both sides of the estimator are taken
    assert all(abs(model.weights[f] - want[f]) < 0.02 for f in model.weights) and abs(model.bias - want["bias"]) < 0.02
