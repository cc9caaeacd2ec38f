import math
import numpy as np

from tidemark.llm import language
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = QUERIES["op5_output_codes"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert len(rows) > 150 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows) and got.count() == table(spark, SF, "documents").count()


def test_nothing_is_learnt_from_the_held_out_fold(spark):
    docs = table(spark, SF, "documents")
    other = docs.selectExpr("doc_id", "text", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 'xx' else lang end as lang")
    a, b = language.train(docs), language.train(other)
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights)


def test_edge_rows(spark):
    docs = table(spark, SF, "documents")
    model = language.train(docs)
    rows = [(1, None, "x"), (2, "", "x"), (3, "123 !? ½ \n", "x"), (4, "é", "x"), (None, "the and of " * 300_000, "x"), (1, None, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r["doc_id"]: r for r in language.predict(frame, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[1]["score"] == 0.0
    assert got[4]["lang_pred"] in model.languages and got[None]["lang_pred"] in model.languages
    assert language.predict(frame, model).count() == 6 and language.predict(frame.limit(0), model).count() == 0
    none = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert language.train(none) is None
    assert {r["lang_pred"] for r in language.predict(none, None).collect()} == {"und"}


def test_one_language_alone(spark):
    rows = [(i, f"word{i} text", "en") for i in range(20)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ("en",) and language.decode(model, np.zeros((1, model.codes.shape[1])))[0][0] == 0


def test_codes_correct_wrong_bits():
    codes = language.codewords(6).astype(int)
    bits = codes.shape[1]
    apart = min((codes[i] != codes[j]).sum() for i in range(6) for j in range(i))
    assert apart >= 5 and not (np.abs(codes.sum(axis=0)) == 6).any()
    model = language.Model(tuple("abcdef"), codes.astype(np.int8), np.zeros((1, bits)), np.full((6, bits), 1 / bits))
    rng = np.random.default_rng(0)
    for row in range(6):
        said = codes[row] * 2.0
        wrong = rng.choice(bits, (apart - 1) // 2, replace=False)
        said[wrong] *= -1
        best, chance = language.decode(model, said[None])
        assert best[0] == row and abs(chance.sum() - 1) < 1e-9


def test_long_texts_count_every_ngram_once():
    text = "abc déf " * 400_000
    whole = language.ngram_features(text)
    assert abs(float((whole ** 2).sum()) - 1) < 1e-3
    assert np.allclose(whole, language.ngram_features("abc déf " * 4_000), atol=5e-3)


def test_decoding_equals_its_definition():
    """The nearest codeword by losses weighted with each bit's reliability, in plain loops; flipped bits are corrected."""
    r = np.random.default_rng(8)
    codes = language.codewords(6)
    trust = r.random(codes.shape) + 0.01
    trust /= trust.sum(axis=1, keepdims=True)
    model = language.Model(tuple("abcdef"), codes, np.zeros((1, codes.shape[1]), np.float32), trust)
    outputs = r.normal(size=(40, codes.shape[1])) * 3
    best, chance = language.decode(model, outputs)
    for row, pick, chances in zip(outputs, best, chance):
        losses = [sum(trust[k][b] * math.log1p(math.exp(-codes[k][b] * row[b])) for b in range(len(row))) for k in range(6)]
        shares = [math.exp(-len(row) * (x - min(losses))) for x in losses]
        assert pick == losses.index(min(losses))
        assert np.allclose(chances, [s / sum(shares) for s in shares])
    apart = min((codes[i] != codes[j]).sum() for i in range(6) for j in range(i))
    even = language.Model(model.languages, codes, model.weights, np.full(codes.shape, 1 / codes.shape[1]))
    for k in range(6):
        sent = codes[k].astype(float) * 2
        sent[r.permutation(len(sent))[: (apart - 1) // 2]] *= -1
        assert language.decode(even, sent[None])[0][0] == k


def test_bit_classifiers_follow_the_loss_by_its_definition():
    """Training equals the same optimiser on differences of the balanced logistic loss, in plain loops."""
    r = np.random.default_rng(2)
    y = ["a"] * 4 + ["b"] * 7 + ["c"] * 3
    x = r.random((len(y), 3)).astype(np.float32)
    steps = 12
    model = language.fit(x, y, steps=steps)
    codes, names = model.codes, ["a", "b", "c"]
    bits = codes.shape[1]
    for b in (0, bits // 2, bits - 1):  # bits are learnt apart from each other
        def loss(w, b=b):
            total = 0.0
            for row, name in zip(x, y):
                z = sum(float(v) * u for v, u in zip([*row, 1.0], w))
                total += math.log1p(math.exp(-codes[names.index(name)][b] * z)) / 3 / y.count(name)
            return total + 1e-5 / 2 * sum(u * u for u in w)
        w, m, v = [0.0] * 4, [0.0] * 4, [0.0] * 4
        for t in range(steps):
            slope = []
            for i in range(4):
                hi, lo = list(w), list(w)
                hi[i] += 1e-5
                lo[i] -= 1e-5
                slope.append((loss(hi) - loss(lo)) / 2e-5)
            for i in range(4):
                m[i] = 0.9 * m[i] + 0.1 * slope[i]
                v[i] = 0.999 * v[i] + 0.001 * slope[i] ** 2
                w[i] -= 0.2 * (m[i] / (1 - 0.9 ** (t + 1))) / (math.sqrt(v[i] / (1 - 0.999 ** (t + 1))) + 1e-8)
        assert np.allclose(model.weights[:, b], w, atol=0.02)
