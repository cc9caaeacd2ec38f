"""The pipeline stage by stage against plain Python on what the stage before kept."""

import hashlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontaminate import plain_distances
from tests.llm.test_lines import brute as plain_lines
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tidemark.llm import toxicity
from tidemark.llm.common import settle, table, words

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    names = docs.columns
    read = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    stages = dict(corpus_pipeline.STAGES)
    before = read(docs)

    kept = settle(stages["toxicity"](spark, docs, SF), "t")
    scorer = toxicity.Scorer(toxicity.train(docs, table(spark, SF, "labels")))
    assert kept.columns == names and read(kept) == {i: t for i, t in before.items() if scorer.score(t) < 0.3}

    cut = settle(stages["line dedup"](spark, kept, SF), "t")
    assert cut.columns == names and read(cut) == plain_lines(list(read(kept).items()))
    assert cut.where("n_chars <> char_length(text)").count() == 0

    single = settle(stages["simhash near-dedup"](spark, cut, SF), "t")
    rows = sorted(read(cut).items())
    roots = plain_components([i for i, _ in rows], [plain_fingerprint(t) for _, t in rows])
    assert single.columns == names and read(single) == {i: t for (i, t), r in zip(rows, roots) if i == r}

    clean = settle(stages["benchmark decontamination"](spark, single, SF), "t")
    split = lambda t: [w for part in words(t) for w in part]
    items = [split(r["text"]) for r in table(spark, SF, "benchmark").collect()]

    def leaks(text):
        seen = split(text)
        return any(not set(i).isdisjoint(seen) and len(set(i) & set(seen)) >= 0.5 * len(set(i))
                   and min(plain_distances(i, seen, True)) <= int(len(i) * 0.2 + 1e-9) for i in items)
    assert clean.columns == names and read(clean) == {i: t for i, t in read(single).items() if not leaks(t)}

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = read(clean)
    for r in stages["bpe"](spark, clean, SF).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()


def test_run_is_the_stages_in_order(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, SF), "t")
    want = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert corpus_pipeline.ORACLE_SQL is None
    empty = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
