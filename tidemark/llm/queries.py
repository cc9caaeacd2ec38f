"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from tidemark.llm import (bpe, chat, decontaminate, language, lattice, lines, merkle, sharding, simhash, toxicity, tries, urls,
                          warc)
from tidemark.llm.common import held_out, table, vocabulary_path
from tidemark.session import scratch_path


def op1_warc_transactions(spark, sf_dir):
    """Archive every page, read the archives back, one row per assembled capture."""
    captures = warc.round_trip(table(spark, sf_dir, "pages"), scratch_path(spark, "llm", "warc"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_cgk_windows(spark, sf_dir):
    """Every benchmark item found in a document, with its best window."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_simhash_blocks(spark, sf_dir):
    """Near-duplicate components of all documents: three-word shingles, at most three differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return found.select("doc_id", "fingerprint", "component_id")


def op4_line_chunks(spark, sf_dir):
    """Every document without the multi-line chunks that an earlier document or place has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs, count_as="cut_lines")


def op5_output_codes(spark, sf_dir):
    """Language of every document, learnt outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_bpe_backtracking(spark, sf_dir):
    """Every document encoded with the 50k byte-level vocabulary and decoded again."""
    return bpe.tokenize(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), with_ids=False)


def op7_positive_unlabelled(spark, sf_dir):
    """Toxicity of every document, learnt outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_weighted_hash_tree(spark, sf_dir):
    """40 equal shards in four regions of two racks; the grown tree has one more in the first rack."""
    tree = sharding.even_tree(40)
    return sharding.shard_documents(table(spark, sf_dir, "documents"), tree, tree.grow("region0", "rack0", 40))


def op9_perspective_rotation(spark, sf_dir):
    """Every conversation once for each of its speakers."""
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op10_e8_lattice(spark, sf_dir):
    """Links and components of all embeddings at cosine 0.9."""
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op11_prefix_trie(spark, sf_dir):
    """Every node of the prefix trie of all rebuilt conversations."""
    return tries.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_redirect_equivalence(spark, sf_dir):
    """Every page judged by the five rules, else by its aliases."""
    return urls.judge(table(spark, sf_dir, "pages"), urls.RULES)


def op13_merkle_manifest(spark, sf_dir):
    """Every document's place in the manifest, and the root that its tampered version folds to."""
    return merkle.digests(merkle.manifest(table(spark, sf_dir, "documents")))


def pipeline(spark, sf_dir):
    """All stages of the corpus pipeline over all documents."""
    import corpus_pipeline  # a file beside the package, read when it is asked for

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_warc_transactions, op2_cgk_windows, op3_simhash_blocks, op4_line_chunks, op5_output_codes,
    op6_bpe_backtracking, op7_positive_unlabelled, op8_weighted_hash_tree, op9_perspective_rotation, op10_e8_lattice,
    op11_prefix_trie, op12_redirect_equivalence, op13_merkle_manifest, pipeline)}

ORACLES = {"op1_warc_transactions": warc.ORACLE, "op4_line_chunks": lines.ORACLE, "op9_perspective_rotation": chat.ORACLE,
           "op11_prefix_trie": tries.ORACLE, "op12_redirect_equivalence": urls.ORACLE, "op13_merkle_manifest": merkle.ORACLE}
