"""A corpus pipeline over the ``documents`` table; every stage calls one operator of ``tidemark.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again before the next one, so a lost executor costs part of a stage.
All stages but the last return the columns of ``documents``.

In all stages a null text is a document without words: it is kept by the toxicity and decontamination stages
if a text without words is, keeps its null through line dedup, is one of the group without words in SimHash
near-dedup, and has no tokens. So is an empty text, also one that lost all its lines. Texts of any
length are read whole. Rows that repeat an id and its text are treated alike until SimHash near-dedup keeps one of them. Equal
ids of different texts are documents of their own. Additional columns, whatever their names, are carried to the
last stage, which returns those it names. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, lines, simhash, toxicity
from tidemark.llm.common import settle, table, vocabulary_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from ``labels`` outside the held-out fold, does not reject."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the chunks of lines that an earlier document or place has."""
    return lines.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: three-word shingles, at most three differing bits."""
    return simhash.keep_one(docs, words=3, max_bits=3)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of ``benchmark`` is found."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    return bpe.tokenize(docs, vocabulary_path("byte_bpe_50k.json"), with_ids=True, keep=("doc_id", "lang", "source"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_repeated_lines),
    ("simhash near-dedup", one_of_each_group),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("bpe", encode),
]

ORACLE_SQL = None  # learnt scores, SimHash and merges are beyond SQL; tests/llm has a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
