"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints are 64 bits over word shingles. Two that differ in at most
``max_bits`` bits agree on ``agree`` of ``agree + max_bits`` blocks at least, so every
choice of ``agree`` blocks is one table, and close pairs share a bucket in one of
them; candidates are verified by Hamming distance.

All work is on distinct fingerprints. A bucket of two is verified at once. The
members of larger buckets are first linked where one bit differs (64 masked
keys each, at most two members to a key); a dense family falls into one piece
that way, and then only pairs of different pieces of a bucket are compared. Links
within a piece add nothing to the components and are never formed.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import KEY, doc_id_of, keyed, numbered, settle
from tidemark.llm.components import components

SEED = 42
BITS = 64
PIECE = 1 << 20  # bytes of text read into words at a time
BLANK = re.compile(rb"[ \t-\r]")


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of the whole text, as an unsigned number; 0 without words.

    A-Z in lower case; words are runs without ASCII white space; shingles of
    ``words`` words joined by a space, repeats counted; fewer words: all of them
    as one shingle. A bit is 1 if it is set in over half of the XXH64 values.
    """
    data = (text or "").encode("utf-8").lower()
    counts, n, carried, at = np.zeros(BITS, dtype=np.int64), 0, [], 0
    while at < len(data):  # long texts by pieces that share the words of a shingle that spans them
        blank = BLANK.search(data, at + PIECE)
        stop = blank.start() if blank else len(data)
        parts = carried + data[at:stop].split()
        at = max(stop, at + 1)
        if len(parts) >= words:
            n += len(parts) - words + 1
            counts += _bit_counts(parts, words)
        carried = parts[max(0, len(parts) - words + 1):]
    if not n:
        if not carried:
            return 0
        n, counts = 1, _bit_counts(carried, len(carried))
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _bit_counts(parts: list[bytes], words: int) -> np.ndarray:
    """How many shingles of ``words`` words have each bit set in their hash."""
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:len(parts) - words + 1].tolist()
    ends = ends[words - 1:].tolist()
    hash_of = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(starts), 65536):
        values = np.array([hash_of(joined[a:b], SEED) for a, b in zip(starts[at:at + 65536], ends[at:at + 65536])], dtype="<u8")
        counts += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``fp``, the fingerprint as a signed long, of every row."""
    chosen = docs.select(*keep, F.col(text).alias("__text"))
    schema = chosen.drop("__text").schema.add("fp", "long")

    def run(batches):
        for batch in batches:
            made = np.array([fingerprint(t, words) for t in batch.column("__text").to_pylist()], dtype=np.uint64)
            columns = [batch.column(i) for i in range(len(keep))] + [pa.array(made.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "fp"])

    return chosen.mapInArrow(run, schema)


def block_tables(max_bits: int, agree: int) -> list[int]:
    """The bit masks of all tables: each choice of ``agree`` out of ``agree + max_bits`` blocks."""
    n = agree + max_bits
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(blocks, agree)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def close_links(fps: DataFrame, max_bits: int = 3, agree: int = 3) -> DataFrame:
    """``a, b``: links among the distinct longs of ``fps.fp`` whose components are those of all pairs within ``max_bits``."""
    masks = [_signed(m) for m in block_tables(max_bits, agree)]
    keys = F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(masks)])
    buckets = fps.select("fp", F.inline(keys))
    sizes = buckets.groupBy("block", "key").agg(
        F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where(F.col("n") > 1)
    sizes = settle(sizes, "buckets")
    pairs = sizes.where((F.col("n") == 2) & (_distance("a", "b") <= max_bits)).select("a", "b")

    crowded = sizes.where(F.col("n") > 2).select("block", "key")
    members = settle(buckets.join(crowded, ["block", "key"]), "members")
    masked = F.array(*[F.struct(F.lit(i).alias("bit"), F.col("fp").bitwiseAND(F.lit(_signed((1 << 64) - 1 - (1 << i)))).alias("rest"))
                       for i in range(BITS)])
    one_bit = members.select("fp").distinct().select("fp", F.inline(masked)).groupBy("bit", "rest").agg(
        F.min("fp").alias("a"), F.max("fp").alias("b")).where(F.col("a") != F.col("b")).select("a", "b")
    one_bit = settle(one_bit, "one-bit") if max_bits else one_bit.limit(0)
    piece = components(one_bit, "a", "b")
    placed = members.join(piece.withColumnRenamed("node", "fp"), "fp", "left").select(
        "block", "key", "fp", F.coalesce("component", "fp").alias("piece"))
    mixed = placed.groupBy("block", "key").agg(F.min("piece").alias("lo"), F.max("piece").alias("hi")).where(
        F.col("lo") != F.col("hi")).select("block", "key")
    placed = settle(placed.join(mixed, ["block", "key"]), "placed")
    left = placed.select("block", "key", F.col("fp").alias("a"), F.col("piece").alias("pa"))
    right = placed.select("block", "key", F.col("fp").alias("b"), F.col("piece").alias("pb"))
    across = left.join(right, (left["block"] == right["block"]) & (left["key"] == right["key"]) & (F.col("pa") < F.col("pb"))
                       & (_distance("a", "b") <= max_bits)).select("a", "b")
    return pairs.union(one_bit).union(across)


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 3, agree: int = 3) -> DataFrame:
    """``id_null, id, content, doc_id, fingerprint, component_id, keep`` for every row of ``docs`` (``doc_id, text``).

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits. ``keep`` marks the smallest key of each component, a
    null id coming last.

    Null, empty and blank texts have fingerprint zero and link like any other.
    Rows that repeat an id and its text are marked alike. Null ids take part; a
    component of null ids alone has a null id. An empty table gives no rows;
    other columns are not read.
    """
    fps = settle(fingerprints(keyed(docs, "text"), words, keep=tuple(KEY)), "fingerprints")
    classes = settle(fps.groupBy("fp").agg(F.min(F.struct(*KEY)).alias("least")), "classes")
    piece = components(close_links(classes.select("fp"), max_bits, agree), "a", "b")
    joined = classes.join(piece.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    tops = joined.groupBy("component").agg(F.min("least").alias("top"))
    named = joined.join(tops, "component").select("fp", "top")
    return fps.join(named, "fp").select(
        *KEY, doc_id_of().alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(~F.col("top.id_null"), F.col("top.id")).alias("component_id"), (F.struct(*KEY) == F.col("top")).alias("keep"))


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate component, all columns as they were.

    The row of the smallest id stays, a null id only where no other is; of rows that repeat an id and its text any one, with its
    own other columns. Null, empty and wordless texts share one fingerprint, so one of them stays;
    an empty table gives no rows.
    """
    kept = near_duplicates(docs, words, max_bits).where("keep").select(*KEY).distinct()
    carried = [f"__{i}" for i in range(len(docs.columns))]
    rows = keyed(docs, *numbered(docs.columns)).join(kept, KEY, "left_semi")
    rows = rows.groupBy(*KEY).agg(F.first(F.struct(*carried)).alias("row"))
    return rows.select(*[F.col(f"row.{c}").alias(n) for c, n in zip(carried, docs.columns)])
