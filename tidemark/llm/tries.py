"""Prefix trie of conversations as node tables behind minimal perfect hashes.

Every prefix of every conversation has a 128-bit digest, the exclusive or of the digests of (place, turn); a
distinct digest is a node. Conversations are dealt into shards. A shard enumerates its distinct
digests and gives each a slot by a minimal perfect hash; every look-up compares the digest
that stands in its slot. Counts are scattered into flat numpy arrays by slot, and sums over subtrees run
through the array of parent slots, deepest nodes first. Node tables of all shards are merged by digest.

Each node is owned by its smallest member, in whose shard alone it weighs, so the merged sums count it once.
A conversation too long for a shard is cut into spans, each a shard of its own; what later spans weigh is
added at the end of the earlier ones.
"""

from __future__ import annotations

import hashlib

import numpy as np

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import parts_for, places, settle

ROWS_IN_SHARD = 1 << 18  # turns
FAMILY = 100  # conversations that share the beginning of the first one
EMPTY = hashlib.sha256(b"").hexdigest()
SHARD = ["split", "alone"]  # a range partition; the conversation if it is too long for one, else null


# --- minimal perfect hash over 128-bit digests, in numpy

def _mixed(lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
    """A hash of each digest for a level, by multiplying and shifting."""
    with np.errstate(over="ignore"):
        x = lo.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(2 * level + 1)
        for k in (hi.view(np.uint64), np.uint64(level)):
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) + k
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 to n - 1 for n distinct digests (pairs of int64).

    Level by level, a digest that hashes to a bit of its own sets it, the others go on to the
    next level; a slot is the number of bits set before it. Digests that are in no slot are
    told by comparison with the digest that is there.
    """

    def __init__(self, lo: np.ndarray, hi: np.ndarray):
        left_lo, left_hi = lo, hi
        self.levels, total = [], 0
        while len(left_lo):
            size = np.uint64(max(8, 2 * len(left_lo)))
            at = (_mixed(left_lo, left_hi, len(self.levels)) % size).astype(np.int64)
            hits = np.bincount(at, minlength=int(size))
            alone = hits == 1
            self.levels.append((size, alone, np.cumsum(alone) - 1 + total))
            total += int(alone.sum())
            stay = ~alone[at]
            left_lo, left_hi = left_lo[stay], left_hi[stay]
            if len(self.levels) > 200:
                raise ValueError("digests repeat")
        self.lo, self.hi = np.zeros(total, np.int64), np.zeros(total, np.int64)
        slot = self._slots(lo, hi)
        self.lo[slot], self.hi[slot] = lo, hi

    def _slots(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        out = np.full(len(lo), -1, np.int64)
        todo = np.arange(len(lo))
        for level, (size, alone, rank) in enumerate(self.levels):
            at = (_mixed(lo[todo], hi[todo], level) % size).astype(np.int64)
            out[todo[alone[at]]] = rank[at[alone[at]]]
            todo = todo[~alone[at]]
        return out

    def slots(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The slot of every digest, -1 for one that the table does not hold."""
        if not len(self.lo):
            return np.full(len(lo), -1, np.int64)
        out = self._slots(lo, hi)
        return np.where((out >= 0) & (self.lo[out] == lo) & (self.hi[out] == hi), out, -1)


def node_table(lo: np.ndarray, hi: np.ndarray) -> PerfectHash:
    """The table of the distinct digests among (lo, hi)."""
    pairs = np.unique(np.stack([lo, hi], axis=1), axis=0)
    return PerfectHash(np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1]))


def accumulate(values: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """``values`` summed over every slot's subtree: slots pass theirs to their parents, deepest first. A parent of -1 is none."""
    total = values.copy()
    order = np.argsort(-depth, kind="stable")
    ends = np.flatnonzero(np.diff(depth[order])) + 1
    for slots in np.split(order, ends):
        up = slots[parent[slots] >= 0]
        np.add.at(total, parent[up], total[up])
    return total


# --- conversations, rebuilt, as digests

def head_of(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from the first of its family."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("long")


def _halves(digest: Column) -> list[Column]:
    """Two longs from the first 128 bits of a hexadecimal digest."""
    return [F.conv(F.substring(digest, 1 + 16 * i, 16), 16, -10).cast("long") for i in (0, 1)]


def rebuilt_steps(turns: DataFrame, rows_in_shard: int = ROWS_IN_SHARD) -> DataFrame:
    """``conv_id, split, alone, depth, lo, hi, up_lo, up_hi, chars, last``: every prefix of every rebuilt conversation.

    (lo, hi) is the prefix's digest and (up_lo, up_hi) that of the prefix one turn shorter, the root's is (0, 0); ``chars`` counts
    the code points of the last turn's text; ``last`` marks the whole conversation, and the last row of a span of a long one is told by ``tail``.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    said = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    read = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", said.alias("said"), F.char_length(text).cast("long").alias("chars"))
    parts = parts_for(turns, rows_in_shard)
    own = settle(places(read, ["conv_id"], ["turn", "said"], "trie-turns", parts), "trie-places")

    # one row a conversation: its length, its shard, and how many turns of its family's first it gets
    convs = own.groupBy("conv_id").agg(F.max("of").alias("n"), F.min("split").alias("first"))
    family = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family")
    firsts = convs.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("family"), F.col("n").alias("family_n"))
    convs = convs.select("conv_id", "n", "first", family, head_of(F.col("conv_id")).alias("head")).join(firsts, "family", "left")
    taken = F.least(F.col("head"), F.coalesce("family_n", F.lit(0)))
    kept = F.greatest(F.col("n") - F.col("head"), F.lit(0))
    long = F.when(taken + kept > rows_in_shard, F.col("conv_id"))
    convs = settle(convs.select("conv_id", "family", "head", "first", taken.alias("taken"), (taken + kept).alias("length"),
                                long.alias("alone")), "trie-conversations")

    heads = own.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < 5)).select(
        F.col("conv_id").alias("family"), "place", "said", "chars")
    lent = convs.join(heads, "family").where(F.col("place") < F.col("taken")).select(
        "conv_id", F.col("first").alias("split"), "alone", "length", (F.col("place") + 1).alias("depth"), "said", "chars")
    # a conversation's row meets its turns by (conversation, split), so that the turns of a long one stay spread
    marks = own.groupBy("conv_id", "split").count().select("conv_id", "split").join(convs, "conv_id")
    tails = own.join(marks, ["conv_id", "split"]).where(F.col("place") >= F.col("head")).select(
        "conv_id", F.when(F.col("alone").isNull(), F.col("first")).otherwise(F.col("split")).alias("split"), "alone", "length",
        (F.col("place") - F.col("head") + F.col("taken") + 1).alias("depth"), "said", "chars")
    roots = convs.select("conv_id", F.col("first").alias("split"), "alone", "length", F.lit(0).cast("long").alias("depth"),
                         F.lit(None).cast("string").alias("said"), F.lit(0).cast("long").alias("chars"))
    steps = roots.unionByName(lent).unionByName(tails)

    # digest of a turn at its depth; that of a prefix is their running exclusive or
    own_lo, own_hi = _halves(F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("said")), 256))
    zero = F.lit(0).cast("long")
    steps = steps.select("conv_id", "split", "alone", "length", "depth", "chars",
                         F.coalesce(own_lo, zero).alias("t_lo"), F.coalesce(own_hi, zero).alias("t_hi"))
    steps = settle(steps, "trie-steps")
    spans = steps.where(F.col("alone").isNotNull()).groupBy("conv_id", "split").agg(
        F.bit_xor("t_lo").alias("x_lo"), F.bit_xor("t_hi").alias("x_hi"))
    earlier = Window.partitionBy("conv_id").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv_id", "split", *[F.coalesce(F.bit_xor(f"x_{h}").over(earlier), zero).alias(f"b_{h}") for h in ("lo", "hi")])
    here = Window.partitionBy("conv_id", "split").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    upto = steps.withColumn("r_lo", F.bit_xor("t_lo").over(here)).withColumn("r_hi", F.bit_xor("t_hi").over(here)).withColumn(
        "tail", F.lead("depth").over(Window.partitionBy("conv_id", "split").orderBy("depth")).isNull())
    upto = upto.join(spans, ["conv_id", "split"], "left")
    lo, hi = (F.col(f"r_{h}").bitwiseXOR(F.coalesce(f"b_{h}", zero)) for h in ("lo", "hi"))
    return upto.select("conv_id", "split", "alone", "depth", lo.alias("lo"), hi.alias("hi"), lo.bitwiseXOR(F.col("t_lo")).alias("up_lo"),
                       hi.bitwiseXOR(F.col("t_hi")).alias("up_hi"), "chars", (F.col("depth") == F.col("length")).alias("last"),
                       (F.col("tail") & F.col("alone").isNotNull()).alias("tail"))


LOCAL = ("split int, alone long, lo long, hi long, up_lo long, up_hi long, depth long, chars long, conv_id long, "
         "n_convs long, tail_of long")
SUMS = "lo long, hi long, parent_conv_id long, n_leaves long, saved_tokens long"


def _ints(column) -> np.ndarray:
    return np.ascontiguousarray(column.to_numpy(dtype=np.int64))


def _local_nodes(key, steps):
    """The node table of a shard: distinct prefixes with their members there."""
    import pandas as pd

    lo, hi, conv = _ints(steps["lo"]), _ints(steps["hi"]), _ints(steps["conv_id"])
    table = node_table(lo, hi)
    slot = table.slots(lo, hi)
    n = len(table.lo)
    members, least = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    np.add.at(members, slot, 1)
    np.minimum.at(least, slot, conv)
    flat = {}
    for name in ("up_lo", "up_hi", "depth", "chars"):
        values = _ints(steps[name])
        flat[name] = np.zeros(n, np.int64)
        flat[name][slot] = values
        if (flat[name][slot] != values).any():
            raise ValueError("two prefixes share a digest")
    tail = steps["tail"].to_numpy(dtype=bool)
    ends, tail_of = np.zeros(n, bool), np.zeros(n, np.int64)
    ends[slot[tail]], tail_of[slot[tail]] = True, conv[tail]
    out = pd.DataFrame({"split": np.full(n, key[0], np.int32), "alone": pd.array([key[1] if key[1] == key[1] else None] * n, "Int64"),
                        "lo": table.lo, "hi": table.hi, **flat, "conv_id": least, "n_convs": members})
    out["tail_of"] = pd.arrays.IntegerArray(tail_of, ~ends)
    return out


def _subtree_sums(key, nodes):
    """Leaves and saved tokens below each node of a shard, and the parent's name where the shard owns the node."""
    import pandas as pd

    lo, hi = _ints(nodes["lo"]), _ints(nodes["hi"])
    table = PerfectHash(lo, hi)
    slot = table.slots(lo, hi)
    at = np.empty(len(slot), np.int64)
    at[slot] = np.arange(len(slot))  # rows by slot
    col = lambda name: _ints(nodes[name])[at]
    parent = table.slots(col("up_lo"), col("up_hi"))
    parent[col("depth") == 0] = -1
    leaves = accumulate(col("leaf_weight"), parent, col("depth"))
    saved = accumulate(col("token_weight"), parent, col("depth"))
    conv, own = col("conv_id"), nodes["own"].to_numpy(dtype=bool)[at]
    before = nodes["owner_before"].iloc[0]  # null but in later spans of a long conversation
    spanned = own & (parent < 0) & (col("depth") > 0)
    named = (own & (parent >= 0)) | spanned
    up = pd.arrays.IntegerArray(np.where(spanned, int(before) if spanned.any() else 0, np.where(named, conv[parent], 0)), ~named)
    return pd.DataFrame({"lo": table.lo, "hi": table.hi, "parent_conv_id": up, "n_leaves": leaves, "saved_tokens": saved})


def _stream_digests(batches):
    """Digests of texts that come in blocks, in order: one block is held at a time."""
    import pyarrow as pa

    key, sha = None, None
    done = []

    def flush():
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))],
                                          ["lo", "hi", "ends_sha256"])

    for batch in batches:
        for lo, hi, block in zip(batch["lo"].to_pylist(), batch["hi"].to_pylist(), batch["block"]):
            if (lo, hi) != key:
                if key is not None:
                    done.append((*key, sha.hexdigest()))
                key, sha = (lo, hi), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(block.as_py().encode())
        if done:
            yield flush()
            done.clear()
    if key is not None:
        done.append((*key, sha.hexdigest()))
        yield flush()


def end_digests(steps: DataFrame, parts: int) -> DataFrame:
    """``lo, hi, ends_sha256`` of nodes where conversations end: their ids, ascending, joined by commas.

    Ids are joined within range partitions; the blocks of a node that lies in several are digested
    in order, one at a time, as its digest has to be.
    """
    ends = steps.where("last").select("lo", "hi", "conv_id").repartitionByRange(parts, "lo", "hi", "conv_id").select(
        "*", F.spark_partition_id().alias("part"))
    blocks = settle(ends.groupBy("lo", "hi", "part").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("block")), "trie-ends")
    many = blocks.groupBy("lo", "hi").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    one = blocks.join(many, ["lo", "hi"], "left_anti").select("lo", "hi", F.sha2("block", 256).alias("ends_sha256"))
    streamed = blocks.join(many, ["lo", "hi"]).repartition("lo", "hi").sortWithinPartitions("lo", "hi", "part").select(
        "lo", "hi", "block").mapInArrow(_stream_digests, "lo long, hi long, ends_sha256 string")
    return one.union(streamed)


def prefix_trie(turns: DataFrame, rows_in_shard: int = ROWS_IN_SHARD) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``, a row for each node.

    ``turns`` has ``conv_id, turn, role, text``; other columns are not read. Conversations are ordered by
    turn, a null turn first, equal turns by the SHA-256 of the role's byte count, ``:``, the role and the text; null role or text is empty; repeated rows
    are turns of their own; texts are digested whole, where they are read. Every conversation is rebuilt (`rebuilt_steps`): it begins with turns of
    the first conversation of its family of a hundred. Rows without ``conv_id`` are in no conversation and give
    nothing; an empty table gives no rows, not even the root. Ids below zero belong to the family of the next
    larger multiple of a hundred.

    ``conv_id`` is a node's smallest member; ``n_leaves`` and ``saved_tokens`` sum over its subtree.
    """
    steps = settle(rebuilt_steps(turns, rows_in_shard), "trie-prefixes")
    local = settle(steps.groupBy(*SHARD).applyInPandas(_local_nodes, LOCAL), "trie-local")
    node, up = ["lo", "hi"], ["up_lo", "up_hi"]

    merged = settle(local.groupBy(*node).agg(
        *[F.min(c).alias(c) for c in (*up, "depth", "chars", "conv_id")], F.sum("n_convs").alias("n_convs"),
        F.max(F.struct(*up, "depth", "chars")).alias("most"), F.min(F.struct(*up, "depth", "chars")).alias("least")), "trie-merged")
    if not merged.where(F.col("most") != F.col("least")).isEmpty():
        raise ValueError("two prefixes share a digest")
    children = merged.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children")).withColumnsRenamed({"up_lo": "lo", "up_hi": "hi"})
    nodes = settle(merged.drop("most", "least").join(children, node, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")

    # a node weighs in the shard of its smallest member alone
    known = nodes.select(*node, F.col("conv_id").alias("owner"), F.col("n_convs").alias("all_convs"), "n_children")
    weighed = local.join(known, node).withColumn("own", F.col("conv_id") == F.col("owner"))
    weighed = weighed.select(
        *SHARD, *node, *up, "depth", F.col("owner").alias("conv_id"), "own", "tail_of",
        F.when(F.col("own") & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("leaf_weight"),
        F.when(F.col("own"), (F.col("all_convs") - 1) * F.col("chars")).otherwise(F.lit(0)).cast("long").alias("token_weight"))
    weighed = settle(weighed, "trie-weighed")
    # a long conversation's spans: what weighs in later ones, and who owns the node that the span before ends in
    in_order = Window.partitionBy("alone").orderBy("split")
    later = in_order.rowsBetween(1, Window.unboundedFollowing)
    spans = weighed.where(F.col("alone").isNotNull()).groupBy(*SHARD).agg(
        F.sum("leaf_weight").alias("l"), F.sum("token_weight").alias("t"),
        F.max(F.when(F.col("tail_of").isNotNull(), F.col("conv_id"))).alias("owner")).select(
        F.col("split").alias("of_split"), F.col("alone").alias("of"), F.lag("owner").over(in_order).alias("owner_before"),
        *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in ("l", "t")])
    weighed = weighed.join(spans, (F.col("alone") == F.col("of")) & (F.col("split") == F.col("of_split")), "left")
    for weight, more in (("leaf_weight", "l_later"), ("token_weight", "t_later")):
        weighed = weighed.withColumn(weight, F.col(weight) + F.when(F.col("tail_of").isNotNull(), F.coalesce(more, F.lit(0))).otherwise(0))
    sums = weighed.groupBy(*SHARD).applyInPandas(_subtree_sums, SUMS)
    sums = sums.groupBy(*node).agg(F.max("parent_conv_id").alias("parent_conv_id"), F.sum("n_leaves").alias("n_leaves"),
                                   F.sum("saved_tokens").alias("saved_tokens"))
    ends = end_digests(steps, parts_for(turns, rows_in_shard))
    return nodes.join(sums, node).join(ends, node, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


# crc32 of a decimal number's text, bit by bit
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(cast(conv_id as varchar), ''),
  lambda c: cast(ascii(c) as bigint))), lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0],
  lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

ORACLE = f"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
own as (
  select conv_id, length(text) as chars, sha256(strlen(role) || ':' || role || text) as said,
         row_number() over (partition by conv_id order by turn nulls first, sha256(strlen(role) || ':' || role || text)) - 1 as place
  from said),
convs as (select conv_id, conv_id - conv_id % 100 as family, {_CRC} % 6 as head from (select distinct conv_id from own)),
rebuilt as (
  select c.conv_id, 0 as part, o.place, o.said, o.chars from convs c join own o on o.conv_id = c.family and o.place < c.head
  union all
  select c.conv_id, 1, o.place, o.said, o.chars from convs c join own o on o.conv_id = c.conv_id and o.place >= c.head),
placed as (select *, row_number() over (partition by conv_id order by part, place) as depth from rebuilt),
steps as (
  select conv_id, depth, chars, sha256(string_agg(said, ' ') over (partition by conv_id order by depth rows unbounded preceding)) as node
  from placed
  union all select conv_id, 0, 0, '' from convs),
lengths as (select conv_id, max(depth) as length from steps group by conv_id),
nodes as (select node, min(depth) as depth, min(chars) as chars, min(s.conv_id) as conv_id, count(*) as n_convs,
                 coalesce(string_agg(cast(s.conv_id as varchar), ',' order by s.conv_id) filter (depth = length), '') as ends
          from steps s join lengths using (conv_id) group by node),
family as (select distinct b.node, a.node as parent from steps a join steps b on a.conv_id = b.conv_id and b.depth = a.depth + 1),
kids as (select parent as node, count(*) as n_children from family group by parent),
below as (select distinct a.node, b.node as lower from steps a join steps b on a.conv_id = b.conv_id and b.depth >= a.depth),
sums as (select b.node, count(*) filter (k.node is null) as n_leaves, sum((n.n_convs - 1) * n.chars) as saved
         from below b join nodes n on n.node = b.lower left join kids k on k.node = b.lower group by b.node)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children,
       s.n_leaves, cast(s.saved as bigint) as saved_tokens, sha256(n.ends) as ends_sha256
from nodes n join sums s on s.node = n.node left join kids k on k.node = n.node
left join family f on f.node = n.node left join nodes p on p.node = f.parent
"""
