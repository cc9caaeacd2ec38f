"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child makes a hash
draw of its own, ``-ln(u) / weight`` with ``u`` from the row key and the
child's name, and the smallest draw wins: a child gets its weight's share,
and a change of one child's weight changes only that child's draw.

A shard added to a tree raises the weight of its rack and region. That
increment is a draw of its own beside the regions' draws, named after the new
shard; a row that it wins descends along the path that grew, to the new
shard. All other draws stay, so added shards take rows only into themselves.
Lowering a base weight lowers that of the region and rack above it: rows leave
these subtrees, or move within the region, and no others move.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import settle


@dataclass(frozen=True)
class HashTree:
    """``base``: (region, rack, shard, weight) rows; ``added``: the same for shards that came later."""

    base: tuple[tuple[str, str, int, float], ...]
    added: tuple[tuple[str, str, int, float], ...] = field(default=())

    def __post_init__(self):
        if not self.base or any(w <= 0 for *_, w in self.base + self.added):
            raise ValueError("a tree needs base shards, and weights above zero")
        if len({s for _, _, s, _ in self.base}) < len(self.base):
            raise ValueError("a base shard stands at one place only")

    def grow(self, region: str, rack: str, shard: int, weight: float = 1.0) -> HashTree:
        return HashTree(self.base, self.added + ((region, rack, shard, weight),))


def even_tree(shards: int, regions: int = 4, racks: int = 2) -> HashTree:
    """Equal shards dealt over ``regions`` with ``racks`` racks each."""
    return HashTree(tuple((f"region{s % regions}", f"rack{s // regions % racks}", s, 1.0) for s in range(shards)))


#: A child of a tree node: its draw is named and weighted; ``next`` is the node below it, or ``shard`` the end of the way.
CHILD = "struct<name:string,weight:double,pick:int,next:string,shard:int>"


def _children(tree: HashTree) -> dict[str, list[tuple]]:
    """The children of the top (``""``), of every region and of every rack (``region/rack``)."""
    out: dict[str, list[tuple]] = {"": []}
    regions = sorted({r for r, *_ in tree.base})
    for i, region in enumerate(regions):
        here = [x for x in tree.base if x[0] == region]
        out[""].append((region, sum(w for *_, w in here), i, region, None))
        out[region] = []
        for j, rack in enumerate(sorted({k for _, k, _, _ in here})):
            path, shards = f"{region}/{rack}", [(s, w) for _, k, s, w in here if k == rack]
            out[region].append((path, sum(w for _, w in shards), j, path, None))
            out[path] = [(f"{path}/{s}", w, s, None, s) for s, w in shards]
    for n, (r, k, s, w) in enumerate(tree.added):  # increments draw beside the regions and lead to the new shard
        out[""].append((f"{r}/{k}/{s}+{n}", w, len(regions) + n, None, s))
    return out


def shard_of(key: Column, tree: HashTree) -> Column:
    """Shard of a row key. Only the key and the tree decide; null keys share one shard.

    The tree is one constant map from a node to its children, which a row descends in three steps: the plan is
    the same for any number of shards, and a row draws for the children on its way alone.
    """
    names = ("name", "weight", "pick", "next", "shard")
    rows = {path: [dict(zip(names, c)) for c in children] for path, children in _children(tree).items()}
    nodes = F.from_json(F.lit(json.dumps(rows)), f"map<string,array<{CHILD}>>")

    def draw(c: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(c["name"], key), 11).cast("double") + 0.5) * (2.0 ** -53)
        return -F.log(u) / c["weight"]

    def winner(path: Column) -> Column:
        """The child of smallest draw; equal draws: the smallest pick."""
        return F.array_min(F.transform(F.element_at(nodes, path), lambda c: F.struct(
            draw(c).alias("draw"), c["pick"].alias("pick"), c["next"].alias("next"), c["shard"].alias("shard"))))

    region = winner(F.lit(""))
    return F.coalesce(region["shard"], winner(winner(region["next"])["next"])["shard"])


def shard_documents(docs: DataFrame, tree: HashTree, grown: HashTree, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    ``slot`` counts the rows of a shard without gaps from 0, in the order of the
    written assignment: rows are numbered within (input split, shard) and moved
    up by the number of earlier rows of the shard, so no task holds a whole
    shard. Null text has size 16 and the checksum of the empty text; repeated
    rows and null keys go to the shard of their key and get slots of their
    own; an empty table gives no rows; other columns are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    placed = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        shard_of(F.col(key), tree).alias("shard"),
        shard_of(F.col(key), grown).alias("grown_shard"),
        F.spark_partition_id().alias("split"),
        F.monotonically_increasing_id().alias("seq"))
    placed = settle(placed, "shards")
    counts = placed.groupBy("shard", "split").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select("shard", "split", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("shard", "split").orderBy("seq")) - 1
    numbered = placed.select("*", rank.alias("rank"))
    return numbered.join(start, ["shard", "split"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("rank")).cast("long").alias("slot"), "grown_shard")
