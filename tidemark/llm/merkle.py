"""Merkle manifest of a dataset as a persistent, path-copying tree.

Every row is a leaf; per ``lang`` the leaves, ascending by ``doc_id``, are folded by
twos to a subroot, and the subroots to the root. The tree is cut into aligned
blocks of ``2 ** LEVELS`` nodes: one task folds a block, the roots of the blocks are the
nodes of the next round, and so on up. On the way down every block gets the
siblings of the path from its root to the root of all.

A changed leaf makes a version of the tree. A version shares all nodes but the ancestors of its
leaf: those inside the leaf's block are copied there, those above are copied on along the
block's path, so no task holds the versions of more than one block.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parts_for, places, settle

LEVELS = 8  # of a block: 256 nodes
ROWS_IN_TASK = 1 << 20
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
GROUP = ["known", "lang_key"]  # the lang: 0 and '' for null, else 1 and the lang
NODES = "known int, lang_key string, place long, of long, hash string"
PATHS = "known int, lang_key string, place long, hash string, path array<string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold(nodes: list[str], levels: int) -> list[list[str]]:
    """A block's nodes, level by level: every two become their digest, a last one its own."""
    tree = [nodes]
    for _ in range(levels):
        low = tree[-1]
        tree.append([digest("".join(low[i:i + 2])) for i in range(0, len(low), 2)])
    return tree


def siblings(tree: list[list[str]], at: int) -> list[str]:
    """From a node up: ``<`` and the left sibling, ``>`` and the right one, or nothing where a run has one node."""
    path = []
    for level in tree[:-1]:
        other = at ^ 1
        path.append(("<" if other < at else ">") + level[other] if other < len(level) else "")
        at >>= 1
    return path


def copies(node: str, path: list[str]) -> list[str]:
    """The node and its ancestors up to the root, made anew along ``path``."""
    out = [node]
    for side in path:
        out.append(digest(side[1:] + out[-1] if side[:1] == "<" else out[-1] + side[1:]))
    return out


def levels_of(nodes: int) -> int:
    """How far a block is folded where its lang has so many nodes."""
    return min(LEVELS, (nodes - 1).bit_length())


def _block_root(key, rows):
    import pandas as pd

    rows, of = rows.sort_values("place"), int(rows["of"].iloc[0])
    top = fold(list(rows["hash"]), levels_of(of))[-1][0]
    return pd.DataFrame({"known": [key[0]], "lang_key": [key[1]], "place": [key[2]], "of": [-(-of >> LEVELS)], "hash": [top]})


def _block_paths(key, rows):
    import pandas as pd

    rows = rows.sort_values("place")
    tree = fold(list(rows["hash"]), levels_of(int(rows["of"].iloc[0])))
    return pd.DataFrame({"known": rows["known"], "lang_key": rows["lang_key"], "place": rows["place"], "hash": rows["hash"],
                         "path": [siblings(tree, i) for i in range(len(rows))]})


def _block(place: str = "place") -> Column:
    return F.shiftright(place, LEVELS).alias("block")


def _climb(leaves: DataFrame) -> list[DataFrame]:
    """``NODES`` of every round above the leaves; in the last each lang has one."""
    rounds, most = [], leaves.agg(F.max("of")).first()[0]
    nodes = leaves
    while not rounds or most > 1:
        nodes = settle(nodes.select("known", "lang_key", "place", "of", "hash").groupBy(*GROUP, _block()).applyInPandas(
            _block_root, NODES), "merkle-nodes")
        rounds.append(nodes)
        most = -(-most >> LEVELS)
    return rounds


def _descend(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``PATHS`` of the nodes of a round: siblings in their block, then ``above``, the path of its root."""
    own = nodes.groupBy(*GROUP, _block()).applyInPandas(_block_paths, PATHS)
    above = above.select(*GROUP, F.col("place").alias("block"), F.col("path").alias("rest"))
    return own.withColumn("block", _block()).join(above, [*GROUP, "block"]).select(
        *GROUP, "place", "hash", F.concat("path", "rest").alias("path"))


def _prove(leaves, above):
    """Proofs and versions of a block's leaves; ``above`` is the one row with the path of its root."""
    import pandas as pd

    leaves, rest = leaves.sort_values("place"), list(above["path"].iloc[0])
    tree = fold(list(leaves["hash"]), levels_of(int(leaves["of"].iloc[0])))
    proofs = [siblings(tree, i) + rest for i in range(len(leaves))]
    nodes = [copies(new or old, p) for old, new, p in zip(leaves["hash"], leaves["changed"], proofs)]
    return pd.DataFrame({
        "doc_id": leaves["doc_id"], "known": leaves["known"], "lang_key": leaves["lang_key"], "place": leaves["place"],
        "leaf": leaves["hash"], "proof": proofs,
        "copied": [n if new else [] for n, new in zip(nodes, leaves["changed"])], "folded_root": [n[-1] for n in nodes]})


PROVEN = ("doc_id long, known int, lang_key string, place long, leaf string, proof array<string>, "
          "copied array<string>, folded_root string")


def leaf_of(more_chars: int = 0) -> Column:
    """Digest of a row's fields, each ``-`` if null, else UTF-8 byte count, colon and value."""
    def part(name: str) -> Column:
        value = F.col(name)
        if name == "n_chars" and more_chars:
            value = value.cast("decimal(20,0)") + more_chars
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(n) for n in FIELDS]), 256)


def tampered() -> Column:
    """Rows whose ``n_chars`` is changed: 7 divides the crc32 of the id's text. A null id or count is never changed."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return F.coalesce(hit, F.lit(False)) & F.col("n_chars").isNotNull()


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """``doc_id, lang, place, leaf, subroot, root, proof, copied, folded_root``, a row for each row of ``docs``.

    ``docs`` has the columns of ``FIELDS``; others are not read. ``proof`` lists the siblings from the
    leaf to the root, marked ``<`` (left) or ``>`` (right), empty where a run has one node. Rows that ``changed``
    selects get one more character in ``n_chars``; ``copied`` then holds the nodes of their version,
    from the new leaf to its root, and is empty for others. ``folded_root`` is that root, or
    the one that the row's own leaf folds to.

    Leaves of a lang are ordered by (doc_id, leaf), a null id first; a null lang is a
    lang of its own and comes first, the others in the order of their bytes. Repeated rows are leaves of their own. Null
    fields and empty texts have digests that tell them apart; a long text is digested whole, where it is read. A lang with
    one leaf has that as its subroot, a single lang's subroot is the root; an empty
    table gives no rows.
    """
    changed = tampered() if changed is None else changed
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").isNotNull().cast("int").alias("known"),
        F.coalesce("lang", F.lit("")).alias("lang_key"), leaf_of().alias("hash"),
        F.when(changed, leaf_of(1)).alias("changed"))
    leaves = settle(places(leaves, GROUP, ["doc_id", "hash"], "merkle-leaves", parts_for(docs, ROWS_IN_TASK)), "merkle-places")
    if leaves.isEmpty():
        return leaves.select("doc_id", F.lit("").alias("lang"), "place", F.col("hash").alias("leaf"), *[
            F.lit("").alias(c) for c in ("subroot", "root")], *[F.array().cast("array<string>").alias(c) for c in ("proof", "copied")],
            F.lit("").alias("folded_root"))
    rounds = _climb(leaves)

    # the subroots are the leaves of one more tree, whose rows remember their lang
    langs = rounds[-1].select(F.lit(0).alias("all"), "known", "lang_key", "hash")
    langs = settle(places(langs, ["all"], GROUP, "merkle-langs", parts_for(langs, ROWS_IN_TASK)), "merkle-langs")
    top = langs.select(F.lit(0).alias("known"), F.lit("").alias("lang_key"), "place", "of", "hash")
    tops = _climb(top)
    root = tops[-1].first()["hash"]
    no_path = F.array().cast("array<string>")
    paths = tops[-1].select(*GROUP, "place", "hash", no_path.alias("path"))
    for nodes in [*reversed(tops[:-1]), top]:
        paths = settle(_descend(nodes, paths), "merkle-paths")
    paths = langs.select(*GROUP, F.col("place").alias("lang_place")).join(
        paths.select(F.col("place").alias("lang_place"), "hash", "path"), "lang_place").select(
        *GROUP, F.lit(0).cast("long").alias("place"), F.col("hash").alias("subroot"), "path")
    subroots = settle(paths, "merkle-subroots")

    paths = subroots
    for nodes in reversed(rounds[:-1]):
        paths = settle(_descend(nodes, paths), "merkle-paths")
    proven = leaves.withColumn("block", _block()).groupBy(*GROUP, "block").cogroup(
        paths.select(*GROUP, F.col("place").alias("block"), "path").groupBy(*GROUP, "block")).applyInPandas(_prove, PROVEN)
    proven = settle(proven, "merkle-proofs")  # the join on the lang can then split a lang with most rows
    return proven.join(subroots.select(*GROUP, "subroot"), GROUP).select(
        "doc_id", F.when(F.col("known") == 1, F.col("lang_key")).alias("lang"), "place", "leaf", "subroot",
        F.lit(root).alias("root"), "proof", "copied", "folded_root")


def digests(found: DataFrame) -> DataFrame:
    """The columns of a manifest that are compared: proofs as one digest, and whether the row's leaf leads to the root."""
    bare = F.concat_ws("", F.transform("proof", lambda s: F.substring(s, 2, 64)))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(bare, 256).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


# crc32 of a decimal number's text, bit by bit
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
  lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _part(value: str) -> str:
    return f"coalesce(cast(strlen(cast({value} as varchar)) as varchar) || ':' || cast({value} as varchar), '-')"


def _sql_leaf(chars: str) -> str:
    return "sha256(" + " || ".join(_part(v) for v in ("doc_id", "source", "lang", chars, "text")) + ")"


ORACLE = f"""
with recursive l as (
  select doc_id, lang, {_sql_leaf('n_chars')} as leaf,
         case when {_CRC} % 7 = 0 then {_sql_leaf('(cast(n_chars as hugeint) + 1)')} else {_sql_leaf('n_chars')} end as held
  from documents),
p as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place from l),
t(lang, level, place, hash, n) as (
  select lang, 0, place, leaf, count(*) over (partition by lang) from p
  union all
  select lang, level + 1, place // 2, sha256(string_agg(hash, '' order by place)), (n + 1) // 2
  from t where n > 1 group by lang, level, place // 2, n),
subs as (select lang, hash as subroot, row_number() over (order by lang nulls first) - 1 as seat, count(*) over () as n from t where n = 1),
u(level, place, hash, n) as (
  select 0, seat, subroot, n from subs
  union all
  select level + 1, place // 2, sha256(string_agg(hash, '' order by place)), (n + 1) // 2 from u where n > 1 group by level, place // 2, n),
heights as (select lang, max(level) as height from t group by lang),
walk as (
  select p.lang, p.place, t.level as step, t.hash as sibling, t.place < p.place >> t.level as on_left
  from p join t on t.lang is not distinct from p.lang and t.n > 1 and t.place = xor(p.place >> t.level, 1)
  union all
  select p.lang, p.place, heights.height + u.level, u.hash, u.place < subs.seat >> u.level
  from p join heights on heights.lang is not distinct from p.lang join subs on subs.lang is not distinct from p.lang
  join u on u.n > 1 and u.place = xor(subs.seat >> u.level, 1)),
proofs as (select lang, place, string_agg(sibling, '' order by step) as proof from walk group by lang, place),
total as (select (select max(level) from u) as upper, (select hash from u where n = 1) as root),
f(lang, place, step, hash) as (
  select lang, place, 0, held from p
  union all
  select f.lang, f.place, f.step + 1, case when w.sibling is null then sha256(f.hash) when w.on_left then sha256(w.sibling || f.hash)
                                           else sha256(f.hash || w.sibling) end
  from f join heights h on h.lang is not distinct from f.lang cross join total
  left join walk w on w.lang is not distinct from f.lang and w.place = f.place and w.step = f.step
  where f.step < h.height + total.upper)
select p.doc_id, p.leaf, subs.subroot, total.root, sha256(coalesce(proofs.proof, '')) as proof_sha256,
       f.hash as folded_root, f.hash = total.root as verified
from p join subs on subs.lang is not distinct from p.lang cross join total
join heights h on h.lang is not distinct from p.lang
join f on f.lang is not distinct from p.lang and f.place = p.place and f.step = h.height + total.upper
left join proofs on proofs.lang is not distinct from p.lang and proofs.place = p.place
"""
