"""Benchmark decontamination by CGK embedding and bit sampling.

Documents and benchmark items are sequences of words. The CGK random walk reads
a sequence: at step t it notes the word it stands on, then moves on by a random
bit that depends on t and the word. Sequences a few edits apart give walks
that fall in step again, so their embeddings differ in few places (Hamming).

All windows of a document, one from each word, are embedded and hashed by
sampled coordinates, and looked up among the items; this is repeated with new
bits and samples in every band. An item is embedded from every few words on,
so that edits in one part leave other parts to find it by; a hit there says where
the item-sized window begins. How many bands a class of items gets (those that
allow the same number of edits) follows from a target recall: edited copies of
its items, with as many edits as allowed, are looked up in band after band (six at least).
Items too short to sample, and classes that many bands do not bring to the
target, are cut into one piece more than the edits allowed, one of which is
then unchanged, and looked up by each of them. Windows found are verified by
exact edit distance.

Lookup goes coordinate by coordinate: a walk that no item shares so far ends.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import PIECE, slices, words

TOKENS = 1 << 20  # words scanned at a time
MOST_BANDS, MOST_EDITS = 12, 12  # bands of a class; edits from which items are one class
#: Letters and vowel signs of scripts written without blanks: Thai to Myanmar, Khmer, kana and Han.
UNSPACED = "\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0eb9\u0ebb-\u0ecd\u1000-\u103f\u1780-\u17d3\u3005-\u3007\u3041-\u3096\u30a1-\u30fa\u30fc-\u30fe\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U000323af"
UNSPACED_LETTER = re.compile(f"[{UNSPACED}]")
TOKEN = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
TOKEN_END = re.compile(rf"[\W{UNSPACED}]")
TRIALS = 600  # edited copies that a class is tried with


def tokens_of(text: str | None):
    """Lists of the words of the whole text in lower case; in scripts without blanks every letter is a word."""
    if not text or text.isascii() or not UNSPACED_LETTER.search(text):
        yield from words(text)
        return
    text = text.lower()
    at = 0
    while at < len(text):
        end = TOKEN_END.search(text, min(at + PIECE, len(text)))
        stop = end.start() if end else len(text)
        yield TOKEN.findall(text, at, stop)
        at = stop


class Items:
    """The hash tables of a set of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = 0.8, recall: float = 0.99, bands: int = 6, sampled: int = 6,
                 steps: int = 18, stride: int = 2, min_words: int = 1, seed: int = 1, plan: dict[int, int] | None = None):
        draw = np.random.default_rng(seed)
        self.vocabulary: dict[str, int] = {}
        self.ids: list[int] = []
        self.tokens: list[np.ndarray] = []
        self.edits: list[int] = []
        for item_id, text in items:
            found = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for part in tokens_of(text) for w in part]
            if item_id is not None and len(found) >= min_words:
                self.ids.append(item_id)
                self.tokens.append(np.array(found, dtype=np.int32))
                self.edits.append(int(len(found) * (1 - similarity) + 1e-9))
        self.size = len(self.vocabulary) + 2  # word 0 is any word that no item has, the last one is past a window's end
        self.steps, self.window, self.stride = steps, steps // 2, stride
        self.reach = max([len(t) + 2 * e for t, e in zip(self.tokens, self.edits)], default=0) + steps
        drawn = []
        for _ in range(MOST_BANDS):
            first = int(draw.integers(0, 3))
            rest = np.sort(draw.choice(np.arange(first + 2, steps, 2), size=sampled - 1, replace=False) + draw.integers(0, 2, sampled - 1))
            coordinates = [first, *np.minimum(rest, steps - 1).tolist()]
            drawn.append((coordinates, draw.integers(0, 2, size=(steps, self.size)).astype(np.int8)))
        #: bands of each class of items; none: by pieces
        self.plan = self._planned(drawn, recall, bands, draw) if plan is None else plan
        given = [self.plan.get(self._class(i), 0) for i in range(len(self.ids))]
        self.tables = [self._band(*band, [i for i, n in enumerate(given) if n > b]) for b, band in enumerate(drawn) if b < max(given, default=0)]
        keyed = {item for *_, leaves in self.tables for owners in leaves.values() for item, _ in owners}
        self.tables += self._pieces([i for i in range(len(self.ids)) if i not in keyed])

    def _class(self, item: int) -> int:
        """The edits an item allows, -1 for one that is too short to sample."""
        short = len(self.tokens[item]) <= self.window or self.edits[item] < 2
        return -1 if short else min(self.edits[item], MOST_EDITS)

    def _planned(self, drawn, recall: float, least: int, draw) -> dict[int, int]:
        """For each class the bands, ``least`` or more, after which its target is met; 0: too many.

        The copies missed have to be fewer than the target allows by two standard deviations.
        """
        classes: dict[int, list[int]] = {}
        for i in range(len(self.ids)):
            if self._class(i) >= 0:
                classes.setdefault(self._class(i), []).append(i)
        plan = {}
        for c, members in sorted(classes.items()):
            chosen = members[::-(-len(members) // TRIALS)]
            copies = [(i, _edited(self.tokens[i], self.edits[i], self.size - 1, draw)) for i in chosen * -(-TRIALS // len(chosen))]
            gap = np.zeros(self.reach, dtype=np.int32)
            x = np.concatenate([part for _, copy in copies for part in (copy, gap)])
            begins = np.cumsum([0] + [len(copy) + len(gap) for _, copy in copies[:-1]])
            met: set[int] = set()
            plan[c] = 0
            for b, band in enumerate(drawn):
                hits = self.candidates(x, [self._band(*band, chosen)])
                for start, item in hits:
                    k = max(0, int(np.searchsorted(begins, start + self.window, side="right")) - 1)
                    if copies[k][0] == item and abs(start - int(begins[k])) <= self.edits[item]:
                        met.add(k)
                allowed = len(copies) * (1 - recall)
                if b + 1 >= least and len(copies) - len(met) <= max(0, allowed - 2 * (allowed * recall) ** 0.5):
                    plan[c] = b + 1
                    break
        return plan

    def _band(self, coordinates: list[int], moves: np.ndarray, members: list[int]):
        """The table of the windows of some items under one walk."""
        owners = [(i, o) for i in members for o in sorted({*range(0, len(self.tokens[i]) - self.window, self.stride),
                                                          len(self.tokens[i]) - self.window})]
        begins = np.cumsum([0] + [len(self.tokens[i]) for i in members])
        from_ = dict(zip(members, begins.tolist()))
        x = np.concatenate([*(self.tokens[i] for i in members), np.zeros(self.steps + 1, dtype=np.int32)])
        begin = np.array([from_[i] + o for i, o in owners], dtype=np.int64)
        at, columns, t = begin.copy(), [], 0
        for coordinate in coordinates:
            while t < coordinate:
                at = at + moves[t][x[at]]
                t += 1
            columns.append(np.where(at - begin < self.window, x[at], self.size - 1))
        table = np.array(columns, dtype=np.int64).T.reshape(-1, len(coordinates))
        distinct = {i: min(4, len(set(self.tokens[i].tolist()))) for i in members}
        enough = [len(set(row)) >= distinct[i] for row, (i, _) in zip(table.tolist(), owners)]
        return self._table(coordinates, moves, table[np.array(enough, dtype=bool)], [o for o, e in zip(owners, enough) if e])

    def _pieces(self, members: list[int]):
        """Tables of whole pieces, by their words: one piece more than edits, so that one is unchanged."""
        by_words: dict[int, list[tuple[list[int], tuple[int, int]]]] = {}
        for i in members:
            tokens = self.tokens[i].tolist()
            n = min(self.edits[i] + 1, len(tokens))
            for k in range(n):
                lo, hi = k * len(tokens) // n, (k + 1) * len(tokens) // n
                by_words.setdefault(hi - lo, []).append((tokens[lo:hi], (i, lo)))
        return [self._table(list(range(n)), None, np.array([key for key, _ in found], dtype=np.int64), [owner for _, owner in found])
                for n, found in sorted(by_words.items())]

    def _table(self, coordinates: list[int], moves: np.ndarray | None, table: np.ndarray, owners: list[tuple[int, int]]):
        """(coordinates, moves, levels, leaves): sorted keys (node, word) of each level, and the items at the leaves."""
        node = np.zeros(len(table), dtype=np.int64)
        levels = []
        for c in range(len(coordinates)):
            level, node = np.unique(node * self.size + table[:, c], return_inverse=True)
            hint = np.zeros(1 << 20, dtype=bool)
            hint[_slot(level)] = True
            levels.append((level, hint))
        leaves: dict[int, list[tuple[int, int]]] = {}
        for leaf, owner in zip(node.tolist(), owners):
            leaves.setdefault(leaf, []).append(owner)
        return coordinates, moves, levels, leaves

    def word_ids(self, text: str | None) -> np.ndarray:
        get = self.vocabulary.get
        parts = [np.fromiter((get(w, 0) for w in part), dtype=np.int32, count=len(part)) for part in tokens_of(text)]
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)

    def candidates(self, x: np.ndarray, tables: list | None = None) -> set[tuple[int, int]]:
        """(start of the window, item) pairs that some table finds in the words ``x``."""
        out: set[tuple[int, int]] = set()
        n = len(x)
        x = np.concatenate([x, np.zeros(self.reach + 1, dtype=np.int32)])
        for coordinates, moves, levels, leaves in self.tables if tables is None else tables:
            at, begin, node, t = np.arange(n, dtype=np.int32), None, None, 0
            for c, coordinate in enumerate(coordinates):
                while t < coordinate:
                    at = at + (moves[t][x[at]] if moves is not None else 1)
                    t += 1
                word = x[at].astype(np.int64)
                if moves is not None and coordinate >= self.window:
                    word[at - begin >= self.window] = self.size - 1
                key = word if node is None else node * self.size + word
                level, hint = levels[c]
                near = np.flatnonzero(hint[_slot(key)])
                key = key[near]
                node = np.searchsorted(level, key)
                same = level[np.minimum(node, len(level) - 1)] == key if len(level) else np.zeros(len(key), dtype=bool)
                near, node = near[same], node[same]
                at = at[near]
                begin = near if begin is None else begin[near]
                if not len(near):
                    break
            else:
                for p, leaf in zip(begin.tolist(), node.tolist()):
                    out.update((p - offset, item) for item, offset in leaves[leaf])
        return out

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int, int]]]:
        """For each whole text, (item_id, distance, item words, start, stop) of the best window of each item found.

        ``start`` and ``stop`` count words. Equal distances: the earliest window. Texts
        are scanned together, with words of no item between them, a bounded number of
        words at a time; pieces of a long text overlap by more than a window.
        """
        if not self.ids:
            return [[] for _ in texts]
        read = [self.word_ids(t) for t in texts]
        gap = np.zeros(self.steps + 1, dtype=np.int32)
        best: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        spans: list[tuple[int, int, int]] = []  # text, from, to
        size = 0
        for i, x in enumerate(read):
            for lo in range(0, len(x), TOKENS):
                spans.append((i, lo, min(len(x), lo + TOKENS + self.reach)))
                size += spans[-1][2] - lo
                if size >= TOKENS:
                    self._scan(read, spans, gap, best)
                    spans, size = [], 0
        self._scan(read, spans, gap, best)
        return [[(self.ids[i], d, len(self.tokens[i]), a, b) for i, (d, a, b) in sorted(found.items())] for found in best]

    def _scan(self, read, spans, gap, best) -> None:
        if not spans:
            return
        joined = np.concatenate([part for i, lo, hi in spans for part in (read[i][lo:hi], gap)])
        ends = np.cumsum([hi - lo + len(gap) for _, lo, hi in spans])
        seen: dict[tuple[int, int], int] = {}
        for start, item in sorted(self.candidates(joined)):
            limit, length = self.edits[item], len(self.tokens[item])
            k = int(np.searchsorted(ends, max(start, 0) + length // 2, side="right"))
            if k >= len(spans) or start <= seen.get((k, item), -1 << 60):
                continue  # the window verified before holds this one
            seen[k, item] = start + limit // 2
            i, lo, hi = spans[k]
            begin = int(ends[k]) - (hi - lo + len(gap))
            first = max(0, start - begin - limit)
            last = min(hi - lo, start - begin + length + limit + limit // 2)
            found = best_window(self.tokens[item], read[i][lo + first:lo + last], limit) if first < last else None
            if found is not None:
                got = (found[0], lo + first + found[1], lo + first + found[2])
                best[i][item] = min(best[i].get(item, got), got)


def _edited(tokens: np.ndarray, edits: int, size: int, draw) -> np.ndarray:
    """A copy with so many words replaced, left out or put in, at random."""
    out = tokens.tolist()
    for kind, word, at in zip(draw.integers(0, 3, edits).tolist(), draw.integers(0, size, edits).tolist(), draw.random(edits).tolist()):
        i = int(at * len(out))
        out[i:i + (kind < 2)] = [] if kind == 1 else [word]
    return np.array(out, dtype=np.int32)


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key * 0x9E3779B97F4A7C1) >> 21) & ((1 << 20) - 1)


def edit_distances(pattern: list[int], text: list[int], anywhere: bool) -> list[int]:
    """Edit distance of ``pattern`` to ``text`` up to each of its words, bit-parallel in one number.

    ``anywhere``: the best substring that ends there, else the whole beginning.
    """
    m = len(pattern)
    where: dict[int, int] = {}
    for i, w in enumerate(pattern):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, out = full, 0, m, []
    for w in text:
        eq = where.get(w, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right_up = down | ~(diagonal | up) & full
        right_down = up & diagonal
        score += bool(right_up & top) - bool(right_down & top)
        right_up = (right_up << 1 | (not anywhere)) & full
        right_down = right_down << 1 & full
        up = right_down | ~(diagonal | right_up) & full
        down = right_up & diagonal
        out.append(score)
    return out


def best_window(item: np.ndarray, text: np.ndarray, limit: int) -> tuple[int, int, int] | None:
    """(distance, start, stop) of the closest window of ``text`` if within ``limit`` edits."""
    pattern, read = item.tolist(), text.tolist()
    ends = edit_distances(pattern, read, anywhere=True)
    if not ends or min(ends) > limit:
        return None
    distance = min(ends)
    stop = ends.index(distance) + 1
    back = edit_distances(pattern[::-1], read[:stop][::-1], anywhere=False)
    return distance, stop - 1 - back.index(distance), stop


def blocks(benchmark: DataFrame, block_bytes: int = 8 << 20):
    """Lists of (item_id, text), each of about ``block_bytes`` of text, one at a time on the driver.

    The items are a query set against all documents; each block is a pass over
    the documents, and what is broadcast stays within the bound whatever their number.
    """
    chosen = benchmark.where(F.col("text").isNotNull()).select("item_id", "text")
    total = chosen.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for i in range(n):
        part = chosen.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [tuple(r) for r in part.distinct().collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, keep: tuple[str, ...] = ("doc_id",),
               recall: float = 0.99) -> DataFrame:
    """``keep, item_id, distance, item_words, start, stop`` for every item found in a row of ``docs``.

    An item is found where a window of the text is within
    ``(1 - similarity) * words of the item`` word edits (case and what stands between
    words set aside); the best window is given. ``recall`` is the share of copies with the
    largest number of edits that each class of items is to find. In scripts written without blanks (Chinese,
    Japanese, Thai, ...) every letter is a word. Items of fewer than five words allow
    no edit and are found where all their words stand in a row. Null items and null
    item ids are not looked for. Null and
    empty texts have no leaks; texts of any length are read whole; repeated
    rows and items repeat results; an empty table gives no rows; other
    columns are not read.
    """
    chosen = docs.select(*keep, F.col("text").alias("__text"))
    schema = chosen.drop("__text").schema.add("item_id", "long")
    for name in ("distance", "item_words", "start", "stop"):
        schema = schema.add(name, "long")
    out = None
    for block in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast((block, Items(block, similarity, recall).plan))

        def run(batches, sent=sent):
            items = Items(sent.value[0], similarity, plan=sent.value[1])
            for batch in batches:
                rows, found = [], []
                for lo, hi in slices(batch.column("__text")):
                    for i, leaks in enumerate(items.find(batch.column("__text").slice(lo, hi - lo).to_pylist()), lo):
                        rows += [i] * len(leaks)
                        found += leaks
                taken = batch.take(pa.array(rows, pa.int64()))
                columns = [taken.column(i) for i in range(len(keep))]
                columns += [pa.array([f[i] for f in found], pa.int64()) for i in range(5)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        leaks = chosen.mapInArrow(run, schema)
        out = leaks if out is None else out.union(leaks)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.99) -> DataFrame:
    """``docs`` without the rows in which an item of ``benchmark`` is found; rows are not shuffled.

    Null and empty texts hold no item and stay, as do all rows where there is no item; whole texts are searched,
    however long; repeated rows stay or go alike; all columns, whatever their names, are passed on; an empty table gives no rows.
    """
    at = docs.columns.index("text")
    for block in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast((block, Items(block, similarity, recall).plan))

        def run(batches, sent=sent):
            items = Items(sent.value[0], similarity, plan=sent.value[1])
            for batch in batches:
                clean = [not leaks for lo, hi in slices(batch.column(at))
                         for leaks in items.find(batch.column(at).slice(lo, hi - lo).to_pylist())]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
