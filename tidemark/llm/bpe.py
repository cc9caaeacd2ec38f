"""Byte-level BPE: backtracking encoder and offset-table decoder.

The exact merge result of a piece is built from left to right: an Aho-Corasick
automaton gives the longest token that starts at a position; a token is taken if
it may stand after the one before it (the merges of the two tokens' bytes give
just these two tokens), else the next shorter one, else the last token taken is
given up. Positions found to be dead ends are marked, so each is tried once and
the work is linear.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import slices

#: Bounds of the tables kept in a task; what is dropped from them is made again.
MOST_PARTS, LONGEST_KEPT, MOST_PAIRS = 300_000, 64, 200_000

# The split pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # what \s stands for in it

PIECE = 1 << 20  # characters encoded at a time
SAFE = re.compile(f"[^{BLANKS}](?= [^{BLANKS}])")  # the pattern cuts after this in any case

# Runs without blanks, or of blanks, cut where the pattern cuts in any case: most of a text is runs met before.
RUN = re.compile(f" ?[^{BLANKS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Bpe:
    """Encoder and decoder of one vocabulary.

    ``tokens``: id to bytes; ``merges``: (left id, right id) to (rank, merged id);
    ``special``: text to id, matched in the text before anything else.
    """

    def __init__(self, tokens: dict[int, bytes], merges: dict[tuple[int, int], tuple[int, int]], special: dict[str, int]):
        self.special = special
        self.ids = {t: i for i, t in tokens.items()}
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError("a byte-level vocabulary has a token for each byte")
        self.merges = merges
        self.size = {i: len(t) for i, t in tokens.items()}
        # token: (left part, right part, rank of the merge), for tokens that merging their own bytes gives
        self.parts: dict[int, tuple[int, int, int]] = {}
        for (left, right), (rank, made) in sorted(merges.items(), key=lambda m: m[1][0]):
            whole = all(self.size[x] == 1 or x in self.parts for x in (left, right))
            if made not in self.parts and whole and self._apart(left, right, rank):
                self.parts[made] = (left, right, rank)
        usable = {t: i for t, i in self.ids.items() if len(t) == 1 or i in self.parts}
        self.whole = usable
        self.shorter: dict[int, int] = {}  # the longest usable token that is a proper prefix
        for token, i in usable.items():
            found = next((usable[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in usable), None)
            if found is not None:
                self.shorter[i] = found
        self.widest = max(map(len, usable))
        self.automaton = ahocorasick.Automaton()
        for token, i in usable.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.runs, self.pieces = _Made(self._run), _Made(self._piece)
        # decoding: the bytes of id i are blob[offsets[i]:offsets[i + 1]]
        every = tokens | {i: s.encode("utf-8") for s, i in special.items()}
        top = max(every) + 1
        self.offsets = np.cumsum([0, *(len(every.get(i, b"")) for i in range(top))])
        self.blob = np.frombuffer(b"".join(every.get(i, b"") for i in range(top)), dtype=np.uint8)
        self.cut = regex.compile(PATTERN)
        self.marks = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    @classmethod
    def from_json(cls, path: str) -> Bpe:
        """A ``tokenizer.json`` with byte-level BPE, without normalizer or added prefix space."""
        with open(path, encoding="utf-8") as f:
            return cls.from_text(f.read())

    @classmethod
    def from_text(cls, text: str) -> Bpe:
        spec = json.loads(text)
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("not a plain byte-level BPE")
        alphabet = byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = lambda word: bytes(alphabet[c] for c in word)
        vocab = {w: i for w, i in spec["model"]["vocab"].items() if w not in special}
        merges = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        return cls({i: raw(w) for w, i in vocab.items()}, merges, special)

    def compatible(self, left: int, right: int) -> bool:
        """May ``right`` follow ``left`` in the merge result of a piece? Kept in a table."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._apart(left, right, 1 << 60)
        return known

    def _apart(self, left: int, right: int, limit: int) -> bool:
        """True if no merge across the boundary has its turn before those that made both tokens and ``limit``.

        The tokens are taken apart at the boundary, the latest merge first. Of
        merges with one rank the leftmost has its turn first.
        """
        while True:
            across = self.merges.get((left, right))
            if across is not None and across[0] < limit:
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[2] > b[2]):
                limit, left = a[2], a[1]
            else:
                limit, right = b[2] + 1, b[0]

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece of the split text."""
        data = piece.encode("utf-8")
        if data in self.whole:
            return [self.whole[data]]
        n, read = len(data), data.decode("latin-1")
        size, shorter, fits = self.size, self.shorter, self.compatible
        out = [token for _, token in self.automaton.iter_long(read)]
        if all(map(fits, out, out[1:])):
            return out  # the longest matches one after the other are the merges already
        out = []
        dead = bytearray(n + 1)
        at, token = 0, self._longest(read, 0)
        while at < n:
            end = at + size[token]
            if not dead[end] and (not out or fits(out[-1], token)):
                out.append(token)
                at = end
                if end < n:
                    token = self._longest(read, end)
            elif token in shorter:
                token = shorter[token]
            else:  # nothing can start here: give up the token before
                dead[at] = 1
                token = out.pop()
                at -= size[token]
        return out

    def _longest(self, read: str, at: int) -> int:
        """The longest token that starts at ``at``; each byte is one, so the leftmost match starts there."""
        return next(self.automaton.iter_long(read, at, min(len(read), at + self.widest)))[1]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the whole text, unsigned 32-bit; null is empty."""
        text = text or ""
        found, at = [], 0
        for mark in self.marks.finditer(text) if self.marks else ():
            found += self._plain(text, at, mark.start())
            found.append(_bytes([self.special[mark[0]]]))
            at = mark.end()
        found += self._plain(text, at, len(text))
        return np.frombuffer(b"".join(found), dtype="<u4")

    def _plain(self, text: str, at: int, end: int):
        """Ids of text[at:end], which is plain text, as bytes for some MB at a time."""
        while at < end:
            cut = SAFE.search(text, at + PIECE, end) if end - at > PIECE else None
            stop = cut.start() + 1 if cut else end
            yield b"".join(map(self.runs.__getitem__, RUN.findall(text[at:stop])))
            at = stop

    def _piece(self, piece: str) -> bytes:
        return _bytes(self.encode_piece(piece))

    def _run(self, run: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.cut.findall(run)))

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids``, gathered through the offset table; unknown ids are nothing."""
        out = []
        for at in range(0, len(ids), 1 << 18):
            some = ids[at:at + (1 << 18)].astype(np.int64)
            some = some[(some >= 0) & (some < len(self.offsets) - 1)]
            starts = self.offsets[some]
            sizes = self.offsets[some + 1] - starts
            before = np.cumsum(sizes) - sizes
            out.append(self.blob[np.repeat(starts - before, sizes) + np.arange(sizes.sum())].tobytes())
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; bytes that are not UTF-8 become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Made(dict):
    """A part of a text to its ids as little-endian bytes, made on first use; holds a bounded number."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, part: str) -> bytes:
        ids = self.make(part)
        if len(part) <= LONGEST_KEPT:
            if len(self) >= MOST_PARTS:
                self.clear()
            self[part] = ids
        return ids


def tokenize(docs: DataFrame, vocabulary: str, with_ids: bool = True, with_text: bool = False, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids`` and the ``decoded`` text of every row.

    ``vocabulary`` is the path of a ``tokenizer.json`` that the driver reads and
    broadcasts: a fixed file of some MB. The digests are of the ids as
    little-endian unsigned 32-bit integers and of the text decoded from them in
    UTF-8. Null and empty texts have no tokens; a text of any length is taken
    whole, piece by piece; repeated rows are rows of their own; an empty table
    gives no rows; other columns are not read.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    chosen = docs.select(*keep, F.col("text").alias("__text"))
    schema = chosen.drop("__text").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    if with_text:
        schema = schema.add("decoded", "string")

    def run(batches):
        bpe = Bpe.from_text(spec.value)
        for batch in batches:
            texts = batch.column("__text")
            for at, stop in slices(texts):
                made = [bpe.encode(t.as_py()) for t in texts.slice(at, stop - at)]
                decoded = [bpe.decode(i).encode("utf-8") for i in made]
                columns = [batch.column(i).slice(at, stop - at) for i in range(len(keep))] + [
                    pa.array([len(i) for i in made], pa.int64()),
                    pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in made]),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded])]
                if with_ids:
                    ends = np.cumsum([0, *map(len, made)])
                    flat = np.concatenate(made) if made else np.empty(0)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32))))
                if with_text:
                    columns.append(pa.array([d.decode("utf-8") for d in decoded], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return chosen.mapInArrow(run, schema)

