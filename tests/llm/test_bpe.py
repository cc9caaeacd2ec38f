import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    return bpe.Bpe.from_json(PATH), Tokenizer.from_file(PATH)


PARTS = [" ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", " ", "​", "﻿", "a", "the", "ing", "'s", "'S", "'ll",
         "1", "½", "Ⅷ", "٣", "é", "é", "中文", "😀", "\x00", "<|endoftext|>", "<|end", "aaaa", "_", "...", "ªº"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=6))).map("".join))
def test_same_ids_and_text_as_the_library(both, text):
    mine, library = both
    want = library.encode(text, add_special_tokens=False).ids
    assert mine.encode(text).tolist() == want
    assert mine.decode(np.array(want, dtype=np.uint32)) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join))
def test_pieces_of_long_texts(both, text):
    kept, bpe.PIECE = bpe.PIECE, 5
    try:
        assert both[0].encode(text).tolist() == both[1].encode(text, add_special_tokens=False).ids
    finally:
        bpe.PIECE = kept


@pytest.mark.parametrize("text", ["a" * 60_000, " " * 30_000, "ab" * 20_000, "é" * 10_000, "the" * 9_999, "0" * 20_000])
def test_very_long_pieces(both, text):
    assert both[0].encode(text).tolist() == both[1].encode(text, add_special_tokens=False).ids


def test_every_token_is_its_own_encoding_or_unusable(both):
    mine, library = both
    for data, i in list(mine.ids.items())[::97]:
        if data in mine.whole and data.isascii() and data.isalpha():
            assert library.encode(data.decode(), add_special_tokens=False).ids == [i]


def test_small_vocabulary_needs_backtracking():
    tokens = {i: bytes([i]) for i in range(256)}
    names = ["ab", "bc", "abc", "cd", "bcd"]
    tokens |= {256 + i: n.encode() for i, n in enumerate(names)}
    ids = {v: k for k, v in tokens.items()}
    pairs = [(b"b", b"c"), (b"a", b"b"), (b"ab", b"c"), (b"c", b"d"), (b"b", b"cd")]
    merges = {(ids[x], ids[y]): (rank, ids[x + y]) for rank, (x, y) in enumerate(pairs)}
    mine = bpe.Bpe(tokens, merges, {})
    # b+c has its turn first, so "ab", "abc" and "bcd" never arise from these bytes
    assert [tokens[i] for i in mine.encode_piece("abcd")] == [b"a", b"bc", b"d"]
    assert [tokens[i] for i in mine.encode_piece("abab")] == [b"ab", b"ab"]


def test_operator_on_edge_rows(spark):
    rows = [(1, None, 3), (2, "", None), (3, "héllo <|endoftext|> x", 1), (None, "x" * 200_000, 0), (3, "héllo <|endoftext|> x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe.tokenize(docs, PATH, with_text=True).collect()
    library = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest(), ids, text or ""))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.tokenize(docs.limit(0), PATH).count() == 0


def test_unknown_ids_decode_to_nothing(both):
    assert both[0].decode(np.array([39, 10 ** 6], dtype=np.uint32)) == both[0].decode(np.array([39], dtype=np.uint32))
