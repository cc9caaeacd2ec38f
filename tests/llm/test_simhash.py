import random

import numpy as np
import xxhash

from tidemark.llm import simhash

SCHEMA = "doc_id long, text string, fp string, component int"


def plain_fingerprint(text, words=3):
    parts = (text or "").encode().lower().split()
    shingles = [b" ".join(parts[i:i + words]) for i in range(len(parts) - words + 1)] or ([b" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(ids, fps, bits=3):
    up = list(range(len(ids)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                up[root(i)] = root(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(root(i), []).append(ids[i])
    return [min((x for x in groups[root(i)] if x is not None), default=None) for i in range(len(ids))]


def test_fingerprint_follows_the_contract():
    for text in (None, "", " \n", "One", "a B\tc", "a b c d " * 40, "É é\x0bÉ x\x0cy", "wörd " * 70_000, "a\x85b c\xa0d e"):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 7)
    for text in ("a b", "one two three four five six seven", " x " * 30, "abcdefghijklmnop qrst", "a\n\n\n\n\n\n\n\n\n\nb c"):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_operator_equals_brute_force(spark):
    r = random.Random(3)
    base = [" ".join(r.choice("abcdefghij") + str(r.randrange(50)) for _ in range(60)) for _ in range(12)]
    rows = []
    for i in range(150):
        words = r.choice(base).split()
        for _ in range(r.randrange(3)):
            words[r.randrange(len(words))] = "new" + str(r.randrange(9))
        rows.append((i * 3 + 1, " ".join(words), "x", None))
    rows += [(900, None, "", 1), (901, "", None, 1), (None, rows[0][1], "", 1), (None, "quite alone here now", "", 1), rows[5], (2, "two words", "", 0)]
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    want = sorted(zip((x[0] for x in rows), (f"{f:016x}" for f in fps), plain_components([x[0] for x in rows], fps)), key=str)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = plain_components(list(range(len(rows))), fps)
    assert kept.count() == len(set(groups))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_dense_families_lose_no_link(spark):
    """Many fingerprints in one bucket, linked over one, two or three bits only."""
    r = random.Random(8)
    fps = set()
    for center in range(6):
        c = r.getrandbits(64)
        for _ in range(60):
            flips = sum(1 << b for b in r.sample(range(20 + center), r.randrange(6)))
            fps.add(c ^ flips)
    fps |= {r.getrandbits(64) for _ in range(60)}
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    links = simhash.close_links(spark.createDataFrame([(s,) for s in signed], "fp long"), 3, 3)
    pairs = [tuple(x) for x in links.collect()]
    where = {s: i for i, s in enumerate(signed)}
    assert all(bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 3 for a, b in pairs)
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in pairs:
        x, y = root(where[a]), root(where[b])
        up[max(x, y)] = min(x, y)
    want = plain_components(list(range(len(fps))), fps)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(root(i), []).append(i)
    assert [min(groups[root(i)]) for i in range(len(fps))] == want
    assert len(set(pairs)) < 12 * len(fps)  # far from all pairs


def test_tables_cover_every_choice_of_close_pairs():
    masks = simhash.block_tables(3, 3)
    r = random.Random(1)
    for _ in range(300):
        d = sum(1 << b for b in r.sample(range(64), 3))
        assert any(d & m == 0 for m in masks)
    assert len(masks) == 20 and all(bin(m).count("1") >= 30 for m in masks)
