import random

import pytest

from tidemark.llm import decontaminate as dc
from tidemark.llm.common import words


def plain_distances(pattern, text, anywhere):
    row = [0 if anywhere else j for j in range(len(text) + 1)]
    for i, x in enumerate(pattern, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[1:]


def test_bit_parallel_distance():
    r = random.Random(1)
    for _ in range(300):
        a = [r.randrange(4) for _ in range(r.randrange(1, 90))]
        t = [r.randrange(4) for _ in range(r.randrange(80))]
        for anywhere in (True, False):
            assert dc.edit_distances(a, t, anywhere) == plain_distances(a, t, anywhere)


def vocabulary(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice("aeioubdfgklmnprst") for _ in range(r.randrange(2, 7))) for _ in range(n)]


def edited(words, n, r, others):
    out = list(words)
    for _ in range(n):
        at = r.randrange(len(out))
        kind = r.randrange(3)
        if kind == 0:
            out[at] = r.choice(others)
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, r.choice(others))
    return out


@pytest.mark.parametrize("share", [0.0, 0.1, 0.2])
def test_recall_of_edited_items(share):
    r = random.Random(5)
    vocab = vocabulary(800, 1)
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randrange(14, 60)))) for i in range(120)]
    tables = dc.Items(items)
    texts = []
    for _, text in items:
        split = text.split()
        planted = edited(split, int(len(split) * share), r, vocab)
        texts.append(" ".join(r.choice(vocab) for _ in range(80)) + ". " + " ".join(planted).title() + "! " + " ".join(r.choice(vocab) for _ in range(50)))
    found = tables.find(texts)
    assert sum(any(x[0] == i for x in got) for (i, _), got in zip(items, found)) >= 0.97 * len(items)


ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def brute(rows, items):
    out = []
    for doc_id, text, _ in rows:
        read = [w for part in words(text) for w in part]
        for item_id, item in items:
            pattern = [w for part in words(item) for w in part]
            if item_id is not None and len(pattern) >= 5 and read:
                d = min(plain_distances(pattern, read, True))
                if d <= int(len(pattern) * 0.2 + 1e-9):
                    out.append((doc_id, item_id, d, len(pattern)))
    return sorted(out, key=str)


def test_operator_equals_brute_force(spark):
    r = random.Random(6)
    vocab = vocabulary(300, 2)
    items = [(1, ITEM), (2, "too short item"), (3, None), (None, ITEM + " x"), (4, ""),
             *((10 + i, " ".join(r.choice(vocab) for _ in range(r.randrange(15, 40)))) for i in range(15))]
    noise = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    rows = [(i, noise(r.randrange(200)), "x") for i in range(40)]
    rows += [(100 + i, noise(30) + " " + " ".join(edited(t.split(), len(t.split()) // 6, r, vocab)) + " " + noise(9), "x") for i, t in items if i and i >= 10]
    rows += [(200, ITEM.upper().replace(" ", ",\n"), "x"), (200, ITEM, "x"), (201, None, "x"), (202, "", "x"), (None, "- " + ITEM, None),
             (203, noise(20_000) + " " + ITEM, "x"), (204, ITEM[:40], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(x)[:4] for x in dc.find_leaks(docs, bench).collect()]
    assert sorted(got, key=str) == brute(rows, items)
    clean = dc.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == len(rows) - len({(a, b) for a, b, _ in rows if brute([(a, b, "")], items)})
    assert dc.find_leaks(docs.limit(0), bench).count() == 0 and dc.find_leaks(docs, bench.limit(0)).count() == 0
    assert dc.without_leaks(docs, bench.limit(0)).count() == len(rows)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    r = random.Random(7)
    vocab = vocabulary(200, 3)
    items = [(i, " ".join(r.choice(vocab) for _ in range(20))) for i in range(30)]
    docs = spark.createDataFrame([(i, "so " + t + " on") for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(tuple(x) for x in dc.find_leaks(docs, bench).collect())
    plain = dc.blocks
    monkeypatch.setattr(dc, "blocks", lambda b: plain(b, 1000))
    assert sorted(tuple(x) for x in dc.find_leaks(docs, bench).collect()) == whole and len(whole) >= 30
    assert dc.without_leaks(docs, bench).count() == 0


def test_windows_over_the_bounds_of_a_scan(monkeypatch):
    monkeypatch.setattr(dc, "TOKENS", 50)
    tables = dc.Items([(1, ITEM)])
    for before in range(0, 120, 7):
        [found] = tables.find(["filler " * before + ITEM + " filler" * 100])
        assert found == [(1, 0, 15, before, before + 15)]


@pytest.mark.parametrize("n", range(5, 21))
def test_recall_of_short_items(n):
    """Items of 5 to 20 words: every exact copy is found, and 98 of 100 with as many edits as allowed."""
    r = random.Random(n)
    vocab = vocabulary(2000, 4)
    items = [(i, " ".join(r.choice(vocab) for _ in range(n))) for i in range(150)]
    tables = dc.Items(items)
    for edits in (0, int(n * 0.2 + 1e-9)):
        copies = [edited(t.split(), edits, r, vocab) for _, t in items]
        texts = [" ".join([*(r.choice(vocab) for _ in range(30)), *c, *(r.choice(vocab) for _ in range(30))]) for c in copies]
        texts += [" ".join(c) for c in copies]
        found = [{x[0] for x in got} for got in tables.find(texts)]
        met = sum(i in got for (i, _), got in zip(items * 2, found))
        assert met >= (0.98 if edits else 1) * len(texts)


def test_bands_follow_from_the_recall():
    r = random.Random(12)
    vocab = vocabulary(2000, 5)
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randrange(15, 60)))) for i in range(200)]
    few, many = dc.Items(items, recall=0.5).plan, dc.Items(items, recall=0.999).plan
    assert few.keys() == many.keys() and all(0 < few[c] and (few[c] <= many[c] or many[c] == 0) for c in few)
    assert few != many


def test_an_item_without_keys_is_found():
    """Two words in turn: no window has enough different words of a long item to be a key."""
    item = "la " * 30 + "one two three four"
    [found] = dc.Items([(1, item)]).find(["so " * 9 + item + " and on"])
    assert [x[:2] for x in found] == [(1, 0)]


@pytest.mark.parametrize("item", ["中国的首都是北京它有三千多年的历史", "吾輩は猫である名前はまだ無いどこで生れたか", "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทย"])
def test_items_in_scripts_without_blanks(item):
    tables = dc.Items([(1, item)])
    for text in (item, "前文 " + item + "后文", item[:4] + "x" + item[5:], "abc " + item[:6] + item[7:]):
        [found] = tables.find([text])
        assert [x[0] for x in found] == [1]
    assert tables.find([item[:len(item) // 2], "全く別の文です", None]) == [[], [], []]


def test_items_of_few_words_are_found_exactly():
    tables = dc.Items([(1, "Too short item"), (2, "answer"), (3, "四十二"), (4, "...")])
    found = tables.find(["a too SHORT, item!", "too short an item", "the answers", "Answer", "答えは四十二です", "四十", ""])
    assert [[x[0] for x in got] for got in found] == [[1], [], [], [2], [3], [], []]
    assert found[0] == [(1, 0, 3, 1, 4)]


def test_long_texts_of_letters_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(dc, "PIECE", 7)
    text = "latin words 漢字かな and longer latin words กขค end"
    assert [w for part in dc.tokens_of(text) for w in part] == [
        "latin", "words", *"漢字かな", "and", "longer", "latin", "words", *"กขค", "end"]
