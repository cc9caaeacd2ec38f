import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import lines
from tidemark.llm.common import table

SCHEMA = "doc_id long, text string, lines string, `a.b` int, hash string"


def chunks(text):
    """(from, to, body) of every chunk: runs of lines whose neighbours' rolling hashes fall to one seed."""
    rows = (text or "").split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in rows]
    out = []
    for i in range(1, len(rows)):
        seed = (h[i] + h[i - 1] * lines.BASE) % lines.PRIME % lines.SEEDS
        if out and out[-1][2] == seed and not (i > 1 and h[i] == h[i - 1] == h[i - 2]):
            out[-1] = (out[-1][0], i, seed)
        else:
            out.append((i - 1, i, seed))
    return [(a, b, "\n".join(rows[a:b + 1])) for a, b, _ in out]


def brute(rows):
    """Text of each row, by first occurrence in the order of ids (unique here)."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        gone = set()
        for at, to, body in chunks(text):
            if body.strip(" \n\t\r"):
                if body in seen:
                    gone |= set(range(at, to + 1))
                seen.add(body)
        out[doc_id] = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
    return out


def corpus():
    r = random.Random(4)
    pool = [f"line {i} " + "x" * r.randrange(20) for i in range(400)]
    passage = ["shared one", "shared two", "shared three", "shared four", "shared five"]
    rows = []
    for i in range(60):
        body = [r.choice(pool) for _ in range(r.randrange(1, 15))]
        if i % 3 == 0:
            at = r.randrange(len(body) + 1)
            body[at:at] = passage
        rows.append((i, "\n".join(body)))
    rows += [(100, rows[3][1]), (101, None), (102, ""), (103, "\n\n\n\n\n"), (104, "\n\n\n\n\n"), (None, "shared\n" + rows[9][1]),
             (105, "\n".join(passage * 500)), (106, "é\n" * 3 + rows[3][1])]
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*x, "clash", 1, None) for x in rows], SCHEMA)
    got = lines.dedup_lines(docs, count_as="cut")
    assert got.columns == [*docs.columns, "cut"]
    found = {x["doc_id"]: x["text"] for x in got.collect()}
    assert found == brute(rows)
    assert got.where("lines = 'clash' and `a.b` = 1").count() == len(rows) and got.where("cut > 0").count() > 20


def test_a_shifted_passage_is_found(spark):
    passage = "\n".join(f"passage line number {i}" for i in range(12))
    rows = [(1, "intro\n" + passage), (2, "other\nwords\nhere\n" + passage + "\nend")]
    got = {x["doc_id"]: x["text"] for x in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and got[2].count("passage") <= 1 and got[2].startswith("other")


def test_equal_hashes_of_unequal_chunks_are_told_apart(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(lines, "chunk_hash", lambda body: F.lit(7).cast("long"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x["doc_id"]: x["text"] for x in lines.dedup_lines(docs).collect()} == brute(rows)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a\nb\nc\nd\ne\nf"), (1, "a\nb\nc\nd\ne\nf"), (2, "a\nb\nc\nd\ne\nf")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(x) for x in lines.dedup_lines(docs).collect())
    assert got[0] == got[1] == rows[0] and len(got[2][1]) < len(rows[0][1])
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_planted_passages_of_one_to_ten_lines(spark):
    """Passages of 1 to 10 lines in 30 documents of other lines: hardly a line of theirs stays beyond the first copy; single lines do."""
    r = random.Random(9)
    rows = []
    for i in range(30):
        body = []
        for n in range(1, 11):
            body += [f"own {i} {n} {k} {r.random()}" for k in range(r.randrange(1, 4))] + [f"passage {n} {k}" for k in range(n)]
        rows.append((i, "\n".join([*body, f"end {i}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["text"].split("\n") for x in lines.dedup_lines(docs).collect()}
    assert got[0] == rows[0][1].split("\n")
    stayed = 0
    for i, text in rows[1:]:
        own = [x for x in text.split("\n") if not x.startswith("passage") or x == "passage 1 0"]
        assert [x for x in got[i] if x in own] == own
        stayed += len(got[i]) - len(own)
    assert stayed <= 0.01 * 29 * 54  # lines of passages of two and more


def left_and_repeated(before, after):
    """Words of adjacent lines that occurred before in the order of ids, and how many of them are still there."""
    seen, repeated, left = set(), 0, 0
    for doc_id in sorted(before):
        rows, hit = before[doc_id].split("\n"), set()
        for i in range(len(rows) - 1):
            pair = rows[i] + "\n" + rows[i + 1]
            if pair.strip(" \n\t\r"):
                if pair in seen:
                    hit |= {i, i + 1}
                seen.add(pair)
        kept = Counter(after[doc_id].split("\n"))
        for i, line in enumerate(rows):  # a line that was not hit takes its place among the kept ones first
            if i not in hit:
                kept[line] -= 1
        for i in hit:
            words = len(rows[i].split())
            repeated += words
            if kept[rows[i]] > 0:
                kept[rows[i]] -= 1
                left += words
    return left, repeated


def test_share_of_repeated_words_left(spark):
    """Over all documents of sf0.1, less than 1 % of the words in repeated pairs of lines stay."""
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    before = {r["doc_id"]: r["text"] for r in docs.collect() if r["text"] is not None}
    after = {r["doc_id"]: r["text"] for r in lines.dedup_lines(docs).collect()}
    left, repeated = left_and_repeated(before, after)
    print(left, repeated)
    assert repeated > 200_000 and left < 0.01 * repeated
