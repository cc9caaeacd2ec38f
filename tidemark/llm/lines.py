"""Line deduplication by content-defined chunks of lines; DataFrame functions only.

A rolling hash over the hashes of every two adjacent lines draws the boundaries, under ``seeds`` seeds at once: under seed s
a text is cut between two lines wherever their rolling hash is not s modulo ``seeds``, so a chunk of seed s is a
run of lines whose neighbours all hash to s (a run of one line repeated is cut into pairs of it). Boundaries depend on nearby lines alone, so lines put in or taken out
elsewhere shift none, and every two adjacent lines are in a chunk of several lines under exactly one seed:
no line of a repeated passage is left outside, and a passage's chunks are the same in every copy but for those that a
neighbour of the passage happens to prolong (one in ``seeds`` on either side).

Chunks of several lines that occur more than once in the whole corpus keep their first occurrence, by (doc_id,
hash of the text, position), and are cut everywhere else, after their bytes are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fence import fence
from tidemark.llm.common import KEY, keyed, numbered, settle

# Fixed values of the rolling hash: below 2^29 times line hashes below 2^32 four terms fit a long.
PRIME, BASE = 536870909, 69069
SEEDS = 512

chunk_hash = F.xxhash64


def _chunks(docs: DataFrame, keep: list[str], seeds: int) -> DataFrame:
    """``keep`` columns, ``lines`` and ``starts`` of texts of several lines: the second line of every chunk, under the chunk's own seed."""
    if seeds < 2:
        raise ValueError("boundaries need two seeds or more")
    rows = fence(docs, keep, lines=F.split("text", "\n", -1)).where(F.size("lines") > 1)
    hash_of = lambda line: F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("bigint")
    rows = fence(rows, [*keep, "lines"], hashes=F.transform("lines", hash_of))
    rolled = lambda i: (F.get(F.col("hashes"), i) + F.get(F.col("hashes"), i - 1) * F.lit(BASE)) % PRIME % seeds
    rows = fence(rows, [*keep, "lines", "hashes"], seed=F.transform(F.sequence(F.lit(1), F.size("lines") - 1), rolled))
    own, line = lambda i: F.get(F.col("seed"), i - 1), lambda i: F.get(F.col("hashes"), i)
    again = lambda i: (line(i) == line(i - 1)) & (line(i - 1) == line(i - 2))
    return fence(rows, [*keep, "lines"], starts=F.filter(
        F.sequence(F.lit(1), F.size("lines") - 1), lambda i: (i == 1) | (own(i) != own(i - 1)) | again(i)))


def _spans() -> Column:
    """Array of (from, to) of every chunk, both included. Chunks of different seeds share a line where they meet."""
    until = lambda k: F.coalesce(F.get(F.col("starts"), k + 1), F.size("lines")) - 1
    return F.transform("starts", lambda i, k: F.struct((i - 1).alias("from"), until(k).alias("to")))


def _body(span: Column) -> Column:
    return F.array_join(F.slice(F.col("lines"), span["from"] + 1, span["to"] - span["from"] + 1), "\n")


def repeated_chunks(docs: DataFrame, seeds: int = SEEDS) -> DataFrame:
    """``KEY, at, to, hash, size, first``: every occurrence of a chunk hash that occurs at two places.

    ``first`` marks the earliest occurrence. Only hashes are shuffled, counted in
    each task before; a chunk that a third of all documents share is one row
    per task, and the join back to its occurrences can be split.
    """
    chunks = _chunks(keyed(docs, "text"), KEY, seeds).select(*KEY, F.explode(F.filter(F.transform(_spans(), lambda s: F.struct(
        s["from"].alias("at"), s["to"].alias("to"), _body(s).alias("body"))),
        lambda c: F.trim(F.translate(c["body"], "\n\t\r", "   ")) != "")).alias("c"))
    chunks = chunks.select(*KEY, "c.at", "c.to", chunk_hash("c.body").alias("hash"),
                           F.octet_length("c.body").cast("long").alias("size"))
    place = F.struct(*KEY, "at")
    counted = chunks.groupBy("hash", "size").agg(F.min(place).alias("least"), F.max(place).alias("most")).where(
        F.col("least") != F.col("most")).select("hash", "size", "least")
    counted = settle(counted, "repeated")  # the join then deals out both sides anew and can split a chunk that most documents have
    return chunks.join(counted, ["hash", "size"]).select(
        *KEY, "at", "to", "hash", "size", (place == F.col("least")).alias("first"))


def dedup_lines(docs: DataFrame, seeds: int = SEEDS, count_as: str | None = None) -> DataFrame:
    """All columns of ``docs`` (``doc_id, text``) with repeated chunks cut from ``text``.

    ``count_as`` adds a column with the number of lines cut. Lines end at a line
    feed; the kept lines are joined by line feeds again, and a text that loses
    all its lines is empty. Chunks of blank lines stay. Null and empty texts stay
    as they are. Rows that repeat an id and its text are one document and are
    cut alike; other ties of the id are ordered by the hash of the text; a null
    id comes last. An empty table gives no rows. Other columns, whatever their
    names, are passed on. A line repeated without one of its neighbours stays; every line that is cut
    stays in an earlier place.
    """
    carried = [f"__{i}" for i in range(len(docs.columns))]
    text = carried[docs.columns.index("text")]
    found = repeated_chunks(docs, seeds)
    spans = found.groupBy(*KEY).agg(F.collect_set(F.struct("at", "to", "hash", "size", "first")).alias("spans"))
    rows = keyed(docs, *numbered(docs.columns)).join(spans, KEY, "left")
    rows = settle(rows.select(*KEY, *carried, "spans"), "chunked")

    # bytes are compared: a hash whose chunks are not all equal is dealt with by its texts
    marked = fence(rows.where(F.col("spans").isNotNull()), [*KEY, "spans"], lines=F.split(text, "\n", -1))
    body = F.array_join(F.slice(F.col("lines"), F.col("s.at") + 1, F.col("s.to") - F.col("s.at") + 1), "\n")
    bodies = marked.select(*KEY, "lines", F.explode("spans").alias("s")).select(*KEY, "s.*", body.alias("body"))
    unequal = settle(bodies.groupBy("hash", "size").agg(F.min("body").alias("lo"), F.max("body").alias("hi")).where(
        F.col("lo") != F.col("hi")).select("hash", "size"), "unequal")
    no_lines = F.array().cast("array<int>")
    if unequal.isEmpty():
        rows = rows.withColumn("spared", no_lines)
    else:
        firsts = bodies.join(unequal, ["hash", "size"]).groupBy("hash", "size", "body").agg(
            F.min(F.struct(*KEY, "at")).alias("p"))
        spared = firsts.select("p.*").groupBy(*KEY).agg(F.collect_set("at").alias("spared"))
        rows = rows.join(spared, KEY, "left").withColumn("spared", F.coalesce("spared", no_lines))

    cut = F.filter(F.coalesce("spans", F.array().cast(rows.schema["spans"].dataType)),
                   lambda s: ~s["first"] & ~F.array_contains("spared", s["at"]))
    gone = F.flatten(F.transform(cut, lambda s: F.sequence(s["at"], s["to"])))
    rows = fence(rows, carried, gone=F.array_distinct(gone))  # chunks share lines
    rows = fence(rows, [*carried, "gone"], lines=F.split(text, "\n", -1))
    rows = fence(rows, [*carried, "gone", "lines"],
                 left=F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")))
    kept = F.when(F.size("gone") == 0, F.col(text)).otherwise(
        F.array_join(F.transform("left", lambda i: F.get(F.col("lines"), i)), "\n"))
    out = [(kept if c == text else F.col(c)).alias(n) for c, n in zip(carried, docs.columns)]
    return rows.select(*out, *([F.size("gone").alias(count_as)] if count_as else []))


ORACLE = f"""
with l as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
h as (select *, list_transform(lines, lambda x: cast('0x' || substr(md5(x), 1, 8) as bigint)) as hashes from l where len(lines) > 1),
s as (select doc_id, lines, hashes, list_transform(range(1, len(lines)), lambda i: (hashes[i + 1] + hashes[i] * {BASE}) % {PRIME} % {SEEDS}) as seed from h),
e as (select doc_id, lines, list_filter(range(1, len(lines)), lambda i: i = 1 or seed[i] <> seed[i - 1]
        or (hashes[i + 1] = hashes[i] and hashes[i] = hashes[i - 1])) as starts from s),
c as (select doc_id, lines, starts, unnest(starts) - 1 as beg, generate_subscripts(starts, 1) as k from e),
b as (select doc_id, beg, stop, array_to_string(lines[beg + 1:stop + 1], chr(10)) as body
      from (select *, coalesce(starts[k + 1], len(lines)) - 1 as stop from c)),
r as (select *, row_number() over (partition by body order by doc_id, beg) > 1 as cut from b
      where trim(replace(replace(replace(body, chr(10), ' '), chr(9), ' '), chr(13), ' ')) <> ''),
gone as (select distinct doc_id, unnest(range(beg, stop + 1)) as line from r where cut),
kept as (select l.doc_id, unnest(lines) as body, unnest(range(0, len(lines))) as line from l),
t as (select k.doc_id, string_agg(k.body, chr(10) order by k.line) filter (where g.line is null) as body, count(g.line) as cut_lines
      from kept k left join gone g on g.doc_id = k.doc_id and g.line = k.line group by k.doc_id)
select d.doc_id, case when d.text is null then null else coalesce(t.body, '') end as text, cast(t.cut_lines as int) as cut_lines
from documents d join t using (doc_id)
"""
