"""WARC archives: writing pages as transactions, reading records, assembling captures.

A transaction is a response (or a revisit of an equal payload), its request and
its metadata record. The latter two name the response in WARC-Concurrent-To;
`assemble` joins records through these identifiers into one nested row per
capture.

Writing is Spark's own text writer: a record is a row, the record terminator
is the line separator. Reading parses whole files by Content-Length in tasks,
so a payload may hold anything, record marks included. A reader task holds one
file as it is stored and inflates it record by record; the writer bounds files by
bytes: pages are written by classes of size, the larger the fewer to a file.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import settle

# Fixed values of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
END = CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRINCIPAL = ("response", "revisit", "resource")
HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Classes of payload bytes (from, below) that are written apart. Equal payloads are of one class.
SIZES = [(0, 1 << 16), (1 << 16, 1 << 20), (1 << 20, 1 << 62)]

RECORD_SCHEMA = ("record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, "
                 "date string, payload_bytes bigint, payload_digest string, http_header string, fields string, "
                 "problem string, payload binary")


def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string or binary column."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(data), 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), HEX32, BASE32)


def _record(kind: str, rid: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without its terminator; headers with a null value are left out."""
    lines = [F.lit(f"{VERSION}{CRLF}WARC-Type: {kind}{CRLF}WARC-Record-ID: "), rid, F.lit(CRLF)]
    for name, value in headers:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")))
    lines += [F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block]
    return F.concat(*lines)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds ``first`` (record id of the equal payload's response) to rows that revisit, null to the others.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the
    smallest (page_id, record id) is the response; a null page_id comes last.
    Groups are reduced in each task before the shuffle; the join back splits a
    payload that a third of all rows share.
    """
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "rid")
    firsts = (pages.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
              .agg(F.min(order).alias("least"), F.count("*").alias("n")).where(F.col("n") > 1)
              .select("payload_digest", "payload_bytes", F.col("least.rid").alias("first")))
    joined = pages.join(firsts, ["payload_digest", "payload_bytes"], "left")
    return joined.withColumn("first", F.when(F.col("first") != F.col("rid"), F.col("first")))


def write_pages(pages: DataFrame, path: str, min_bytes: int = 0, file_bytes: int = 32 << 20,
                date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one transaction (response or revisit, request, metadata) per row of ``page_id, url, html``.

    Null html is an empty payload; null url leaves out the target; line ends,
    blanks and other control characters in a url are percent-encoded; a null
    page_id is left out of the metadata; repeated rows are captures of their
    own; an empty table gives an archive without records; other columns are
    not read. Output is gzip, a folder for each class of payload sizes that has pages, split into files of at most
    ``file_bytes`` bytes of payload; a larger payload has a file of its own.
    """
    size = F.octet_length(F.coalesce(F.col("html"), F.lit("")))
    counted = pages.agg(*[F.count(F.when((size >= lo) & (size < hi), 1)) for lo, hi in SIZES]).first()
    for (lo, hi), n in zip(SIZES, counted):
        if n or (lo == 0 and not any(counted)):
            _write_class(pages.where((size >= lo) & (size < hi)), f"{path}/from-{lo}", min_bytes, 3 * max(1, file_bytes // hi), date)


def _write_class(pages: DataFrame, path: str, min_bytes: int, records_per_file: int, date: str) -> None:
    """Pages of one class of sizes; none but these can have equal payloads."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), sha1_base32(payload).alias("payload_digest"),
        F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")).alias("rid"))
    rows = with_revisits(rows, min_bytes)
    uri = F.col("url")
    for code in [*range(0x21), 0x7F]:
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    common = [("WARC-Target-URI", F.col("uri")), ("WARC-Date", F.lit(date))]
    digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    rows = rows.withColumn("uri", uri)
    size = F.col("payload_bytes").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(END))
    reply = [*common, ("WARC-Payload-Digest", digest), ("Content-Type", F.lit("application/http;msgtype=response"))]
    response = _record("response", F.col("rid"), reply, F.concat(http, F.col("payload")))
    revisit = _record("revisit", F.col("rid"), [
        *reply, ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", F.col("first"))], http)
    side = lambda tag: F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        F.md5(F.concat(F.col("rid"), F.lit(tag))), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">"))
    path_of = F.coalesce(F.regexp_extract("uri", r"^[^/]*//[^/]*(/.*)$", 1), F.lit(""))
    request = _record("request", side("request"), [
        *common, ("WARC-Concurrent-To", F.col("rid")), ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), F.when(path_of == "", "/").otherwise(path_of), F.lit(f" HTTP/1.1{CRLF}Host: "),
                 F.coalesce(F.regexp_extract("uri", r"^[^/]*//([^/]*)", 1), F.lit("")), F.lit(END)))
    metadata = _record("metadata", side("metadata"), [
        *common, ("WARC-Concurrent-To", F.col("rid")), ("Content-Type", F.lit("application/warc-fields"))],
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")))
    records = F.array(F.when(F.col("first").isNull(), response).otherwise(revisit), request, metadata)
    (rows.select(F.explode(records).alias("value")).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def _headers(head: bytes) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in head.decode("utf-8", "replace").split(CRLF):
        if line[:1] in (" ", "\t") and out:  # a folded line
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}".strip())
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip().lower(), value.strip()))
    return out


class _Inflated:
    """The bytes of a file, plain or gzip of one or more members, as far as they are asked for; ``buffer`` starts where reading stands."""

    STEP = 1 << 20

    def __init__(self, data: bytes):
        self.data, self.at, self.buffer = data, 0, bytearray()
        self.zip = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None

    def _take(self) -> bytes:
        piece = self.data[self.at:self.at + self.STEP]
        self.at += len(piece)
        return piece

    def more(self) -> bool:
        """Some more bytes, unless the file is at its end or its gzip data are broken."""
        if self.zip is None:
            piece = self._take()
            self.buffer += piece
            return bool(piece)
        while True:
            if self.zip.eof:  # the next member, if there is one
                self.at -= len(self.zip.unused_data)
                if self.data[self.at:self.at + 2] != b"\x1f\x8b":
                    self.at, self.zip = len(self.data), None
                    return False
                self.zip = zlib.decompressobj(31)
            given = self.zip.unconsumed_tail or self._take()
            try:
                out = self.zip.decompress(given, self.STEP)
            except zlib.error:
                self.at, self.zip = len(self.data), None
                return False
            if out:
                self.buffer += out
                return True
            if not given:
                return False

    def fill(self, n: int) -> bool:
        """Whether there are ``n`` bytes, which are then in the buffer."""
        while len(self.buffer) < n and self.more():
            pass
        return len(self.buffer) >= n

    def find(self, what: bytes, start: int = 0) -> int:
        while (at := self.buffer.find(what, start)) < 0:
            start = max(start, len(self.buffer) - len(what) + 1)
            if not self.more():
                return -1
        return at

    def drop(self, n: int) -> None:
        del self.buffer[:n]


def parse_records(data: bytes, keep_payload: bool = True) -> Iterator[dict]:
    """The records of one file, plain or gzip (as one member or one for each record).

    A record cut short, or bytes that are no record, give a row with a ``problem``
    and reading goes on at the next record mark. Broken gzip data end the file. Only the
    stored file and one record are held.
    """
    source, mark = _Inflated(data), VERSION[:5].encode()
    while True:
        while source.fill(2) and source.buffer.startswith(b"\r\n"):
            source.drop(2)
        if not source.fill(1):
            return
        head_end = source.find(b"\r\n\r\n") if source.fill(len(mark)) and source.buffer.startswith(mark) else -1
        known = _headers(bytes(source.buffer[:head_end])) if head_end >= 0 else []
        first = dict(reversed(known))
        length = first.get("content-length", "")
        body = head_end + 4
        if not (length.isascii() and length.isdigit()) or not source.fill(body + int(length)):
            following = source.find(b"\r\n" + mark, 1)
            yield {"record_id": first.get("warc-record-id"), "problem": "no whole record"}
            if following < 0:
                return
            source.drop(following)
            continue
        block = bytes(source.buffer[body:body + int(length)])
        source.drop(body + int(length))
        kind, content = first.get("warc-type"), first.get("content-type", "")
        row = {"record_id": first.get("warc-record-id"), "type": kind, "target_uri": first.get("warc-target-uri"),
               "concurrent_to": [v for k, v in known if k == "warc-concurrent-to"],
               "refers_to": first.get("warc-refers-to"), "date": first.get("warc-date")}
        http, payload = None, block
        if content.startswith("application/http"):
            http, _, payload = block.partition(b"\r\n\r\n")
            row["http_header"] = http.decode("utf-8", "replace")
        if kind == "revisit":  # its payload is that of the record it refers to
            size = dict(_headers(http or b"")).get("content-length", "")
            row["payload_bytes"] = int(size) if size.isdigit() else None
            row["payload_digest"] = (first.get("warc-payload-digest") or "").removeprefix("sha1:") or None
        else:
            row["payload_bytes"] = len(payload)
            row["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if kind == "metadata":
                row["fields"] = block.decode("utf-8", "replace")
            elif keep_payload:
                row["payload"] = payload
        yield row


def read_records(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """All records under ``path`` (``RECORD_SCHEMA``), one file at a time in a task."""
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    types = {"concurrent_to": pa.list_(pa.string()), "payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, types.get(n, pa.string())) for n in names])

    def parse(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for r in parse_records(content.as_py(), keep_payload):
                    rows.append(r)
                    size += 500 + len(r.get("payload") or b"")
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(parse, RECORD_SCHEMA)


def capture_of(records: DataFrame) -> DataFrame:
    """``record_id, capture_id``: the response each request or metadata record belongs to.

    Links count in both directions, and over one record in between (a metadata
    record that names the request, a response that names its request). Of
    several responses the smallest id wins.
    """
    named = records.where(F.col("record_id").isNotNull())
    out = named.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    links = out.union(out.select(F.col("b").alias("a"), F.col("a").alias("b")))
    mains = named.where(F.col("type").isin(*PRINCIPAL)).select(F.col("record_id").alias("main")).distinct()
    sides = links.join(mains, F.col("a") == F.col("main"), "left_anti").distinct()
    near = sides.join(mains, F.col("b") == F.col("main")).groupBy("a").agg(F.min("main").alias("one"))
    rest = sides.join(near.select(F.col("a").alias("done")), F.col("a") == F.col("done"), "left_anti")
    far = rest.join(near.select(F.col("a").alias("via"), "one"), F.col("b") == F.col("via")).groupBy("a").agg(
        F.min("one").alias("one"))
    return near.union(far).select(F.col("a").alias("record_id"), F.col("one").alias("capture_id"))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, main, request, metadata, n_requests, n_metadata``.

    ``main`` is the response, revisit or resource record; of several request or
    metadata records of a capture the smallest id is nested and the counts tell
    of the others. Rows of `capture_of` and of ``records`` are reduced in each task
    before the shuffle. A record read twice counts once. Requests and metadata
    that lead to no response, and records with a ``problem`` or without an id, are
    in no capture; `unassembled` has them.
    """
    whole = F.struct(*[F.col(c) for c in records.columns])
    sides = records.where(F.col("type").isin("request", "metadata")).join(capture_of(records), "record_id")
    mains = records.where(F.col("type").isin(*PRINCIPAL) & F.col("record_id").isNotNull())
    both = mains.select(F.col("record_id").alias("capture_id"), F.lit("main").alias("part"), whole.alias("r")).union(
        sides.select("capture_id", F.col("type").alias("part"), whole.alias("r")))

    def least(part):
        return F.min(F.when(F.col("part") == part, F.col("r")))

    return both.groupBy("capture_id").agg(
        least("main").alias("main"), least("request").alias("request"), least("metadata").alias("metadata"),
        F.count(F.when(F.col("part") == "request", 1)).alias("n_requests"),
        F.count(F.when(F.col("part") == "metadata", 1)).alias("n_metadata"))


def unassembled(records: DataFrame, captures: DataFrame) -> DataFrame:
    """Records that stand in no row of ``captures``: without a response, beyond the nested one, or broken."""
    nested = captures.select(F.explode(F.array("main.record_id", "request.record_id", "metadata.record_id")).alias("in_row"))
    return records.join(nested.where(F.col("in_row").isNotNull()).distinct(),
                        F.col("record_id") == F.col("in_row"), "left_anti")


def page_captures(captures: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, url`` of assembled captures.

    The page id comes from the metadata record; that of a revisit's response from
    the capture that its response record leads.
    """
    rows = captures.select(
        "capture_id", F.regexp_extract("metadata.fields", r"page-id: (-?[0-9]+)", 1).try_cast("long").alias("page_id"),
        "main.payload_bytes", "main.payload_digest", F.col("main.type").alias("record_type"),
        F.col("main.refers_to").alias("ref"), F.col("main.target_uri").alias("url"))
    rows = settle(rows, "captures")  # both sides of the join are then dealt out anew, and a response that most refer to can be split
    first = rows.where(F.col("record_type") == "response").select(
        F.col("capture_id").alias("ref_id"), F.col("page_id").alias("refers_to"))
    return rows.join(first, F.col("ref") == F.col("ref_id"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def round_trip(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Archive ``pages`` at ``path``, read it back and return `page_captures`."""
    write_pages(pages, path, min_bytes)
    records = settle(read_records(pages.sparkSession, path, keep_payload=False).drop("payload"), "records")
    return page_captures(assemble(records))


ORACLE = """
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, strlen(body) as payload_bytes, sha1(body) as hex, min(page_id) over (partition by body) as first from p)
select page_id, cast(payload_bytes as bigint) as payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                cast((cast('0x' || substr(hex, cast(i // 8 as int) * 10 + 1, 10) as bigint) >> (35 - 5 * (i % 8))) & 31 as int) + 1, 1)),
         'string_agg', '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id = first then null else first end as refers_to
from d
"""
