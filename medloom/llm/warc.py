"""WARC archives: a writer with revisit records, and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import new_path, stage

GZIP, VERSION = b"\x1f\x8b\x08", b"WARC/1."
#: Bytes that the writer hands on at once.
CHUNK_BYTES = 4 << 20
#: Compressed bytes that the reader unpacks at once, to begin with.
SLICE_BYTES = 4 << 10
#: Repeated payloads that are looked up by broadcast, those with most rows first: about 8 MB.
#: Where there are more, pages of the others are joined with their payload's first page.
KNOWN = 1 << 17
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id) -> str:
    return "<urn:page>" if page_id is None else f"<urn:page:{quote(str(page_id), safe='')}>"


def _id(name: str | None) -> str | None:
    """What _name was given, as text."""
    m = re.fullmatch(r"<urn:page:([^<>]*)>", name or "")
    return unquote(m[1]) if m else None


def record(page_id, url: str | None, payload: bytes, payload_digest: str, refers_to=None, revisit: bool = False, size: int = 0) -> bytes:
    """One record, compressed as a gzip member of its own. A revisit has no payload, but
    its HTTP header says how long (size) that is."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size if revisit else len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        "WARC-Date: 2020-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{payload_digest}", f"WARC-Block-Digest: sha1:{digest(block)}",
        *([f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"] if revisit else []), "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    raw = ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes


@dataclass
class Gap:
    begin: int
    end: int
    reason: str


def _lines(data: bytes, at: int, end: int) -> Iterator[bytes]:
    while at <= end:
        stop = data.find(b"\r\n", at, end)
        stop = end if stop < 0 else stop
        yield data[at:stop]
        at = stop + 2


def _plain(data: bytes, at: int, end: int) -> tuple[Record, int] | str:
    """The record whose version line is at ``at``, and its header's end at ``end``, and where
    it ends; else what is wrong."""
    lines = _lines(data, at, end)
    if not re.fullmatch(rb"WARC/1\.[01]", next(lines)):
        return "no version line"
    headers = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            return "header line without a colon"
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", size):
        return "no length"
    begin, stop = end + 4, end + 4 + int(size)
    if data[stop : stop + 4] != b"\r\n\r\n":
        return "block isn't as long as it says"
    block = data[begin:stop]
    said = headers.get("warc-block-digest", "")
    if said.startswith("sha1:") and said[5:] != digest(block):
        return "block doesn't match its digest"
    return Record(headers, block), stop + 4


def _member(data: bytes, at: int) -> tuple[bytes, int] | str:
    """The member that begins at ``at``, unpacked, and where it ends. It is fed in slices, so
    that its cost doesn't depend on what follows it."""
    z, view, parts, size = zlib.decompressobj(31), memoryview(data), [], SLICE_BYTES
    try:
        while not z.eof and at < len(data):
            piece = view[at : at + size]
            parts.append(z.decompress(piece))
            at += len(piece)
            size = min(2 * size, 16 * SLICE_BYTES)
    except zlib.error as e:
        return f"member: {e}"
    return (b"".join(parts), at - len(z.unused_data)) if z.eof else "member without an end"


def read_archive(data: bytes) -> tuple[list[Record], list[Gap]]:
    """All records that pass their checks, and the byte ranges that hold none.

    At a failed check (a broken member, header, length or digest), reading goes on at the
    next place where a gzip member or a version line begins and passes. What lies between
    is a gap, with the first reason. Line breaks between records or members are none.
    Gaps within a member are counted in the archive: its whole member.
    """
    records: list[Record] = []
    gaps: list[Gap] = []
    at, n = 0, len(data)
    lost: tuple[int, str] | None = None
    head = -1  # the next end of a header, however far; n if there is none
    marks = {GZIP: -1, VERSION: -1}  # the next place of each, sought once

    def ahead(mark: bytes) -> int:
        if marks[mark] <= at:
            found = data.find(mark, at + 1)
            marks[mark] = n if found < 0 else found
        return marks[mark]

    while at < n:
        if data[at : at + 3] == GZIP:
            got = _member(data, at)
            if not isinstance(got, str):
                inner, bad = read_archive(got[0])
                if bad and not inner:
                    got = bad[0].reason
                else:
                    if lost:
                        gaps.append(Gap(lost[0], at, lost[1]))
                        lost = None
                    records += inner
                    gaps += [Gap(at, got[1], g.reason) for g in bad[:1]]
                    at = got[1]
                    continue
        elif data[at : at + 7] == VERSION:
            if head < at:
                head = data.find(b"\r\n\r\n", at)
                head = n if head < 0 else head
            got = _plain(data, at, head) if head < n else "header without an end"
            if not isinstance(got, str):
                if lost:
                    gaps.append(Gap(lost[0], at, lost[1]))
                    lost = None
                records.append(got[0])
                at = got[1]
                continue
        elif lost is None and data[at : at + 1] in b"\r\n":
            at += 1
            continue
        else:
            got = "neither a member nor a version line"
        lost = lost or (at, got)
        at = min(ahead(GZIP), ahead(VERSION))
    if lost:
        gaps.append(Gap(lost[0], n, lost[1]))
    return records, gaps


def _bytes(html: pa.Array) -> list[bytes]:
    return [x or b"" for x in html.cast(pa.binary()).to_pylist()]


def _payload():
    return F.coalesce(F.col("html").cast("binary"), F.lit(b""))


def repeated(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(sha1, first, n) of the payloads of at least least_bytes that several rows have: the
    hex digest, the smallest page_id, and the number of rows.

    A null html is the empty payload; a null page_id is larger than any other. Rows are
    counted before the shuffle, so copies cost no more than one.
    """
    facts = pages.where(F.octet_length(_payload()) >= least_bytes).select("page_id", F.sha1(_payload()).alias("sha1"))
    return facts.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")


def with_roles(pages: DataFrame, least_bytes: int = 0, known: int = KNOWN) -> DataFrame:
    """(page_id, url, html, sha1, size, first): pages with the hex digest and the size of their
    payload, and, where they revisit it, its first page and no html.

    The first pages of the ``known`` payloads with most rows go to all tasks, so their
    revisits lose their html where they are read; if these are all repeated payloads,
    nothing is shuffled. Of the others, which have few rows each, pages meet their payload's
    first by a join on the digest; the rest is dealt at random there.
    """
    firsts = stage(repeated(pages, least_bytes), "repeated")
    rows = pages.select("page_id", "url", "html", F.sha1(_payload()).alias("sha1"), F.octet_length(_payload()).cast("long").alias("size"))
    again = lambda c: F.col(c).isNotNull() & ~F.col("page_id").eqNullSafe(F.col(c))
    light = lambda c: [F.when(again(c), F.col(c)).alias("first"), F.when(~again(c), F.col("html")).alias("html")]
    if firsts.count() <= known:
        own = F.broadcast(firsts.select("sha1", F.col("first").alias("a")))
        return rows.join(own, "sha1", "left").select("page_id", "url", "sha1", "size", *light("a"))
    most = stage(firsts.orderBy(F.desc("n"), "sha1").limit(known), "most")
    rows = rows.join(F.broadcast(most.select("sha1", F.col("first").alias("a"), F.lit(True).alias("met"))), "sha1", "left")
    rows = rows.select("page_id", "url", "sha1", "size", "met", *light("a"))
    dealt = F.concat(F.lit("-"), F.xxhash64(F.monotonically_increasing_id()).cast("string"))  # never a digest
    rows = rows.withColumnRenamed("first", "a").withColumn("key", F.when(F.col("met"), dealt).otherwise(F.col("sha1")))
    few = firsts.join(most.select("sha1"), "sha1", "left_anti").select(F.col("sha1").alias("key"), F.col("first").alias("b"))
    rows = rows.join(few, "key", "left").withColumn("c", F.coalesce("a", "b"))
    return rows.select("page_id", "url", "sha1", "size", *light("c"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, known: int = KNOWN) -> None:
    """Write the records of pages (page_id of any plain type, url, html) as .warc.gz parts
    under path.

    Of equal payloads of at least least_bytes, that of the smallest page_id is the
    response and others revisit it; rows that repeat its page_id are responses too, and so
    is a payload of rows without a page_id. Each task writes the pages that it reads, so
    files are as even as its input. Spark's text writer carries the members, so path can be
    in any file system of Spark's and a task that is run again leaves one file; the line
    break that it adds after each few megabytes stands between members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for page, url, sha1, long, first, payload in zip(*[b.column(c).to_pylist() for c in ("page_id", "url", "sha1", "size", "first")], _bytes(b.column("html")), strict=True):
                said = base64.b32encode(bytes.fromhex(sha1)).decode()
                held.append(record(page, url, payload, said, first, first is not None, long))
                size += len(held[-1])
                if size >= CHUNK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

    with_roles(pages, least_bytes, known).mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")).write.text(path)


def _archives(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_archives(spark, path: str, kind: str = "long") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of the
    records under path that pass their checks; a file at a time is read by a task. For a
    response, size and digest are those of the payload that was read. kind: the type of
    page_id; a record whose name isn't of that type gets null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary())
        for b in batches:
            for content in b.column("content"):
                rows = []
                for r in read_archive(content.as_py())[0]:
                    http, _, payload = r.block.partition(b"\r\n\r\n")
                    size = re.search(rb"(?im)^content-length: *([0-9]+)", http)
                    kind, said = r.headers.get("warc-type"), r.headers.get("warc-payload-digest", "").removeprefix("sha1:")
                    page = _id(r.headers.get("warc-record-id"))
                    if kind == "revisit":
                        rows.append((page, int(size[1]) if size else None, said, kind, _id(r.headers.get("warc-refers-to")), None))
                    elif kind == "response":
                        rows.append((page, len(payload), digest(payload), kind, None, payload))
                for i in range(0, len(rows), 256):
                    cols = list(zip(*rows[i : i + 256], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    found = _archives(spark, path).mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary")
    return found.withColumns({c: F.col(c).try_cast(kind) for c in ("page_id", "refers_to")})


def quarantined(spark, path: str) -> DataFrame:
    """The log of gaps: (path, begin, end, reason), byte ranges of archives under path from
    which no record was recovered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(name, g.begin, g.end, g.reason) for name, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True) for g in read_archive(content.as_py())[1]]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["path", "begin", "end", "reason"])

    return _archives(spark, path).mapInArrow(run, "path string, begin long, end long, reason string")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to the shared folder and read the archives back."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path, pages.schema["page_id"].dataType.simpleString())


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(p.h, (5 * i + 1)::INT, 5))::INT >> s) & 31) + 1)::INT, 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f ON p.h = f.h
"""
