"""Web archives: writing pages as WARC records, and a reader that survives damage.

Writing: Spark deals out the rows, every task turns its pages into records, and
Spark's text sink stores them: a row is a record without its closing line breaks,
which are the separator of rows. So archives go to any file system that Spark
knows, and only files of successful tasks are seen. A task starts a new volume
when one has ``volume_bytes``, so every file can be held in memory later. With
``compress=True`` every record is a gzip member of its own.

Of pages with equal payloads the one with the smallest id is stored, the others
refer to it. The smallest ids are found on digests alone, added up before they
are shuffled, and joined back to the pages: a payload that a third of all pages
share is split by adaptive execution.

Reading: a file is walked from record to record. Every record has to have a
version line, a header, a block of the stated length, an end, and the digest its
header names. After a failed check the reader searches for the next gzip member
or version line that starts a valid record, goes on from there, and logs the
bytes between as a gap with the reason. Records leave as they are found, and a member is
unpacked from windows of the file, so the work is linear in its size.

A null html is an empty payload. A null id is larger than any other and is
written as an empty id; pages that share the smallest id (repeated rows) are all
stored in full. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm.common import by_size

RECORD_END = "\r\n\r\n"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
GZIP_START = b"\x1f\x8b\x08"
ID_PREFIX, ID_SUFFIX = "<urn:page:", ">"
DATE = "2020-01-01T00:00:00Z"
WINDOW = 1 << 18
VOLUME_BYTES = 16 << 20
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

RECORD_SCHEMA = (
    "file string, offset long, stored_bytes long, record_type string, record_id string, "
    "uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"
)
GAP_SCHEMA = "file string, start long, stop long, reason string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """A header value stays on its line."""
    return re.sub(r"[\r\n]+", " ", value)


def record_bytes(page_id: int | None, url: str | None, html: bytes, first: int | None) -> bytes:
    """A record without its end: a response, or a revisit when ``first`` is another page."""
    shown = "" if page_id is None else str(page_id)
    revisit = first is not None and first != page_id
    block = b"" if revisit else HTTP_HEAD + html
    lines = [
        "WARC/1.0",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {ID_PREFIX}{shown}{ID_SUFFIX}",
        f"WARC-Target-URI: {_clean(url or '')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(html)}",
        f"WARC-Payload-Length: {len(html)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
            f"WARC-Refers-To: {ID_PREFIX}{first}{ID_SUFFIX}",
        ]
    return "\r\n".join(lines).encode() + RECORD_END.encode() + block


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_warc(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    compress: bool = False,
    volume_bytes: int = VOLUME_BYTES,
) -> None:
    """Archives of all pages below ``path``."""
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("key"),
        F.col(url).cast("string").alias("url"),
        body.alias("html"),
        F.sha1(body.cast("binary")).alias("digest"),
    )
    firsts = rows.groupBy("digest").agg(F.min("key").alias("first"))
    dealt = rows.join(firsts, "digest").select("key", "url", "html", "first")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        for batch in by_size(batches, "html"):
            ready, volumes = [], []
            for row in batch.to_pylist():
                data = record_bytes(row["key"], row["url"], row["html"].encode(), row["first"])
                if compress:
                    data = gzip_member(data + RECORD_END.encode())
                ready.append(data)
                volumes.append(written // volume_bytes)
                written += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ready, pa.binary()), pa.array(volumes, pa.int32())], ["value", "volume"]
            )

    # Between gzip members stands an empty member, which readers skip.
    separator = gzip_member(b"").decode("latin-1") if compress else RECORD_END
    (
        dealt.mapInArrow(records, "value binary, volume int")
        .select(F.col("value").cast("string").alias("value"), "volume")
        .write.partitionBy("volume")
        .option("lineSep", separator)
        .option("encoding", "ISO-8859-1")
        .text(path)
    )


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    stop: int

    def payload(self) -> bytes:
        if self.headers.get("warc-type") != "response":
            return b""
        head = self.block.find(b"\r\n\r\n")
        return self.block[head + 4 :] if head >= 0 else self.block


@dataclass
class Walk:
    """Records found in a file, with offset and stored length, and the gaps between them."""

    records: list[tuple[int, int, Record]] = field(default_factory=list)
    gaps: list[tuple[int, int, str]] = field(default_factory=list)


def _parse(data: bytes, at: int) -> Record:
    """The record that starts at ``at``; ValueError says which check failed."""
    if not VERSION_LINE.match(data, at):
        raise ValueError("no version line")
    line = data.index(b"\n", at) + 1
    head = data.find(b"\r\n\r\n", line)
    if head < 0:
        raise ValueError("header without end")
    headers = {}
    for text in data[line:head].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = text.partition(":")
        if not colon:
            raise ValueError("header line without colon")
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise ValueError("no content length")
    begin = head + 4
    stop = begin + int(length)
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("no record end after the block")
    block = data[begin:stop]
    wanted = headers.get("warc-block-digest", "")
    if wanted.startswith("sha1:") and wanted != f"sha1:{base32_sha1(block)}":
        raise ValueError("block differs from its digest")
    return Record(headers, block, stop + 4)


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member that starts at ``at``.

    Windows of the file are unpacked one by one, as what follows the member is copied.
    """
    unpacker = zlib.decompressobj(31)
    view, parts, stop = memoryview(data), [], at
    try:
        while not unpacker.eof and stop < len(data):
            window = view[stop : stop + WINDOW]
            parts.append(unpacker.decompress(window))
            stop += len(window)
        parts.append(unpacker.flush())
    except zlib.error as error:
        raise ValueError("damaged gzip member") from error
    if not unpacker.eof:
        raise ValueError("gzip member without end")
    return b"".join(parts), stop - len(unpacker.unused_data)


def _step(data: bytes, at: int) -> tuple[list[Record], int, list[tuple[int, int, str]]]:
    """Records of the plain record or gzip member at ``at``, its end, and gaps inside."""
    if data.startswith(GZIP_START, at):
        content, stop = _member(data, at)
        inner = walk(content)
        if content and not inner.records:
            raise ValueError("gzip member without a record")
        return [r for _, _, r in inner.records], stop, [(at, stop, g[2]) for g in inner.gaps]
    record = _parse(data, at)
    return [record], record.stop, []


def _next_start(data: bytes, at: int) -> int:
    """Where the next version line or gzip member may start, from ``at`` on."""
    line = VERSION_LINE.search(data, at)
    member = data.find(GZIP_START, at)
    return min(line.start() if line else len(data), member if member >= 0 else len(data))


Found = tuple[int, int, Record | str]


def scan(data: bytes) -> Iterator[Found]:
    """(start, stop, record), or (start, stop, reason) of a gap, as they are met in ``data``."""
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            records, stop, inner = _step(data, at)
        except ValueError as error:
            if gap is None:
                gap, reason = at, str(error)
            at = _next_start(data, at + 1)
            continue
        if gap is not None:
            yield gap, at, reason
            gap = None
        for record in records:
            yield at, stop, record
        yield from inner
        at = stop
    if gap is not None:
        yield gap, len(data), reason


def walk(data: bytes) -> Walk:
    """All valid records of ``data``, and the gaps that hold anything else."""
    found = Walk()
    for start, stop, what in scan(data):
        if isinstance(what, Record):
            found.records.append((start, stop - start, what))
        else:
            found.gaps.append((start, stop, what))
    return found


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every valid record below ``path``; file and offset say where it was found."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*(batch.column(i) for i in (0, 1)), strict=True):
                rows: list[tuple] = []
                held = 0
                for offset, stop, record in scan(content.as_py()):
                    if not isinstance(record, Record):
                        continue
                    h, payload = record.headers, record.payload()
                    digest = h.get("warc-payload-digest", "").removeprefix("sha1:")
                    length = h.get("warc-payload-length", "")
                    is_response = h.get("warc-type") == "response"
                    rows.append(
                        (
                            name.as_py(),
                            offset,
                            stop - offset,
                            h.get("warc-type"),
                            h.get("warc-record-id"),
                            h.get("warc-target-uri"),
                            h.get("warc-refers-to"),
                            len(payload) if is_response else int(length or 0),
                            base32_sha1(payload) if is_response else digest,
                            payload,
                        )
                    )
                    held += len(payload)
                    if held > (4 << 20):
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    return _files(spark, path).mapInArrow(records, RECORD_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(part.split() for part in RECORD_SCHEMA.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    arrays = [pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def read_gaps(spark: SparkSession, path: str) -> DataFrame:
    """The byte ranges below ``path`` that hold no valid record, with the failed check."""

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*(batch.column(i) for i in (0, 1)), strict=True):
                found = [g for g in scan(content.as_py()) if not isinstance(g[2], Record)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name.as_py()] * len(found), pa.string()),
                        pa.array([g[0] for g in found], pa.int64()),
                        pa.array([g[1] for g in found], pa.int64()),
                        pa.array([g[2] for g in found], pa.string()),
                    ],
                    ["file", "start", "stop", "reason"],
                )

    return _files(spark, path).mapInArrow(gaps, GAP_SCHEMA)


def page_id_of(record_id: str) -> Column:
    """The page id inside a record id; null for a page without one."""
    inner = F.regexp_extract(F.col(record_id), ":([^:>]*)>", 1)
    return F.when(inner != "", inner).cast("long")
