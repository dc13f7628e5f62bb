"""WARC archives as a chunked record table.

Writing: every page becomes a WARC/1.1 record.  A record is stored as rows of
(archive, record, chunk): at most ``CHUNK`` bytes each, with the SHA-1 of the
record's payload up to and including the chunk.  The ``data`` of an archive's
rows, in (record, chunk) order, is a WARC file byte for byte.  Only a view of
the page is cut, so no record is built whole beside it.

Of records with equal payloads of at least ``REVISIT`` bytes, the one with the
largest page_id is the response and the others revisit it.  Equal means equal
length, SHA-1 and SHA-256.  Which page that is comes from a grouping by digest
(merged within tasks first); keys with more than a thousandth of all pages are
joined by a bounded broadcast.

Reading: records of one chunk are parsed where they are.  The chunks of longer
records are brought together by record, in order, and streamed: headers come
from the first chunk, the payload only passes through the running digest, which
must agree with the one carried on every chunk and with the header.

Defined results: a null html is an empty payload; a null page_id or url is
written as the word null and read back as null; pages that repeat the largest page_id of a
payload are all responses; an empty table gives an empty archive; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import attach, shuffle_partitions, slices, stored, text_bytes

#: Bytes of a record in one row.
CHUNK = 64 << 10
#: Payloads shorter than this are always written as responses.
REVISIT = 1000
_CHUNKS = "archive long, record long, chunk int, last boolean, data binary, payload_sha1 string"
_RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_VOID = b"HTTP/1.1 200 OK\r\n\r\n"
_END = b"\r\n\r\n"


def _text(value) -> str:
    """Header-safe: line breaks and percent signs escaped; null is a word that no other value gives."""
    if value is None:
        return "null"
    escaped = str(value).replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    return "%6Eull" if escaped == "null" else escaped


def header(page_id, url, size: int, sha1: str, refers_to, revisit: bool) -> bytes:
    block = _VOID if revisit else _HTTP
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{_text(page_id)}>",
        f"WARC-Target-URI: {_text(url)}",
        "WARC-Date: 1970-01-01T00:00:00Z",  # pages carry no time; a fixed one keeps archives reproducible
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"WARC-Payload-Length: {size}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{_text(refers_to)}>"]
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block) + (0 if revisit else size)}"]
    return "\r\n".join(lines).encode() + _END + block


def _write(chunk_bytes: int):
    names = ["archive", "record", "chunk", "last", "data", "payload_sha1"]
    types = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.string())

    def chunks(record: int, row: dict, payload: memoryview) -> Iterator[tuple]:
        start = header(row["page_id"], row["url"], row["size"], row["sha1"], row["refers_to"], row["revisit"])
        if row["revisit"]:
            payload = payload[:0]
        digest, at, part, room = hashlib.sha1(), 0, 0, max(0, chunk_bytes - len(start))
        while True:
            piece = payload[at:at + room]
            digest.update(piece)
            at += len(piece)
            last = at == len(payload)
            yield record, part, last, b"".join((start, piece, _END if last else b"")), digest.hexdigest()
            if last:
                return
            start, room, part = b"", chunk_bytes, part + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        archive, record, out, held = TaskContext.get().partitionId(), 0, [], 0

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        for part in slices(batches):
            bodies = part.column("body")
            rows = part.drop_columns("body").to_pylist()
            for i, row in enumerate(rows):
                for piece in chunks(record, row, memoryview(bodies[i].as_buffer())):
                    out.append((archive, *piece))
                    held += len(piece[3])
                    if held > 4 << 20:
                        yield emit()
                        out, held = [], 0
                record += 1
        if out:
            yield emit()

    return run


def write_archives(pages: DataFrame, chunk_bytes: int = CHUNK, revisit_bytes: int = REVISIT) -> DataFrame:
    """Chunk table (archive, record, chunk, last, data, payload_sha1) with a record for every row of ``pages``
    (page_id, url, html), stored in the cluster's shared folder."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_bytes("html").alias("body"))
    rows = rows.select("*", F.octet_length("body").cast("long").alias("size"), F.sha1("body").alias("sha1"),
                       F.sha2("body", 256).alias("sha256"))
    keys = ["size", "sha1", "sha256"]
    groups = rows.filter(F.col("size") >= revisit_bytes).groupBy(keys).agg(
        F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    rows = attach(rows, stored(groups, "payloads"), keys, "copies", pages.count())
    revisit = F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    rows = rows.select("page_id", "url", "size", "sha1", revisit.alias("revisit"),
                       F.when(revisit, F.col("largest")).alias("refers_to"), "body")
    return stored(rows.mapInArrow(_write(chunk_bytes), _CHUNKS), "archives")


class _Reader:
    """Parses one record from its chunks."""

    def __init__(self):
        self.head, self.fields, self.sha1, self.size, self.left = b"", None, hashlib.sha1(), 0, 0

    def feed(self, data: memoryview, carried: str) -> None:
        if self.fields is None:
            self.head += bytes(data)
            if (end := self.head.find(_END)) < 0 or (body := self.head.find(_END, end + 4)) < 0:
                return
            lines = self.head[:end].decode().split("\r\n")
            if lines[0] != "WARC/1.1":
                raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
            self.fields = dict(x.split(": ", 1) for x in lines[1:])
            data, self.head = memoryview(self.head)[body + 4:], b""
            self.left = int(self.fields["Content-Length"]) - (body - end)  # what follows the HTTP header
        piece = data[:self.left]
        self.sha1.update(piece)
        self.left -= len(piece)
        self.size += len(piece)
        if self.sha1.hexdigest() != carried:
            raise ValueError(f"digest differs within {self.fields['WARC-Record-ID']}")

    def row(self) -> tuple:
        f = self.fields
        if f is None or self.left:
            raise ValueError("a record ends early")
        kind, sha1, size = f["WARC-Type"], f["WARC-Payload-Digest"].removeprefix("sha1:"), int(f["WARC-Payload-Length"])
        if kind == "response" and (sha1 != self.sha1.hexdigest() or size != self.size):
            raise ValueError(f"payload digest differs in {f['WARC-Record-ID']}")
        page, refers = (_id(f.get(k)) for k in ("WARC-Record-ID", "WARC-Refers-To"))
        url = f["WARC-Target-URI"]
        url = None if url == "null" else url.replace("%6E", "n").replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        return page, url, size, sha1, kind, refers


def _id(urn: str | None) -> int | None:
    if urn is None or urn == "<urn:page:null>":
        return None
    return int(urn.removeprefix("<urn:page:").removesuffix(">"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in (archive, record, chunk) order."""
    names = [c.split()[0] for c in _RECORDS.split(", ")]
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
    reader = _Reader()
    for part in slices(batches, "data"):
        out, data = [], part.column("data")
        for i, (last, carried) in enumerate(zip(part.column("last").to_pylist(), part.column("payload_sha1").to_pylist())):
            reader.feed(memoryview(data[i].as_buffer()), carried)
            if last:
                out.append(reader.row())
                reader = _Reader()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def read_archives(chunks: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of every record."""
    columns = chunks.select("archive", "record", "chunk", "last", "data", "payload_sha1")
    whole = columns.filter((F.col("chunk") == 0) & F.col("last")).mapInArrow(_read, _RECORDS)
    n = shuffle_partitions(chunks.sparkSession)
    long = columns.filter((F.col("chunk") > 0) | ~F.col("last")).repartition(n, "archive", "record")
    return whole.unionByName(long.sortWithinPartitions("archive", "record", "chunk").mapInArrow(_read, _RECORDS))
