"""WARC archives: write records with deduplicated and segmented payloads, read them back.

Large blocks are split into a first record and ``continuation`` records; payloads travel in
chunked transfer framing.  Reading groups the parts of a record by origin, orders them by
segment number, verifies numbering and total length, and removes the framing; each payload is
verified against its digest.

Archives are text files of UTF-8 records (parts and chunks are cut between characters), gzipped
by Spark's writer in the shared folder, at most ``RECORDS_A_FILE`` rows each.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import new_path

REVISIT_BYTES = 100
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
RECORDS_A_FILE = 4000
END = "\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_PARTS = "origin string, segment long, total long, page_id long, digest string, data binary"


def cuts(data: bytes, size: int) -> Iterator[bytes]:
    """Pieces of about ``size`` bytes that begin and end between UTF-8 characters."""
    at = 0
    while at < len(data):
        to = min(at + size, len(data))
        while to < len(data) and data[to] & 0xC0 == 0x80:
            to += 1
        yield data[at:to]
        at = to


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    framed = b"".join(b"%x\r\n%b\r\n" % (len(piece), piece) for piece in cuts(payload, size))
    return framed + b"0\r\n\r\n"


def dechunked(framed: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = framed.index(b"\r\n", at)
        size = int(framed[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        out.append(framed[at : at + size])
        if len(out[-1]) < size or framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("broken chunk framing")
        at += size + 2


def record(kind: str, fields: list[tuple[str, object]], block: bytes) -> str:
    head = [f"WARC/1.1\r\nWARC-Type: {kind}", "WARC-Date: 1970-01-01T00:00:00Z", *(f"{k}: {v}" for k, v in fields if v is not None)]
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]) + END + block.decode()


def page_records(row: int, page_id: int | None, url: str | None, html: str | None, digest: str, refers_to: int | None) -> Iterator[str]:
    payload = (html or "").encode()
    name = f"<urn:page:{'' if page_id is None else page_id}#{row}>"
    uri = None if url is None else re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m.group()):02X}", url)
    fields = [("WARC-Record-ID", name), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        yield record("revisit", [*fields, profile, ("WARC-Refers-To", f"<urn:page:{refers_to}>")], _HTTP + b"Content-Length: %d\r\n\r\n" % len(payload))
        return
    block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = list(cuts(block, SEGMENT_BYTES))
    yield record("response", [*fields, ("WARC-Segment-Number", 1 if len(parts) > 1 else None)], parts[0])
    for n, part in enumerate(parts[1:], 2):
        total = len(block) if n == len(parts) else None
        yield record("continuation", [("WARC-Record-ID", name.replace("#", f".{n}#")), ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", n), ("WARC-Segment-Total-Length", total)], part)


def _write_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            lines = [line for values in zip(*(part.column(c).to_pylist() for c in ("row", "page_id", "url", "html", "digest", "refers_to"))) for line in page_records(*values)]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) to gzipped archives under ``path``.

    Among rows with equal payloads of ``REVISIT_BYTES`` or more, those with the smallest page_id
    are responses and the others revisit it; null ids come last.  Null html is an empty payload;
    repeated rows get records of their own; other columns don't matter.
    """
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"),
    ).withColumn("digest", F.sha2(F.coalesce("html", F.lit("")), 256))
    alike = rows.where(F.octet_length("html") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    alike = alike.where("n > 1").select(F.col("digest").alias("of_digest"), "first_id")
    rows = rows.join(alike, F.col("digest") == F.col("of_digest"), "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))
    lines = rows.select("row", "page_id", "url", "html", "digest", "refers_to").mapInArrow(_write_task, "value string")
    lines.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_A_FILE).text(path)


def parsed(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of one gzipped archive, unpacked as it is read."""
    unpack, held, fed, size = zlib.decompressobj(31), bytearray(), 0, 256 << 10
    while True:
        end = held.find(b"\r\n\r\n")
        if end >= 0:
            lines = held[:end].decode().split("\r\n")
            fields = {"version": lines[0]} | dict(line.split(": ", 1) for line in lines[1:])
            length = int(fields["Content-Length"])
            if len(held) >= end + 4 + length + 4:
                if held[end + 4 + length : end + 8 + length] != b"\r\n\r\n":
                    raise ValueError("a record is longer than its Content-Length")
                yield fields, bytes(held[end + 4 : end + 4 + length])
                del held[: end + 8 + length]
                continue
        if fed >= len(content):
            if held:
                raise ValueError("an archive ends inside a record")
            return
        held += unpack.decompress(content[fed : fed + size])
        fed += size
        if unpack.eof and unpack.unused_data:
            rest = unpack.unused_data
            unpack = zlib.decompressobj(31)
            held += unpack.decompress(rest)


def page_of(record_id: str) -> int | None:
    digits = re.match(r"<urn:page:(\d*|-\d+)[.#>]", record_id).group(1)
    return int(digits) if digits else None


def payload_of(block: bytes, digest: str) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    if hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("a payload doesn't match its digest")
    return payload


def _digest(fields: dict[str, str]) -> str:
    return fields["WARC-Payload-Digest"].removeprefix("sha256:")


def _whole_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Responses in one record, and revisits."""
    for batch in batches:
        for content in batch.column("content"):
            out = []
            for fields, block in parsed(content.as_py()):
                kind = fields["WARC-Type"]
                if kind == "revisit":
                    size = int(re.search(rb"Content-Length: (\d+)", block).group(1))
                    out.append((page_of(fields["WARC-Record-ID"]), size, _digest(fields), kind, page_of(fields["WARC-Refers-To"])))
                elif kind == "response" and "WARC-Segment-Number" not in fields:
                    out.append((page_of(fields["WARC-Record-ID"]), len(payload_of(block, _digest(fields))), _digest(fields), kind, None))
            yield _batch(out)


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    columns = list(zip(*out)) if out else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def _part_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that are one segment of several."""
    for batch in batches:
        for content in batch.column("content"):
            out = []
            for fields, block in parsed(content.as_py()):
                if "WARC-Segment-Number" in fields:
                    first = fields["WARC-Type"] == "response"
                    origin = fields["WARC-Record-ID" if first else "WARC-Segment-Origin-ID"]
                    total = fields.get("WARC-Segment-Total-Length")
                    out.append((origin, int(fields["WARC-Segment-Number"]), int(total) if total else None, page_of(origin), _digest(fields) if first else None, block))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["origin", "segment", "total", "page_id", "digest", "data"])


def reassembled(parts: list[dict]) -> bytes:
    """The block of one record from its segments, in any order."""
    parts = sorted(parts, key=lambda p: p["segment"])
    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
        raise ValueError("a segment is missing or repeated")
    block = b"".join(p["data"] for p in parts)
    if parts[-1]["total"] != len(block):
        raise ValueError("segments don't add up to the total length")
    return block


def _join_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(batch.num_rows):
            r = batch.slice(start, 1).to_pylist()[0]
            digest = next(p["digest"] for p in r["parts"] if p["digest"])
            yield _batch([(r["page_id"], len(payload_of(reassembled(r["parts"]), digest)), digest, "response", None)])


def read_archives(spark, path: str) -> DataFrame:
    """One row a page record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Payloads of responses are rebuilt and verified; a broken archive, a missing segment, a wrong
    total length or digest ends the job.  An empty archive gives no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    parts = files.mapInArrow(_part_task, _PARTS).groupBy("origin").agg(F.first("page_id").alias("page_id"), F.collect_list(F.struct("segment", "total", "digest", "data")).alias("parts"))
    return files.mapInArrow(_whole_task, _READ).unionByName(parts.mapInArrow(_join_task, _READ))


def round_trip(pages: DataFrame) -> DataFrame:
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
