"""WARC archives in Zstandard: one frame for each record, the dictionary in a leading skippable frame.

Archives are handled as rows (path, content), the form of Spark's ``binaryFile`` source, so any store Spark can read will do.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values of the formats
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

REVISIT_BYTES = 100
ARCHIVE_BYTES = 8 << 20
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 500, 1 << 16, 1 << 16
PIECE = 1 << 16


def dictionary(pages: DataFrame) -> bytes:
    """A dictionary trained on at most SAMPLE_PAGES different pages of at most SAMPLE_BYTES; empty if they are too few to train on."""
    fit = pages.where(F.octet_length("html").between(1, SAMPLE_BYTES)).select("html", F.xxhash64("html").alias("o"))
    picked = fit.select(F.col("o").alias("p")).distinct().orderBy("p").limit(SAMPLE_PAGES)  # hashes alone are ordered; pages are fetched by them
    rows = fit.join(F.broadcast(picked), F.col("o") == F.col("p"), "left_semi").groupBy("o").agg(F.min("html").alias("html"))
    some = [r["html"].encode() for r in sorted(rows.collect(), key=lambda r: r["o"])]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, some).as_bytes() if len(some) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One record; a revisit's block holds the HTTP head only, with the full payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {' '.join(url.split())}"] if url else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, trained: bytes) -> DataFrame:
    """(path, content) of archives of about ARCHIVE_BYTES that hold a record for each page (page_id, url, html).

    Of equal payloads of REVISIT_BYTES or more, the smallest page_id's is stored, the others revisit it. Null html is an empty
    payload. Rows that repeat the smallest page_id are all stored; null page_ids come last. No pages: no archives.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy(F.col("digest").alias("d")).agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    told = rows.join(first, F.col("digest") == F.col("d"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    told = told.select("page_id", "url", "payload", "digest", revisit.alias("revisit"), "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(trained) if trained else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True)
        lead = struct.pack("<II", DICTIONARY_FRAME, len(trained)) + trained if trained else b""
        part, number, frames, size = TaskContext.get().partitionId(), 0, [lead], 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"pages-{part:06d}-{number:06d}.warc.zst"]), pa.array([b"".join(frames)], pa.binary())], names=["path", "content"])

        for batch in batches:
            for i in range(len(batch)):
                page, url, data, digest, again, refers = (batch[c][i].as_py() for c in ("page_id", "url", "payload", "digest", "revisit", "first"))
                frame = packer.compress(record(page, url, data, digest, refers, again))
                frames.append(frame)
                size += len(frame)
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    number, frames, size = number + 1, [lead], 0
        if len(frames) > 1:
            yield archive()

    return told.mapInArrow(run, "path string, content binary")


def frames(content: bytes) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(offset, decoded frame, error) of an archive's frames; a broken frame ends it."""
    view, at, trained = memoryview(content), 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", view, 4)[0]
        if 8 + size > len(view):
            yield 0, None, "dictionary cut off"
            return
        raw = bytes(view[8 : 8 + size])
        try:
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw) if raw[:4] == FRAME_MAGIC else raw
            trained = zstandard.ZstdCompressionDict(raw) if raw else None
        except zstandard.ZstdError as e:
            yield 0, None, f"dictionary: {e}"
            return
        at = 8 + size
    unpacker = zstandard.ZstdDecompressor(dict_data=trained) if trained else zstandard.ZstdDecompressor()
    while at < len(view):
        if len(view) - at >= 8 and struct.unpack_from("<I", view, at)[0] in SKIPPABLE:
            size = struct.unpack_from("<I", view, at + 4)[0]
            if at + 8 + size > len(view):
                yield at, None, "skippable frame cut off"
                return
            at += 8 + size
            continue
        one, out, start = unpacker.decompressobj(), [], at
        try:
            while not one.eof and at < len(view):
                out.append(one.decompress(view[at : at + PIECE]))
                at = min(at + PIECE, len(view))
            at -= len(one.unused_data)
        except zstandard.ZstdError as e:
            yield start, None, f"frame: {e}"
            return
        if not one.eof:
            yield start, None, "frame cut off"
            return
        yield start, b"".join(out), None


def heads(data: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first of equal ones stands."""
    out: dict[str, str] = {}
    for line in data.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError(f"not a header line: {line[:40]!r}")
        out.setdefault(name.strip().decode().lower(), value.strip().decode())
    return out


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of one whole record; ValueError where headers, lengths or digests don't hold."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("no WARC header")
    warc = heads(lines)
    for need in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if need not in warc:
            raise ValueError(f"no {need}")
    if not warc["content-length"].isascii() or not warc["content-length"].isdigit():
        raise ValueError("content-length is no number")
    size = int(warc["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"content-length {size}, but {max(0, len(rest) - 4)} bytes")
    block = rest[:size]
    if not warc.get("content-type", "").startswith("application/http"):
        return warc, {}, block
    top, gap, payload = block.partition(b"\r\n\r\n")
    status, _, lines = top.partition(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise ValueError("no HTTP header")
    http = heads(lines) if lines else {}
    if warc["warc-type"] == "response":
        if "content-length" in http and http["content-length"] != str(len(payload)):
            raise ValueError(f"HTTP content-length {http['content-length']}, but {len(payload)} bytes")
        want = warc.get("warc-payload-digest", "")
        if want.startswith("sha256:") and want[7:] != hashlib.sha256(payload).hexdigest():
            raise ValueError("payload digest differs")
    return warc, http, payload


def read(archives: DataFrame) -> DataFrame:
    """A row for each record of (path, content) archives: path, offset, record_id, record_type, uri, payload, payload_bytes, payload_digest, refers_to, headers, error.

    Length and digest are those of the full payload, also of revisits, which have no payload. A record that doesn't hold has an
    ``error`` and no more; a frame that can't be decoded ends its archive. Null content has no records.
    """

    def row(path: str, at: int, data: bytes | None, error: str | None) -> tuple:
        try:
            if error:
                raise ValueError(error)
            warc, http, payload = parse(data)
        except ValueError as e:
            return (path, at, *[None] * 8, str(e))
        kind = warc["warc-type"]
        again = kind == "revisit"
        size = http.get("content-length", "") if again else str(len(payload))
        digest = warc.get("warc-payload-digest", "").removeprefix("sha256:") if again else hashlib.sha256(payload).hexdigest()
        return (path, at, warc["warc-record-id"], kind, warc.get("warc-target-uri"), None if again else payload, int(size) if size.isdigit() else None, digest or None, warc.get("warc-refers-to"), list(warc.items()), None)

    names = ["path", "offset", "record_id", "record_type", "uri", "payload", "payload_bytes", "payload_digest", "refers_to", "headers", "error"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows: list[tuple] = []
                for f in frames(content.as_py() or b""):
                    rows.append(row(path.as_py(), *f))
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
                        rows = []
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    schema = "path string, offset long, record_id string, record_type string, uri string, payload binary, payload_bytes long, payload_digest string, refers_to string, headers map<string,string>, error string"
    return archives.select("path", "content").mapInArrow(run, schema)
