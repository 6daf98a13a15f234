"""WARC archives: written from a table of pages, read back as a table of chunks.

A record of any size is read as rows (record, chunk number, bytes) with a digest carried along,
so no task ever holds more than one chunk of a payload besides the read buffer. Archives are
gzip files of one member per record, one file per writing task. A task writes a file of a name
of its own and reports it; only reported files are read, so retried and lost tasks leave
nothing behind that counts.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suarakit.llm.common import column, small_batches, written

CHUNK = 1 << 20
_READ = 1 << 18
CHUNKS = (
    "record_id string, target string, record_type string, refers_to string, declared_digest string, declared_bytes bigint, "
    "chunk_no bigint, chunk binary, bytes_so_far bigint, digest_so_far string, is_last boolean"
)
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
_SCHEMA = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in CHUNKS.split(", "))])


def _file(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _digest(state) -> str:
    """Bare upper-case base32 of a running SHA-1."""
    return base64.b32encode(state.digest()).decode()


def _write_record(out: BinaryIO, headers: list[tuple[str, str]], payload: memoryview, chunk: int) -> None:
    """One record as one gzip member, compressed chunk by chunk."""
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    out.write(packer.compress(head.encode()))
    for at in range(0, len(payload), chunk):
        out.write(packer.compress(payload[at : at + chunk]))
    out.write(packer.compress(b"\r\n\r\n"))
    out.write(packer.flush())


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    payload_column: str = "html",
    url_column: str = "url",
    least_revisit: int = 0,
    chunk: int = CHUNK,
) -> DataFrame:
    """Write a record for every row; returns the files written (``path``, ``records``).

    Payloads are the column's bytes, text in UTF-8, null as empty. Of records with equal
    payloads of at least ``least_revisit`` bytes the one with the largest id is the response;
    the others are revisits without a payload that refer to it. A null id counts as smallest;
    rows that share the largest id are all responses. The rest are responses too. No rows
    write no file. Copies of one payload, however many, are found by a sum over digests; the
    join back meets only digests that occur more than once.
    """
    small_batches(pages.sparkSession)
    raw = F.coalesce(column(pages, payload_column).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(
        column(pages, id_column).cast("bigint").alias("id"),
        column(pages, url_column).cast("string").alias("url"),
        raw.alias("payload"),
        F.sha1(raw).alias("digest"),
    )
    shared = (
        rows.where(F.octet_length("payload") >= least_revisit)
        .groupBy("digest")
        .agg(F.max("id").alias("newest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and newest is not null")
        .select(F.col("digest").alias("shared"), "newest")
    )
    joined = rows.join(shared, F.col("digest") == F.col("shared"), "left").select("id", "url", "payload", "digest", "newest")
    where, path = _file(folder)
    where.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, n, out = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            for id_, url, payload, digest, newest in zip(*(batch.column(i) for i in range(5))):
                if out is None:
                    where, path = _file(name)
                    out = where.open_output_stream(path, compression=None)
                id_, newest, body = id_.as_py(), newest.as_py(), memoryview(payload.as_buffer())
                revisit = newest is not None and id_ != newest
                address = (url.as_py() or "").replace("\r", "%0D").replace("\n", "%0A")
                headers = [
                    ("WARC-Type", "revisit" if revisit else "response"),
                    ("WARC-Record-ID", f"<urn:page:{'' if id_ is None else id_}>"),
                    ("WARC-Target-URI", address),
                    ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest.as_py())).decode()),
                    ("X-Payload-Length", str(len(body))),
                ]
                if revisit:
                    headers.append(("WARC-Refers-To", f"<urn:page:{newest}>"))
                    headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
                    body = memoryview(b"")
                _write_record(out, [*headers, ("Content-Length", str(len(body)))], body, chunk)
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "records": [n]})

    return written(joined.mapInArrow(run, "path string, records bigint"), "archives")


def _unpacked(source: BinaryIO) -> Iterator[bytes]:
    """Bytes of a plain or gzip file of any number of members, a bounded block at a time."""
    unpacker, plain, rest = None, None, b""
    while block := rest or source.read(_READ):
        rest = b""
        if plain is None:
            plain = block[:2] != b"\x1f\x8b"
        if plain:
            yield block
            continue
        unpacker = unpacker or zlib.decompressobj(31)
        made = unpacker.decompress(block, _READ)
        if made:
            yield made
        if unpacker.eof:
            rest, unpacker = unpacker.unused_data, None
        else:
            rest = unpacker.unconsumed_tail
    if unpacker is not None:
        raise ValueError("archive ends within a record")


class _Reader:
    """Lines and exact numbers of bytes from a sequence of blocks."""

    def __init__(self, blocks: Iterator[bytes]):
        self.blocks, self.held = blocks, b""

    def _more(self) -> bool:
        block = next(self.blocks, None)
        if block is None:
            return False
        self.held += block
        return True

    def line(self) -> bytes | None:
        while (end := self.held.find(b"\r\n")) < 0:
            if len(self.held) > 1 << 20:
                raise ValueError("header line too long")
            if not self._more():
                if self.held:
                    raise ValueError("archive ends within a header")
                return None
        line, self.held = self.held[:end], self.held[end + 2 :]
        return line

    def some(self, most: int) -> bytes:
        if not self.held and not self._more():
            raise ValueError("archive ends within a record")
        out, self.held = self.held[:most], self.held[most:]
        return out


def read_records(source: BinaryIO, chunk: int = CHUNK) -> Iterator[tuple]:
    """Rows of ``CHUNKS`` from one archive; an empty payload is one empty chunk."""
    reader = _Reader(_unpacked(source))
    while (version := reader.line()) is not None:
        if not version:
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record where one should start: {version[:40]!r}")
        headers = {}
        while line := reader.line():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        left, state, number, done = int(headers["content-length"]), hashlib.sha1(), 0, 0
        declared = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
        length = int(headers["x-payload-length"]) if "x-payload-length" in headers else None
        common = (
            headers.get("warc-record-id"),
            headers.get("warc-target-uri"),
            headers.get("warc-type"),
            headers.get("warc-refers-to"),
            declared,
            length,
        )
        while True:
            parts, size = [], min(chunk, left)
            while size:
                parts.append(reader.some(size))
                size -= len(parts[-1])
                left -= len(parts[-1])
            body = b"".join(parts)
            state.update(body)
            done += len(body)
            yield (*common, number, body, done, _digest(state), left == 0)
            number += 1
            if not left:
                break


def read_archives(spark: SparkSession, files: DataFrame, chunk: int = CHUNK, batch_bytes: int = 8 << 20) -> DataFrame:
    """Chunk rows of the archives in ``files`` (``path``): one task reads a file from start to end.

    A file that is cut off or holds anything but records fails the read instead of losing rows.
    """
    small_batches(spark)
    paths = files.select("path").repartition(max(1, min(files.count(), 4096)))

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)], schema=_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                where, path = _file(name)
                rows, held = [], 0
                with where.open_input_stream(path, compression=None) as source:
                    for row in read_records(source, chunk):
                        rows.append(row)
                        held += len(row[7]) + 300
                        if held > batch_bytes:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    return paths.mapInArrow(run, CHUNKS)


def record_summary(chunks: DataFrame) -> DataFrame:
    """One row per record: id, payload_bytes, payload_digest, record_type, refers_to, intact.

    Length and digest of a response are those of the bytes read; a revisit states those of the
    payload it refers to. ``intact`` says that what was read agrees with what the header states.
    """
    number = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:page:(-?\d*)>$", 1), F.lit("")).cast("bigint")
    revisit = F.col("record_type") == "revisit"
    digest = F.when(revisit, F.col("declared_digest")).otherwise(F.col("digest_so_far"))
    size = F.when(revisit, F.col("declared_bytes")).otherwise(F.col("bytes_so_far"))
    return chunks.where("is_last").select(
        number(F.col("record_id")).alias("id"),
        size.alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        number(F.col("refers_to")).alias("refers_to"),
        ((digest == F.col("declared_digest")) & (size == F.col("declared_bytes"))).alias("intact"),
    )
