"""WARC archives: monolithic gzip files, their normaliser and an indexed reader.

Pages are written as WARC records into whole-file gzip streams (one stream for
all records, as some crawlers leave them). The normaliser inflates such a
stream once, from front to back and in bounded memory, rewrites every record as
a gzip member of its own and writes a sidecar index (offset, length, record id)
beside the archive. Readers then seek to any member.

Equal payloads are found by digest before writing: the record of the smallest
page_id is the response, the others revisit it and carry no payload.

Archives live under the shared folder. A file's name holds a fresh id for each
task attempt and only files reported by the attempt that Spark accepted are
read on, so lost executors leave nothing but unread files.

Defined results: a null html is an empty payload; a null url leaves the target
out; control characters in urls are percent-encoded; rows of a payload's
smallest page_id (repeated rows too) are responses; a null page_id is larger
than any other; payloads under ``revisit_from`` bytes are all responses; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.common import partitions, stored
from candela.session import scratch_path

#: Payload bytes after which a writer begins a new archive.
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def deduplicated(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Pages with payload digest, record type and the page they refer to."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("sha1")
    )
    first = rows.filter(F.octet_length("html") >= revisit_from).groupBy("sha1").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")
    )
    first = first.filter("copies > 1").drop("copies")
    joined = rows.join(first, "sha1", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "html", "sha1", F.when(revisit, F.col("first")).alias("refers_to"))


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, html: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record; a revisit keeps the HTTP header, which holds the full payload's length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html)
    block = http + (html if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_monolithic(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the records, a gzip stream for each file; returns the accepted files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        out = packer = None
        name, count, size = "", 0, 0
        files: list[tuple[str, int]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, count, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    store.create_dir(base, recursive=True)
                    out, packer = store.open_output_stream(name, compression=None), zlib.compressobj(1, zlib.DEFLATED, 31)
                html = row["html"].encode("utf-8", "surrogatepass")
                digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode("ascii")
                out.write(packer.compress(record(row["page_id"], row["url"], html, digest, row["refers_to"])))
                count, size = count + 1, size + len(html)
                if size >= archive_bytes:
                    out.write(packer.flush())
                    out.close()
                    files.append((name, count))
                    out = None
        if out is not None:
            out.write(packer.flush())
            out.close()
            files.append((name, count))
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in files], pa.string()), pa.array([f[1] for f in files], pa.int64())], ["path", "records"])

    return stored(rows.mapInArrow(run, "path string, records long"), "warc-raw")


def inflated(stream) -> Iterator[bytes]:
    """Chunks of a gzip stream, members one after another or a single one; bounded memory."""
    engine = zlib.decompressobj(31)
    while data := stream.read(CHUNK):
        while data:
            if part := engine.decompress(data, CHUNK):
                yield part
            if engine.eof:
                data, engine = engine.unused_data, zlib.decompressobj(31)
            else:
                data = engine.unconsumed_tail
                if not data and not part:
                    break
        while not engine.eof and (part := engine.decompress(b"", CHUNK)):
            yield part


def split_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of a stream of WARC bytes, by their Content-Length."""
    held = bytearray()
    for chunk in chunks:
        held += chunk
        at = 0
        while (end := held.find(b"\r\n\r\n", at)) >= 0:
            size = int(re.search(rb"\r\nContent-Length: *(\d+)", held[at : end + 2], re.IGNORECASE)[1])
            if len(held) < end + 4 + size + 4:
                break
            yield bytes(held[at : end + 4 + size + 4])
            at = end + 4 + size + 4
        del held[:at]
    if held:
        raise ValueError(f"truncated archive: {len(held)} bytes are no whole record")


def header(data: bytes, name: bytes) -> str | None:
    end = data.find(b"\r\n\r\n")
    found = re.search(rb"\r\n" + name + rb": *([^\r\n]*)", data[:end], re.IGNORECASE)
    return found[1].decode("utf-8", "surrogatepass") if found else None


def normalise(files: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrites each file record by record; returns the index (path, offset, length, record_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store.create_dir(base, recursive=True)
                name, at = f"{base}/{uuid.uuid4().hex}", 0
                index: list[tuple[int, int, str]] = []
                with store.open_input_stream(path, compression=None) as source, store.open_output_stream(f"{name}.warc.gz", compression=None) as out:
                    for data in split_records(inflated(source)):
                        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = packer.compress(data) + packer.flush()
                        out.write(member)
                        index.append((at, len(member), header(data, b"WARC-Record-ID") or ""))
                        at += len(member)
                with store.open_output_stream(f"{name}.idx", compression=None) as out:
                    out.write("".join(f"{o} {n} {i}\n" for o, n, i in index).encode())
                offsets, lengths, ids = zip(*index, strict=True) if index else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{name}.warc.gz"] * len(index), pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.string())],
                    ["path", "offset", "length", "record_id"],
                )

    # One archive a task; the file names are few, so this exchange is small.
    dealt = files.repartition(max(partitions(files), 1), "path")
    return stored(dealt.mapInArrow(run, "path string, offset long, length long, record_id string"), "warc-index")


def read_indexed(index: DataFrame, folder: str) -> DataFrame:
    """Reads members back by the index; payloads of responses are digested anew and must match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        source, opened = None, ""
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if row["path"] != opened:
                    if source is not None:
                        source.close()
                    source, opened = store.open_input_file(row["path"]), row["path"]
                source.seek(row["offset"])
                data = zlib.decompress(source.read(row["length"]), 31)
                out.append(parsed(data))
            names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], list(names))
        if source is not None:
            source.close()

    dealt = index.repartitionByRange(partitions(index), "path", "offset").sortWithinPartitions("path", "offset")
    return dealt.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def page_of(identifier: str | None) -> int | None:
    digits = (identifier or "")[len("<urn:x-page:") : -1]
    return int(digits) if digits else None


def parsed(data: bytes) -> tuple:
    """Page, target, payload length and digest, record type and referred page of a record."""
    kind, digest = header(data, b"WARC-Type"), (header(data, b"WARC-Payload-Digest") or "").removeprefix("sha1:")
    block = data[data.index(b"\r\n\r\n") + 4 : -4]
    size = int(re.search(rb"\r\nContent-Length: *(\d+)", block)[1])
    if kind == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if len(payload) != size or base32_digest(payload) != digest:
            raise ValueError(f"payload of {header(data, b'WARC-Record-ID')} differs from its digest")
    refers = page_of(header(data, b"WARC-Refers-To")) if kind == "revisit" else None
    return page_of(header(data, b"WARC-Record-ID")), header(data, b"WARC-Target-URI"), size, digest, kind, refers


def warc_roundtrip(pages: DataFrame, folder: str | None = None, revisit_from: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the pages, normalises the archives and reads every record back."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    uri = folder if "://" in folder or folder.startswith("/") else re.sub(r"^file:/+", "file:///", folder)
    files = write_monolithic(deduplicated(pages, revisit_from), f"{uri}/raw", archive_bytes)
    return read_indexed(normalise(files, f"{uri}/members"), uri)


def base32_sql(sha1_hex: str) -> str:
    """DuckDB expression: bare upper-case base32 of a 40-digit hex string."""
    digits = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    five = f"('0x' || substr({sha1_hex}, i * 5 + 1, 5))::BIGINT"
    four = " || ".join(f"substr({digits}, ((({five}) >> {s}) & 31)::INT + 1, 1)" for s in (15, 10, 5, 0))
    return f"array_to_string(list_transform(range(0, 8), lambda i: {four}), '')"


def warc_roundtrip_sql() -> str:
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {base32_sql('p.h')} AS payload_digest,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM p JOIN f USING (h)"""
