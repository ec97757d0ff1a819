"""WARC archives: written by tasks, read back by a sequential reader.

Each record is one gzip member. The reader takes an archive as a stream of small
blocks: it decompresses incrementally, frames a record's content by its length and
compares the digests, so that a task holds one record and not one archive. Archives
lie in a folder that driver and executors share and are addressed through Arrow file
systems; a manifest table names those whose task ended well, so files of lost or
repeated tasks are never read.

Records with equal payloads are found by digest. The row with the smallest page_id is
the response; others refer to it (a repeated row with that page_id is a response
again). Payloads below ``least_bytes`` are all responses. Null payloads count as
empty. A null page_id or url leaves its header out and comes back as null.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch_dir, stage
from .texts import batch_of, map_batches, table

BLOCK = 1 << 16
#: A task starts a new archive beyond so many compressed bytes.
ARCHIVE_BYTES = 256_000_000
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


class Record(NamedTuple):
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_uri(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def page_of(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str, level: int
) -> bytes:
    """One WARC record as one gzip member. A revisit carries the HTTP header without the payload."""
    digest = base32_sha1(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {page_uri(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid4()}>'}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        safe = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)
        lines.insert(3, f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {page_uri(refers_to)}", f"WARC-Profile: {_REVISIT_PROFILE}"]
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, value in pairs}


def members(read: Callable[[int], bytes], block: int = BLOCK) -> Iterator[Iterator[bytes]]:
    """Each gzip member of a stream, as an iterator of decompressed parts of at most
    ``block`` bytes. A member must be consumed before the next one is asked for."""
    waiting = read(block)
    while waiting:
        inflater = zlib.decompressobj(31)

        def parts() -> Iterator[bytes]:
            nonlocal waiting
            while not inflater.eof:
                if not waiting:
                    waiting = read(block)
                    if not waiting:
                        raise EOFError("archive ends within a member")
                part = inflater.decompress(waiting, block)
                waiting = inflater.unconsumed_tail or (inflater.unused_data if inflater.eof else b"")
                if part:
                    yield part

        yield parts()
        while waiting == b"" and (more := read(block)):
            waiting = more


def records(read: Callable[[int], bytes]) -> Iterator[Record]:
    """The records of an archive in order; raises ValueError on wrong framing or digest."""
    for parts in members(read):
        buffer = bytearray()
        split = -1
        for part in parts:
            buffer += part
            split = buffer.find(b"\r\n\r\n")
            if split >= 0:
                break
        if split < 0 or not buffer.startswith(b"WARC/"):
            raise ValueError("no record header")
        headers = _fields(bytes(buffer[:split]))
        content = buffer[split + 4 :]
        length = int(headers["content-length"])
        for part in parts:
            content += part
            if len(content) > length + 4:
                break
        if len(content) != length + 4 or content[length:] != b"\r\n\r\n":
            raise ValueError(f"content of {headers.get('warc-record-id')} is not as long as stated")
        block = bytes(content[:length])
        if headers["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
            raise ValueError(f"block digest of {headers.get('warc-record-id')} differs")
        head, _, payload = block.partition(b"\r\n\r\n")
        http = _fields(head)
        if headers["warc-type"] == "response" and headers["warc-payload-digest"] != f"sha1:{base32_sha1(payload)}":
            raise ValueError(f"payload digest of {headers.get('warc-record-id')} differs")
        yield Record(headers, http, payload)


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")


def with_first_page(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``: null for a response.

    The join is on the digest of the payload; a digest that a large part of the pages
    has meets one row only, and adaptive execution splits its rows over tasks.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("_digest", F.sha1("payload"))
    firsts = (
        rows.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("_digest")
        .agg(F.min("page_id").alias("_first"))
    )
    other = F.when(F.col("page_id") != F.col("_first"), F.col("_first"))
    nameless = F.when(F.col("page_id").isNull(), F.col("_first"))
    return rows.join(firsts, "_digest", "left").select(
        "page_id", "url", "payload", F.coalesce(other, nameless).alias("refers_to")
    )


def write_archives(
    rows: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 1,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes ``rows`` (see ``with_first_page``) as archives in ``folder``; returns the manifest."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(folder)
        system.create_dir(root, recursive=True)
        stream, path, size, count = None, "", 0, 0
        done: list[tuple[str, int, int]] = []

        def close() -> None:
            stream.close()
            system.move(f"{root}/{path}.open", f"{root}/{path}")
            done.append((f"{folder}/{path}", count, size))

        try:
            for batch in batches:
                columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]
                for values in zip(*columns):
                    page_id, url, payload, refers_to = (v.as_py() for v in values)
                    if stream is None:
                        path, size, count = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                        stream = system.open_output_stream(f"{root}/{path}.open", compression=None)
                    data = record_bytes(page_id, url, payload.encode("utf-8", "surrogatepass"), refers_to, date, level)
                    stream.write(data)
                    size, count = size + len(data), count + 1
                    if size >= archive_bytes:
                        close()
                        stream = None
            if stream is not None:
                close()
                stream = None
        finally:
            if stream is not None:
                stream.close()
                system.delete_file(f"{root}/{path}.open")
        yield batch_of(
            path=pa.array([p for p, _, _ in done], pa.string()), records=pa.array([n for _, n, _ in done], pa.int64()),
            bytes=pa.array([s for _, _, s in done], pa.int64()),
        )

    manifest = map_batches(rows, ["page_id", "url", "payload", "refers_to"], task, "path string, records bigint, bytes bigint")
    return stage(manifest, "warc-manifest")


_SCHEMA = (
    "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, payload binary"
)


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives that ``manifest`` names; ``payload`` is null for
    revisits, or for all if not asked for."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inner = _file_system(path)
                with system.open_input_stream(inner, compression=None) as stream:
                    yield from _batches(records(stream.read), payloads)

    archives = manifest.select("path")
    number = max(1, manifest.count())
    return map_batches(archives.repartition(number), ["path"], task, _SCHEMA)


def _batches(found: Iterator[Record], payloads: bool, bound: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0

    def flush() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        names = [c.split()[0] for c in _SCHEMA.split(", ")]
        return batch_of(**{n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(zip(names, kinds))})

    for r in found:
        kept = r.payload if payloads and r.headers["warc-type"] == "response" else None
        rows.append((
            page_of(r.headers["warc-record-id"]), r.headers.get("warc-target-uri"), r.headers["warc-type"],
            int(r.http["content-length"]), r.headers["warc-payload-digest"].removeprefix("sha1:"),
            page_of(r.headers.get("warc-refers-to")), kept,
        ))
        held += len(kept or b"")
        if held > bound or len(rows) >= 10_000:
            yield flush()
            rows, held = [], 0
    if rows:
        yield flush()


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(with_first_page(table(spark, sf_dir, "pages")), scratch_dir(spark, "warc"))
    return read_archives(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


QUERIES = {"op8_warc": op8_warc}
SQL: dict[str, str] = {}
