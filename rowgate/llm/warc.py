"""WARC archives, written and read as tables of chunks.

A payload never exists whole in a Python task: writing takes (record, chunk
number, bytes) rows cut inside the JVM, reading gives such rows back, each with
the SHA-1 of its record's payload up to and including the chunk, so the last
chunk's digest is the payload's. Files are compressed record by record.

Writing commits through its manifest: each task attempt writes files of its own
and names them in the rows it returns, so files of lost attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm.frames import joined, read, scratch, written

CHUNK_BYTES = 1 << 20
# A file ends after the record that takes it over this many compressed bytes.
FILE_BYTES = 1 << 30
BATCH_BYTES = 8 << 20
READ_BYTES = 1 << 18
MANIFEST = "path string, records long, bytes long"
CHUNKS = (
    "record_id string, page_id long, record_type string, url string, refers_to long, "
    "payload_bytes long, claimed_digest string, chunk_no int, chunk binary, bytes_so_far long, "
    "digest_so_far string, is_last boolean"
)
# Fixed values of the format.
VERSION = b"WARC/1.1"
GENERATED_AT = "1970-01-01T00:00:00Z"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def opened(uri: str):
    """File system and path of a URI of the shared storage."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def payload_of(column: str = "html") -> Column:
    """UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, payload_bytes, sha1, record_type, refers_to).

    Equal payloads are found by length and SHA-256: digests are counted with
    partial sums, and only those of repeated payloads are joined back, so a payload
    held by a third of all pages is one small row.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload_of().alias("payload"),
    )
    rows = rows.withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "key": F.sha2("payload", 256)}
    )
    repeated = (
        rows.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("key", "payload_bytes")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("held_by"))
        .filter("held_by > 1")
    )
    repeated = written(repeated, "warc-repeated").select(
        F.col("key").alias("_key"), F.col("payload_bytes").alias("_bytes"), "first_id"
    )
    same = (F.col("key") == F.col("_key")) & (F.col("payload_bytes") == F.col("_bytes"))
    # Null ids come last; where all are null, all are responses.
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined(rows, repeated, same, "left").select(
        "page_id", "url", "payload", "payload_bytes",
        F.sha1("payload").alias("sha1"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def chunked(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk; a revisit, like an empty payload, is one empty chunk."""
    stored = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(
        F.lit(b"")
    )
    last = F.greatest(F.ceil(F.octet_length(stored) / chunk_bytes) - 1, F.lit(0)).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.substring(stored, i * chunk_bytes + 1, F.lit(chunk_bytes)),
    )
    others = [c for c in records.columns if c != "payload"]
    return records.select(
        *others, (last + 1).alias("chunks"), F.posexplode(pieces).alias("chunk_no", "chunk")
    )


def head_of(row: dict) -> tuple[bytes, bytes]:
    """The record's header and the HTTP header that opens its block."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    stored = row["payload_bytes"] if row["record_type"] == "response" else 0
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", record_name(row["page_id"])),
        ("WARC-Date", GENERATED_AT),
        ("WARC-Payload-Digest", "sha1:" + base32(bytes.fromhex(row["sha1"]))),
        ("X-Payload-Length", row["payload_bytes"]),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(http) + stored),
    ]
    if row["url"] is not None:
        # Neither blanks nor line ends may reach a header line.
        quoted = urllib.parse.quote(row["url"].encode("utf-8", "surrogatepass"), safe="!#$%&'()*+,/:;=?@[]~")
        fields.append(("WARC-Target-URI", quoted))
        fields.append(("X-Url", base64.b64encode(row["url"].encode()).decode()))
    if row["page_id"] is not None:
        fields.append(("X-Page-Id", row["page_id"]))
    if row["record_type"] == "revisit":
        fields += [
            ("WARC-Profile", SAME_PAYLOAD),
            ("WARC-Refers-To", record_name(row["refers_to"])),
            ("X-Refers-To-Page-Id", row["refers_to"]),
        ]
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields)]
    return b"\r\n".join(lines) + b"\r\n\r\n", http


def write_archives(chunks: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archives below ``folder`` and their manifest (path, records, bytes), written."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        out, member, done = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    if out is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, count = system.open_output_stream(f"{base}/{name}", compression=None), 0
                    member = zlib.compressobj(6, zlib.DEFLATED, 31)
                    seen = hashlib.sha1()
                    for part in head_of(row):
                        out.write(member.compress(part))
                seen.update(row["chunk"])
                out.write(member.compress(row["chunk"]))
                if row["chunk_no"] == row["chunks"] - 1:
                    if row["record_type"] == "response" and seen.hexdigest() != row["sha1"]:
                        raise ValueError(f"page {row['page_id']}: chunks are not the payload")
                    out.write(member.compress(b"\r\n\r\n") + member.flush())
                    count += 1
                    if out.tell() >= file_bytes:
                        done.append((f"{folder}/{name}", count, out.tell()))
                        out.close()
                        out = None
        if out is not None:
            done.append((f"{folder}/{name}", count, out.tell()))
            out.close()
        if done:
            yield pa.RecordBatch.from_pydict(
                dict(zip(("path", "records", "bytes"), map(list, zip(*done)), strict=True))
            )

    columns = [
        "page_id", "url", "payload_bytes", "sha1", "record_type", "refers_to", "chunks",
        "chunk_no", "chunk",
    ]
    return written(chunks.select(*columns).mapInArrow(store, MANIFEST), "warc-manifest")


class Inflated:
    """The uncompressed bytes of a file of gzip members, a bounded piece at a time."""

    def __init__(self, stream):
        self.stream, self.member, self.raw, self.buffer = stream, None, b"", bytearray()

    def more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.stream.read(READ_BYTES)
                if not self.raw:
                    if self.member is not None:
                        raise EOFError("the archive ends inside a record")
                    return False
            if self.member is None:
                self.member = zlib.decompressobj(31)
            piece = self.member.decompress(self.raw, CHUNK_BYTES)
            if self.member.eof:
                self.raw, self.member = self.member.unused_data, None
            else:
                self.raw = self.member.unconsumed_tail
            if piece:
                self.buffer += piece
                return True

    def take(self, most: int) -> bytes:
        """At least one byte, at most ``most``."""
        if not self.buffer and not self.more():
            raise EOFError("the archive ends inside a record")
        out = bytes(self.buffer[:most])
        del self.buffer[:most]
        return out

    def head(self) -> bytes | None:
        """Up to and without the next blank line; null at the end."""
        at = 0
        while (end := self.buffer.find(b"\r\n\r\n", at)) < 0:
            at = max(0, len(self.buffer) - 3)
            if not self.more():
                if self.buffer:
                    raise EOFError("the archive ends inside a header")
                return None
        out = bytes(self.buffer[:end])
        del self.buffer[: end + 4]
        return out


def chunks_of(stream, chunk_bytes: int) -> Iterator[dict]:
    """The chunk rows of one archive, in order."""
    archive = Inflated(stream)
    while (head := archive.head()) is not None:
        lines = head.decode().split("\r\n")
        if lines[0].encode() != VERSION:
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        http = archive.head()
        left = int(fields["content-length"]) - len(http) - 4
        page, refers, url = (fields.get(k) for k in ("x-page-id", "x-refers-to-page-id", "x-url"))
        row = {
            "record_id": fields["warc-record-id"],
            "page_id": None if page is None else int(page),
            "record_type": fields["warc-type"],
            "url": None if url is None else base64.b64decode(url).decode(),
            "refers_to": None if refers is None else int(refers),
            "payload_bytes": int(fields["x-payload-length"]),
            "claimed_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
        }
        digest, number, seen = hashlib.sha1(), 0, 0
        while True:
            chunk = bytearray()
            while left and len(chunk) < chunk_bytes:
                piece = archive.take(min(left, chunk_bytes - len(chunk)))
                chunk += piece
                left -= len(piece)
            digest.update(chunk)
            seen += len(chunk)
            yield row | {
                "chunk_no": number, "chunk": bytes(chunk), "bytes_so_far": seen,
                "digest_so_far": base32(digest.digest()), "is_last": not left,
            }
            number += 1
            if not left:
                break
        if archive.head() != b"":
            raise ValueError("the record does not end where its length says")


def read_archives(paths: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of archives, of a frame with their ``path``.

    ``digest_so_far`` covers the record's payload up to and including the chunk. A
    file is read by one task as a stream; at most ``BATCH_BYTES`` of chunks are held.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, name = opened(path)
                with system.open_input_stream(name, compression=None) as stream:
                    for row in chunks_of(stream, chunk_bytes):
                        rows.append(row)
                        held += len(row["chunk"]) + 500
                        if held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=CHUNK_SCHEMA)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=CHUNK_SCHEMA)

    # Each file is a task's work of its own.
    files = paths.select("path").repartition("path")
    return files.mapInArrow(load, CHUNKS)


CHUNK_SCHEMA = pa.schema(
    [
        ("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
        ("url", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
        ("claimed_digest", pa.string()), ("chunk_no", pa.int32()), ("chunk", pa.binary()),
        ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("is_last", pa.bool_()),
    ]
)


def records_of(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk; a wrong stored payload fails the job.

    A revisit stores no payload, so its digest and length are those of its header.
    """
    response = F.col("record_type") == "response"
    sound = (F.col("bytes_so_far") == F.col("payload_bytes")) & (
        F.col("digest_so_far") == F.col("claimed_digest")
    )
    checked = F.when(~response | sound, F.col("claimed_digest")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record "), F.col("record_id")))
    )
    return chunks.filter("is_last").select(
        "page_id", "payload_bytes", checked.alias("payload_digest"), "record_type", "refers_to",
        "record_id", "url",
    )


def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a WARC record per page, then read the archives back.

    A null html is an empty payload; a null url has no target; a row whose page_id
    repeats the smallest one of its payload is a response like it; null page_ids
    come last; an empty table gives no archives and no rows.
    """
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    manifest = write_archives(chunked(with_revisits(pages)), scratch(spark, "warc"))
    return records_of(read_archives(manifest)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


QUERIES = {"op3_warc_chunks": op3_warc_chunks}
# The files are bytes, which SQL neither writes nor reads; tests hold the query to
# brute force and to a round trip.
SQL: dict[str, str] = {}
