"""WARC archives and their chunked record table.

A payload crosses Python in parts: it is written to its archive part by part, and read back as rows of record,
chunk number and bytes, each with the digest of the payload up to and including that chunk. The last chunk of a
record so carries the digest of all of it, and no task holds a whole record of the archive.

Records with equal payloads are stored once: the one with the smallest page_id is a response, others are
revisits that name it. Archives are gzipped by record, written under names no other attempt uses, and become
part of the result only through the manifest, which Spark commits once per task.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailrace.llm.tables import Tables
from tailrace.sources.files import locate

_PART = 1 << 20
_DATE = b"1970-01-01T00:00:00Z"  # records carry no clock time, so a repeated run writes the same bytes
MANIFEST = "path string, records bigint, bytes bigint"
CHUNKS = (
    "path string, record_id string, record_type string, page_id bigint, refers_to bigint, chunk int, last boolean, "
    "payload_bytes bigint, content binary, digest string, declared_digest string"
)


def planned(pages: DataFrame, tables: Tables, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest, record_type and refers_to of every row.

    ``pages`` has page_id, url and payload (binary). Of rows alike in payload and page_id, one is the response. The
    table is read twice and must give rows in the same places both times, as a scan of files does.
    """
    rows = pages.withColumn("row", F.monotonically_increasing_id()).withColumn("digest", F.unhex(F.sha1("payload")))
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")
    first = rows.groupBy("digest", F.length("payload").alias("size")).agg(F.min(order).alias("first"), F.count("*").alias("copies"))
    first = tables.keep(first.where((F.col("copies") > 1) & (F.col("size") >= least_bytes)).select("digest", "first"), "repeated")
    again = F.col("first.row").isNotNull() & (F.col("first.row") != F.col("row"))
    kind = F.when(again, "revisit").otherwise("response")
    joined = rows.join(first, "digest", "left")
    return joined.select("page_id", "url", "payload", "digest", kind.alias("record_type"), F.when(again, F.col("first.page_id")).alias("refers_to"))


def _block_head(size: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size


def _name(page_id: int | None) -> str:
    return f"urn:page:{page_id}" if page_id is not None else "urn:page:none"


def record_parts(page_id, url, payload, digest: str, kind: str, refers_to) -> Iterator[bytes]:
    """The bytes of a record, a part of the payload at a time. ``payload`` can be sliced and measured."""
    size = len(payload)
    block = _block_head(size)
    head = [
        b"WARC/1.1", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <%s>" % _name(page_id).encode(),
        b"WARC-Date: " + _DATE, b"WARC-Payload-Digest: sha1:" + digest.encode(),
    ]
    if url is not None:
        head.append(b"WARC-Target-URI: " + " ".join(url.split()).encode())
    if kind == "revisit":
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: <%s>" % _name(refers_to).encode()]
    body = size if kind == "response" else 0
    head += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % (len(block) + body)]
    yield b"\r\n".join(head) + b"\r\n\r\n" + block
    for a in range(0, body, _PART):
        yield bytes(payload[a : a + _PART])
    yield b"\r\n\r\n"


def write_archives(plan: DataFrame, folder: str, archive_bytes: int = 1 << 30, level: int = 1) -> DataFrame:
    """Writes the rows of ``planned`` as gzipped archives of about ``archive_bytes`` and returns their manifest, not yet run."""

    def run(batches):
        system, base = locate(folder)
        system.create_dir(base, recursive=True)
        out, path, records, size = None, None, 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, digest, kind, refers = (batch.column(c)[i].as_py() for c in ("page_id", "url", "digest", "record_type", "refers_to"))
                payload, digest = batch.column("payload")[i].as_buffer() or b"", base64.b32encode(digest).decode()
                if out is None:
                    path, records, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{base}/{path}", compression=None)
                pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                for part in record_parts(page_id, url, memoryview(payload), digest, kind, refers):
                    size += out.write(pack.compress(part))
                size += out.write(pack.flush())
                records += 1
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield _manifest_row(f"{folder}/{path}", records, size)
        if out is not None:
            out.close()
            yield _manifest_row(f"{folder}/{path}", records, size)

    return plan.mapInArrow(run, MANIFEST)


def _manifest_row(path: str, records: int, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})


class Members:
    """Plain bytes of a gzipped archive, member by member, read ``_PART`` bytes at a time."""

    def __init__(self, file):
        self.file, self.raw, self.plain = file, b"", b""
        self.unpack = zlib.decompressobj(31)

    def more(self) -> bool:
        """Adds to ``plain``; false at the end of the archive."""
        while True:
            if self.unpack.eof:
                self.raw, self.unpack = self.unpack.unused_data + self.raw, zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.file.read(_PART)
                if not self.raw:
                    return False
            got = self.unpack.decompress(self.raw, _PART)
            self.raw = self.unpack.unconsumed_tail
            if got:
                self.plain += got
                return True

    def take_until(self, mark: bytes) -> bytes | None:
        while (at := self.plain.find(mark)) < 0:
            if not self.more():
                return None
        head, self.plain = self.plain[:at], self.plain[at + len(mark) :]
        return head

    def take(self, most: int) -> bytes:
        """Some bytes, ``most`` at the most; empty only at the end."""
        if not self.plain:
            self.more()
        out, self.plain = self.plain[:most], self.plain[most:]
        return out


def _headers(head: bytes) -> dict[str, str]:
    lines = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {k.strip().lower().decode(): v.strip().decode() for k, _, v in lines}


def _page(name: str | None) -> int | None:
    tail = (name or "").strip("<>").removeprefix("urn:page:")
    return int(tail) if tail.lstrip("-").isdigit() else None


def read_chunks(manifest: DataFrame, chunk_bytes: int = _PART, content: bool = True) -> DataFrame:
    """Rows of record and chunk number of the archives in ``manifest``; an empty payload has one empty chunk.

    ``payload_bytes`` and ``digest`` are of the payload up to and including the chunk; a revisit, which has no
    payload of its own, carries those its headers declare, as its only chunk.
    """

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, name = locate(path)
                with system.open_input_stream(name, compression=None) as file:
                    for rows in _batched(_chunks(Members(file), path, chunk_bytes, content), chunk_bytes):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _CHUNK_TYPES)], [c.split()[0] for c in CHUNKS.split(", ")])

    return manifest.select("path").mapInArrow(run, CHUNKS)


_CHUNK_TYPES = [pa.string()] * 3 + [pa.int64()] * 2 + [pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.string(), pa.string()]


def _batched(rows: Iterator[tuple], chunk_bytes: int) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[8] or b"")
        if len(held) >= 4096 or size >= 4 * chunk_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def _chunks(source: Members, path: str, chunk_bytes: int, content: bool) -> Iterator[tuple]:
    while (head := source.take_until(b"\r\n\r\n")) is not None:
        fields = _headers(head)
        block = source.take_until(b"\r\n\r\n")
        size = int(_headers(block)["content-length"])
        left = int(fields["content-length"]) - len(block) - 4
        kind, declared = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
        record = (path, fields["warc-record-id"].strip("<>"), kind, _page(fields["warc-record-id"]), _page(fields.get("warc-refers-to")))
        if kind == "revisit":
            yield (*record, 0, True, size, None, declared, declared)
        else:
            mark, seen, number = hashlib.sha1(), 0, 0
            while True:
                parts, room = [], min(chunk_bytes, left)
                while room and (part := source.take(room)):
                    parts.append(part)
                    room -= len(part)
                data = b"".join(parts)
                mark.update(data)
                left, seen = left - len(data), seen + len(data)
                if room:
                    raise ValueError(f"{path}: record {record[1]} ends early")
                digest = base64.b32encode(mark.copy().digest()).decode()
                yield (*record, number, left == 0, seen, data if content else None, digest, declared)
                number += 1
                if not left:
                    break
        source.take_until(b"\r\n\r\n")


def archived(pages: DataFrame, least_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Writes ``pages`` (page_id, url, payload) and returns the manifest and the chunk table without contents.

    A null payload is an empty one. A row with a null page_id is a record of its own, which is response only if all
    copies have none. Repeated rows are records each; an empty table has no archives.
    """
    spark: SparkSession = pages.sparkSession
    tables = Tables(spark, "warc")
    pages = pages.select("page_id", "url", F.coalesce("payload", F.lit(b"")).alias("payload"))
    manifest = tables.keep(write_archives(planned(pages, tables, least_bytes), tables.path("archives")), "manifest")
    files = max(manifest.count(), 1)
    return manifest, read_chunks(manifest.repartition(min(files, 10_000)), content=False)
