"""WARC archives by way of a chunked record table.

Payloads are cut into rows (record, chunk number, bytes) before they reach a
writer, and come back from a reader the same way, each row with the length and
the SHA-1 of the payload so far. Neither side holds a whole payload.

Writers: every task writes one archive into a folder that all executors see, a
gzip member for each record, and returns its name; only archives of tasks that
ended are in the manifest, so a lost or repeated task leaves no double records.
Of records with equal payloads the one of the least id is a response, and the
others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import staged
from casegrid.session import ensure_checkpoint_dir

CHUNK = 1 << 20
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_READ = 1 << 18


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _urn(record: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, record)}>"


def _line(text: str | None) -> str:
    """A header's value: line ends would start another header."""
    return " ".join((text or "").split("\r")).replace("\n", " ")


def record_table(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int, chunk: int) -> DataFrame:
    """Rows (id, url, refers_to, length, sha1, chunk, chunks, data); revisits have one row without data."""
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("length", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1("payload"))
    firsts = (rows.where(F.col("length") >= min_bytes).groupBy("sha1").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("sha1", "first"))
    rows = rows.join(staged(firsts, "equal-payloads"), "sha1", "left")
    refers = F.when((F.col("length") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    rows = rows.withColumn("refers_to", refers)
    chunks = F.when(F.col("refers_to").isNull(), F.greatest(F.lit(1), F.ceil(F.col("length") / chunk))).otherwise(1).cast("int")
    rows = rows.withColumn("chunks", chunks)
    data = F.when(F.col("refers_to").isNull(), F.col("payload").substr(F.col("chunk") * chunk + 1, F.lit(chunk)))
    return (rows.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
            .select("id", "url", "refers_to", "length", "sha1", "chunk", "chunks", data.alias("data")))


def _headers(row: dict, record: str) -> bytes:
    """The WARC header and the HTTP header of one record."""
    revisit, digest = row["refers_to"] is not None, base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['length']}\r\n\r\n".encode()
    url = _line(row["url"])
    page = "" if row["id"] is None else str(row["id"])
    lines = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(record)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-Id: {page}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"X-Refers-To-Page-Id: {row['refers_to']}"]
    lines += ["Content-Type: application/http;msgtype=response",
              f"Content-Length: {len(http) + (0 if revisit else row['length'])}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId() if context else 0:06d}-{uuid.uuid4().hex}.warc.gz"
        out, member, records = None, None, 0
        for batch in batches:
            heads = batch.drop_columns(["data"]).to_pylist()
            data = batch.column(batch.schema.get_field_index("data"))
            for i, row in enumerate(heads):
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                if row["chunk"] == 0:
                    member, records = zlib.compressobj(1, zlib.DEFLATED, 31), records + 1
                    out.write(member.compress(_headers(row, f"{name}#{records}")))
                if data[i].is_valid:
                    out.write(member.compress(data[i].as_buffer()))
                if row["chunk"] + 1 == row["chunks"]:
                    out.write(member.compress(b"\r\n\r\n"))
                    out.write(member.flush())
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([records], pa.int64())], names=["path", "records"])

    return run


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Write a record for each row into archives below ``folder``; returns the manifest (path, records).

    A null payload is empty. Payloads of at least ``min_bytes`` that are equal (by
    SHA-1 and, with it, content) are written once, by the rows of the least id, and
    revisited by the others; a row without an id revisits one that has an id, and
    is a response where none has. An empty table writes no archive.
    """
    folder = (folder or f"{ensure_checkpoint_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}").rstrip("/")
    rows = record_table(pages, id_col, url_col, payload_col, min_bytes, chunk)
    return staged(rows.mapInArrow(_write(folder), "path string, records long"), "manifest")


class _Stream:
    """Bytes of an archive, unpacked member by member, without ever holding a record."""

    def __init__(self, raw):
        self.raw, self.member, self.have = raw, zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Unpack some more; False at the end."""
        while True:
            packed = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            packed = packed or self.raw.read(_READ)
            if not packed:
                return False
            if self.member.eof:
                self.member = zlib.decompressobj(31)
            made = self.member.decompress(packed, _READ)
            if made:
                self.have += made
                return True

    def until(self, end: bytes) -> bytes | None:
        """What comes before ``end``, which is skipped; None if the archive is over."""
        start = 0
        while (at := self.have.find(end, start)) < 0:
            start = max(0, len(self.have) - len(end))
            if not self.more():
                return None
        found, self.have = self.have[:at], self.have[at + len(end) :]
        return found

    def take(self, size: int) -> bytes:
        """The next ``size`` bytes; ``size`` is at most a chunk."""
        while len(self.have) < size:
            if not self.more():
                raise ValueError("the archive ends within a record")
        found, self.have = self.have[:size], self.have[size:]
        return found


def _fields(block: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in block.decode().split("\r\n")[1:])}


_CHUNK_DDL = ("record string, page_id long, url string, record_type string, refers_to long, length long, chunk int, last boolean, "
              "bytes_so_far long, sha1_so_far binary, data binary")


def _records(path: str, chunk: int, with_data: bool) -> Iterator[dict]:
    system, place = _file_system(path)
    number = lambda x: int(x) if x else None
    with system.open_input_stream(place, compression=None) as raw:
        stream = _Stream(raw)
        while (block := stream.until(b"\r\n\r\n")) is not None:
            head = _fields(block)
            http_block = stream.until(b"\r\n\r\n")
            revisit = head["warc-type"] == "revisit"
            length = int(_fields(http_block)["content-length"])
            left = 0 if revisit else int(head["content-length"]) - len(http_block) - 4
            digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:"))
            row = {"record": head["warc-record-id"], "page_id": number(head.get("x-page-id")), "url": head["warc-target-uri"],
                   "record_type": head["warc-type"], "refers_to": number(head.get("x-refers-to-page-id")), "length": length}
            at, so_far, seen = 0, hashlib.sha1(), 0
            while True:
                data = stream.take(min(chunk, left))
                left -= len(data)
                seen += len(data)
                so_far.update(data)
                last = not left
                if last and not revisit and (so_far.digest() != digest or seen != length):
                    raise ValueError(f"{path}: the payload of {row['record']} doesn't have the digest of its header")
                # a revisit stands for the payload that its header describes
                yield row | {"chunk": at, "last": last, "bytes_so_far": length if revisit else seen,
                             "sha1_so_far": digest if revisit else so_far.digest(), "data": data if with_data and not revisit else None}
                at += 1
                if last:
                    break
            if stream.take(4) != b"\r\n\r\n":
                raise ValueError(f"{path}: a record isn't closed")


def read_archives(manifest: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunked record table of all archives that ``manifest`` names in ``path``.

    A row for each chunk: record, page_id, url, record_type, refers_to, length,
    chunk, last, ``bytes_so_far`` and ``sha1_so_far`` (of the payload up to this
    chunk's end), data. A payload that doesn't match its header is an error. Revisits
    have one row, with the length and digest of the payload that they refer to.
    """
    names = [x.split()[0] for x in _CHUNK_DDL.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], types[x.split()[1]]) for x in _CHUNK_DDL.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for row in _records(path, chunk, with_data):
                    rows.append(row)
                    size += 500 + len(row["data"] or b"")
                    if size > 16 * CHUNK:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = max(1, manifest.count())
    return manifest.select("path").repartition(files, "path").mapInArrow(run, _CHUNK_DDL).select(*names)
