"""WARC archives as chunked record tables.

Writing. Equal payloads are found by digest and length on rows without payloads. The record with the smallest page id of
a group is a response with the payload; the others revisit it. Each task streams its records to an archive of
gzip members in the shared folder, payload by payload in chunks, and returns a row for each archive it closed. That
list is written by Spark, so it holds archives of committed tasks only: what a lost executor left is never read.

Reading. Each task streams its archives block by block. A payload becomes rows of record, chunk number, bytes, and the
length and digest so far; a record of any size takes the memory of one chunk. The digest of the last chunk must be that
of the header, else the archive is reported as damaged.

Defined results: a null payload is empty; an empty payload is one chunk of no bytes; pages with equal ids are separate
records, told apart by their place, and the first of them is the response of their payload; a null id ranks last; a null
or empty url becomes a urn of the id; line breaks and spaces in a url are escaped. An empty table makes no archive. Other
columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.stored import PLACE_TYPE, placed, stored
from quayside.session import apply_settings, new_folder

CHUNK_BYTES = 1 << 18
#: Compressed size at which a task goes on with a new archive.
ARCHIVE_BYTES = 256 << 20
#: Payloads shorter than this are never revisits.
MIN_REVISIT_BYTES = 0

#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record_id(place: dict) -> str:
    """Record identifier from a row's place, so a repeated task gives the same."""
    return str(uuid.UUID(bytes=hashlib.md5(f"{place['file']}:{place['row']}".encode()).digest()))


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark would resolve it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return uri.replace("file:/", "file:///", 1) if not uri.startswith("file://") else uri


def decide(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """place, page_id, sha1, bytes, response (place and page_id of the record that holds the payload) of each page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = placed(pages, "_place").select(
        F.col("_place").alias("place"),
        F.col("page_id").cast("long").alias("page_id"),
        F.sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    own = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "place")
    first = rows.filter(F.col("bytes") >= min_revisit_bytes).groupBy("sha1", "bytes").agg(F.min(own).alias("response"))
    return rows.join(first, ["sha1", "bytes"], "left").withColumn("response", F.coalesce("response", own))


def _header(row: dict, date: str) -> tuple[bytes, bool]:
    """Header block with the start of the record's own block, and whether the payload follows."""
    response = row["response"]
    revisit = response["place"] != row["place"]
    head = HTTP_HEAD.format(row["bytes"]).encode()
    uri = quote(row["url"] or "", safe="!#$%&'()*+,/:;=?@[]~") or f"urn:page:{row['page_id']}"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{record_id(row['place'])}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{base32(row['sha1'])}"),
        ("Payload-Length", row["bytes"]),
        ("Page-Id", "" if row["page_id"] is None else row["page_id"]),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", f"<urn:uuid:{record_id(response['place'])}>"),
            ("Refers-To-Page-Id", "" if response["page_id"] is None else response["page_id"]),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(head) + (0 if revisit else row["bytes"]))]
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + head, not revisit


def _writer(folder: str, date: str, archive_bytes: int, chunk_bytes: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        out, name, records = None, "", 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.record_batch([pa.array([f"{folder}/{name}"]), pa.array([records], pa.int64())], names=["path", "records"])

        for batch in batches:
            columns = {c: batch.column(c) for c in ("place", "page_id", "url", "sha1", "bytes", "response")}
            payloads = batch.column("payload")
            for i in range(batch.num_rows):
                if out is None:
                    name, records = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                header, with_payload = _header({c: v[i].as_py() for c, v in columns.items()}, date)
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                out.write(pack.compress(header))
                if with_payload:
                    view = memoryview(payloads[i].as_buffer())
                    for at in range(0, len(view), chunk_bytes):
                        out.write(pack.compress(view[at : at + chunk_bytes]))
                out.write(pack.compress(b"\r\n\r\n"))
                out.write(pack.flush())
                records += 1
                if out.tell() >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return write


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    date: str = "2024-01-01T00:00:00Z",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Write `pages` (page_id, url, html) as archives below `folder`; path and records of each archive."""
    spark = apply_settings(pages.sparkSession)
    pages = stored(pages)
    folder = qualified(spark, folder or new_folder(spark, "warc"))
    decided = decide(pages, min_revisit_bytes)
    # By place: payloads of revisits, a third of all perhaps, spread evenly.
    rows = placed(pages, "_place").select(
        F.col("_place").alias("place"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")
    )
    joined = rows.join(decided, "place").select("place", "page_id", "url", "sha1", "bytes", "response", "payload")
    joined.mapInArrow(_writer(f"{folder}/archives", date, archive_bytes, chunk_bytes), "path string, records bigint").write.parquet(
        f"{folder}/list"
    )
    return spark.read.parquet(f"{folder}/list")


class _Stream:
    """Bytes of an archive, plain or of gzip members, block by block."""

    def __init__(self, raw, block: int = 1 << 16):
        self.raw, self.block, self.held, self.gzip = raw, block, b"", None

    def _more(self) -> bool:
        data = self.raw.read(self.block)
        if self.gzip is None:
            self.gzip = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else False
        while data:
            if self.gzip is False:
                self.held += data
                return True
            if self.gzip.eof:
                self.gzip = zlib.decompressobj(31)
            fresh = self.gzip.decompress(data)
            data = self.gzip.unused_data if self.gzip.eof else b""
            self.held += fresh
            if not data:
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """Up to and without the mark; nothing where the archive ends before it."""
        while (at := self.held.find(mark)) < 0:
            if not self._more():
                return None
        out, self.held = self.held[:at], self.held[at + len(mark) :]
        return out

    def upto(self, n: int) -> bytes:
        while not self.held:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out, self.held = self.held[:n], self.held[n:]
        return out


def _records(raw, chunk_bytes: int) -> Iterator[tuple[dict, Iterator[tuple[bytes, bool]]]]:
    """Header fields of each record, and its payload in chunks with whether it is the last."""
    stream = _Stream(raw)
    while True:
        head = stream.until(b"\r\n\r\n")
        if head is None or not head.strip():
            if head is None:
                return
            continue
        lines = head.strip(b"\r\n").decode().split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        left = int(fields["content-length"])
        if fields.get("content-type", "").startswith("application/http") and left:
            left -= len(stream.until(b"\r\n\r\n")) + 4

        def chunks(left: int = left) -> Iterator[tuple[bytes, bool]]:
            chunk, parts, size = b"", [], 0
            while left:
                part = stream.upto(min(left, chunk_bytes - size))
                parts.append(part)
                size += len(part)
                left -= len(part)
                if size == chunk_bytes and left:
                    yield b"".join(parts), False
                    parts, size = [], 0
            yield b"".join(parts) if parts else chunk, True

        own = chunks()
        yield fields, own
        for _ in own:
            pass


_CHUNKS = (
    "record_id string, page_id bigint, record_type string, refers_to bigint, url string, chunk_no bigint, chunk binary, "
    "bytes_so_far bigint, digest_so_far string, last boolean"
)


def _reader(with_chunks: bool, chunk_bytes: int):
    names = ["record_id", "page_id", "record_type", "refers_to", "url", "chunk_no", "chunk", "bytes_so_far", "digest_so_far", "last"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for path in (p.as_py() for batch in batches for p in batch.column("path")):
            store, root = open_store(path)
            with store.open_input_stream(root, compression=None) as raw:
                for fields, chunks in _records(raw, chunk_bytes):
                    revisit = fields["warc-type"] == "revisit"
                    number = lambda name: int(fields[name]) if fields.get(name) else None
                    own = (fields["warc-record-id"], number("page-id"), fields["warc-type"], number("refers-to-page-id"), unquote(fields["warc-target-uri"]))
                    declared = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    if revisit:
                        rows.append((*own, 0, None, int(fields["payload-length"]), declared, True))
                        continue
                    digest, size = hashlib.sha1(), 0
                    for k, (chunk, last) in enumerate(chunks):
                        digest.update(chunk)
                        size += len(chunk)
                        so_far = base64.b32encode(digest.digest()).decode()
                        if last and declared and so_far != declared:
                            raise ValueError(f"{path}: record {own[0]} is damaged")
                        rows.append((*own, k, chunk if with_chunks else None, size, so_far, last))
                        held += len(chunk)
                        if held >= 4 << 20 or len(rows) >= 10_000:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                            rows, held = [], 0
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return read


def read_chunks(archives: DataFrame, with_chunks: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunk rows of all records of `archives` (path); a revisit is one row with the length and digest of its header."""
    spark = apply_settings(archives.sparkSession)
    count = max(1, archives.count())
    return (
        archives.select("path").repartition(min(count, 100_000), "path").mapInArrow(_reader(with_chunks, chunk_bytes), _CHUNKS)
        if count > 1
        else archives.select("path").mapInArrow(_reader(with_chunks, chunk_bytes), _CHUNKS)
    )


def chunk_table(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunk rows of all records, payloads included, as a table in the shared folder."""
    path = new_folder(archives.sparkSession, "chunks")
    read_chunks(archives, chunk_bytes=chunk_bytes).write.option("compression", "zstd").parquet(path)
    return archives.sparkSession.read.parquet(path)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return chunks.filter("last").select(
        "page_id",
        F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
