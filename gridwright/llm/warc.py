"""WARC archives: a Spark data source and the page archive built on it.

``df.write.format("warc")`` writes one ``.warc.gz`` file per task, one gzip
member per record. ``spark.read.format("warc")`` reads archives back with a
sequential reader: one task per file, incremental zlib decompression in
64 KB pieces, records framed by Content-Length, block and payload digests
verified. A task holds one record and one batch of bounded bytes at a time, so
memory is bounded by the largest record.

Files go to ``<name>.part-<task>-<attempt>`` first and are renamed by the
commit, so a lost executor or a repeated task leaves no half archive behind.
"""

from __future__ import annotations

import base64
import hashlib
import io
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from gridwright.llm.common import small_or_shuffled, written
from gridwright.session import scratch_path

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
# Every record carries the same date: the tables hold no capture time, and a
# repeated write gives the same bytes.
RECORD_DATE = "1970-01-01T00:00:00Z"

# Rows handed to the writer, and rows the reader returns.
WRITE_SCHEMA = "page_id bigint, url string, payload binary, sha1 string, record_type string, refers_to bigint"
READ_SCHEMA = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, archive string, archive_offset bigint, payload binary"
)
# Schemes of Hadoop's connectors and Arrow's for the same stores.
SCHEMES = {"s3a": "s3", "s3n": "s3"}
# READ_SCHEMA as Arrow types, and the bounds of one batch the reader returns.
READ_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("archive_offset", pa.int64()),
    ("payload", pa.binary()),
])
READ_ROWS = 1000
READ_BYTES = 4 << 20
PIECE = 1 << 16
GZIP_LEVEL = 4


class WarcError(ValueError):
    """An archive that is cut off, wrongly framed or fails a digest."""


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI as Spark writes it (plain paths are local)."""
    uri = urlparse(path)
    if uri.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), unquote(uri.path) if uri.scheme else path
    return pyarrow.fs.FileSystem.from_uri(arrow_uri(path))


def arrow_uri(path: str) -> str:
    """A URI with Spark's name of an object store as the one Arrow knows."""
    scheme, sep, rest = path.partition("://")
    return SCHEMES.get(scheme.lower(), scheme) + sep + rest


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    head += b"Content-Length: %d\r\n\r\n" % len(block)
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def _clean(value: str) -> str:
    """A header value on one line (percent-encodes control characters)."""
    return "".join(c if c >= " " and c != "\x7f" else "%%%02X" % ord(c) for c in value)


def page_record(page_id, url, payload: bytes, digest: str, record_type: str, refers_to) -> bytes:
    """A response record with the payload, or a revisit record that names the
    response holding it and keeps only the HTTP header."""
    block = HTTP_HEAD % len(payload) + (payload if record_type == "response" else b"")
    headers = [
        ("WARC-Type", record_type),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{url}/{digest}')}>"),
        ("WARC-Date", RECORD_DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _clean(url)))
        if url != _clean(url).strip():  # control characters or blanks at the ends: kept beside it as well
            headers.append(("X-Page-Url", quote(url, safe="")))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if record_type == "revisit":
        headers += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    return record(headers, block)


def read_records(stream) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, headers, block)`` of each record of a gzip stream, in order.

    Reads ``PIECE`` bytes at a time; each member is inflated on its own until
    its end, then the next starts at the bytes left over.
    """
    offset, rest = 0, b""
    while True:
        if not rest:
            rest = stream.read(PIECE)
            if not rest:
                return
        inflate, out, start = zlib.decompressobj(31), io.BytesIO(), offset
        while not inflate.eof:
            if not rest:
                rest = stream.read(PIECE)
                if not rest:
                    raise WarcError(f"the member at byte {start} is cut off")
            try:
                out.write(inflate.decompress(rest))
            except zlib.error as exc:
                raise WarcError(f"the member at byte {start}: {exc}") from exc
            offset += len(rest) - len(inflate.unused_data)
            rest = inflate.unused_data
        yield (start, *parse_record(out.getvalue(), start))


def parse_record(data: bytes, start: int) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and the block of one inflated record;
    the framing and the block digest are checked."""
    head, sep, body = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or not lines[0].startswith(b"WARC/1."):
        raise WarcError(f"no record header at byte {start}")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"bad header line at byte {start}")
        headers[name.decode().strip().lower()] = value.decode("utf-8").strip()
    try:
        length = int(headers["content-length"])
    except (KeyError, ValueError) as exc:
        raise WarcError(f"no content length at byte {start}") from exc
    if body[length:] != b"\r\n\r\n":
        raise WarcError(f"content length {length} does not frame the record at byte {start}")
    block = body[:length]
    said = headers.get("warc-block-digest")
    if said and said != f"sha1:{base32_sha1(block)}":
        raise WarcError(f"block digest of the record at byte {start}")
    return headers, block


def page_row(offset: int, headers: dict[str, str], block: bytes, archive: str) -> dict:
    """The row of a page record; a response's payload is checked against its digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(
        int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")
    )
    digest, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
    if kind == "response" and (len(payload) != length or base32_sha1(payload) != digest):
        raise WarcError(f"payload of the record at byte {offset} of {archive}")
    number = lambda k: int(headers[k]) if headers.get(k, "None") != "None" else None
    return {
        "page_id": number("x-page-id"),
        "url": unquote(headers["x-page-url"]) if "x-page-url" in headers else headers.get("warc-target-uri"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("x-refers-to-page-id"),
        "archive": archive,
        "archive_offset": offset,
        "payload": payload if kind == "response" else None,
    }


@dataclass
class Written(WriterCommitMessage):
    temporary: str
    final: str


@dataclass
class Archive(InputPartition):
    path: str


class WarcWriter(DataSourceArrowWriter):
    """One archive per task; rows in ``WRITE_SCHEMA``."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = filesystem(self.folder)
        fs.create_dir(folder, recursive=True)
        task = TaskContext.get()
        final = f"{folder}/pages-{task.partitionId():05d}.warc.gz"
        temporary = f"{folder}/_{os.path.basename(final)}.part-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        with fs.open_output_stream(temporary, compression=None) as out:
            out.write(record([("WARC-Type", "warcinfo"), ("WARC-Date", RECORD_DATE),
                              ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, final)}>"),
                              ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
            for batch in batches:
                columns = [batch.column(i) for i in range(6)]
                for i in range(batch.num_rows):
                    page_id, url, payload, sha1, kind, refers_to = (c[i].as_py() for c in columns)
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    out.write(page_record(page_id, url, payload, digest, kind, refers_to))
        return Written(temporary, final)

    def commit(self, messages: list[Written | None]) -> None:
        fs, _ = filesystem(self.folder)
        for m in messages:
            if m is not None:
                fs.move(m.temporary, m.final)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = filesystem(self.folder)
        for m in messages:
            if m is not None and fs.get_file_info(m.temporary).type != pyarrow.fs.FileType.NotFound:
                fs.delete_file(m.temporary)


class WarcReader(DataSourceReader):
    """One task per archive, records in file order."""

    def __init__(self, folder: str, payloads: bool):
        self.folder, self.payloads = folder, payloads

    def partitions(self) -> list[Archive]:
        fs, folder = filesystem(self.folder)
        found = fs.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
        return [Archive(f.path) for f in sorted(found, key=lambda f: f.path)
                if f.base_name.endswith(".warc.gz") and not f.base_name.startswith(("_", "."))]

    def read(self, archive: Archive) -> Iterator[pa.RecordBatch]:
        """Arrow batches, closed after ``READ_ROWS`` rows or ``READ_BYTES`` bytes of payload."""
        fs, _ = filesystem(self.folder)
        name, rows, held = os.path.basename(archive.path), [], 0
        with fs.open_input_stream(archive.path, compression=None) as stream:
            for offset, headers, block in read_records(stream):
                if headers.get("warc-type") in ("response", "revisit"):
                    row = page_row(offset, headers, block, name)
                    if not self.payloads:
                        row["payload"] = None
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if len(rows) >= READ_ROWS or held >= READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, READ_ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, READ_ARROW)


class WarcDataSource(DataSource):
    """``format("warc")``; option ``payloads`` = false leaves the payload column null."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payloads", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def archive_rows(pages: DataFrame) -> DataFrame:
    """Rows for the writer: payload, digest, and which record is a revisit.

    Of pages with equal payloads the smallest ``page_id`` is the response and
    the others revisit it. Repeated rows with that id are responses too; a
    null id revisits when its payload also occurs under an id, and is a
    response when it does not. A null html is an empty payload.

    Only (digest, length, smallest id) of payloads that occur more than once
    is shared, from a partially aggregated count, so a payload held by a third
    of all pages costs one row per task. It is broadcast when its measured
    size allows; otherwise both sides of the join are plain exchanges and AQE
    splits the hot digest.
    """
    payload = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"), F.sha1(payload).alias("sha1"),
    )
    repeated = (
        rows.groupBy("sha1").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"))
        .where("n > 1").select("sha1", "first_id", F.lit(True).alias("repeated"))
    )
    joined = rows.join(small_or_shuffled(repeated, "warc-repeated"), "sha1", "left")
    response = F.col("repeated").isNull() | F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", "payload", "sha1",
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.when(~response, F.col("first_id")).alias("refers_to"),
    )


def write_archives(spark: SparkSession, pages: DataFrame, folder: str) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) under ``folder``."""
    spark.dataSource.register(WarcDataSource)
    archive_rows(pages).write.format("warc").mode("append").option("path", folder).save()


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The page records of every archive under ``folder`` (``READ_SCHEMA``)."""
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("payloads", str(payloads)).load(folder)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Give each revisit the payload of the response it refers to."""
    first = records.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest"), F.col("payload").alias("held")
    ).dropDuplicates(["refers_to", "payload_digest"])
    return records.join(first, ["refers_to", "payload_digest"], "left").withColumn(
        "payload", F.coalesce("payload", "held")).drop("held")


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back.

    One row per page: page_id, payload_bytes, payload_digest, record_type,
    refers_to, url, archive, archive_offset. An empty table gives no rows;
    columns beyond page_id, url and html are not archived.
    """
    folder = scratch_path(spark, "warc")
    write_archives(spark, pages, folder)
    return written(read_archives(spark, folder, payloads=False).drop("payload"), "warc-index")
