"""WARC 1.1 archives as a Spark data source, ``format("quire_warc")``.

Writing gives one gzip member per record; each member carries its compressed
length in an ``sl`` extra field, so a reader that does not want a record seeks
past it without inflating its payload.  Members without the field, and plain
archives, are read as well.

Reading plans partitions by files (small ones share a partition), parses the
headers of a record first, applies the pushed-down predicates to them, and only
then decodes the block.  ``option("payload", "false")`` never decodes payloads,
``option("verify", "true")`` recomputes the digest of those that it does decode.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)

from .common import arrow_batches, new_path, stored, table

NAME = "quire_warc"
#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "2024-01-01T00:00:00Z"
FILE_BYTES, PARTITION_BYTES, HEAD_BYTES, BATCH_BYTES = 256 << 20, 128 << 20, 4096, 8 << 20

READ_SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, refers_to string, "
    "payload_digest string, content_length bigint, http_length bigint, headers map<string,string>, payload binary"
)
_READ_ARROW = pa.schema(
    [(n, pa.string()) for n in ("record_id", "record_type", "target_uri", "warc_date", "refers_to", "payload_digest")]
    + [("content_length", pa.int64()), ("http_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
)
_HEADER_OF = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "warc_date": "warc-date",
    "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_length": "content-length",
}
WRITE_COLUMNS = ("record_id", "record_type", "target_uri", "refers_to", "payload")


def digest32(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_value(text: str) -> str:
    """One line: control characters would end or break a header."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(record_id: str, record_type: str, uri: str | None, refers_to: str | None, payload: bytes) -> bytes:
    """One record: an HTTP response, or the revisit of one, which keeps the
    HTTP headers (and so the payload's length and digest) but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = record_type == "revisit"
    block = http if revisit else http + payload
    lines = [VERSION, f"WARC-Type: {record_type}", f"WARC-Record-ID: <{header_value(record_id)}>", f"WARC-Date: {EPOCH}"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {header_value(uri)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{header_value(refers_to or '')}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest32(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    """A gzip member whose ``sl`` field has its own and the inflated length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    total = 12 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class WarcWriter(DataSourceArrowWriter):
    """Files go to a staging folder and are moved when the job commits, so
    attempts that fail or run twice leave nothing behind."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(f"{root}/_staging", recursive=True)
        names, out, room = [], None, 0
        try:
            for batch in iterator:
                column = {n: batch.column(n) for n in WRITE_COLUMNS}
                for i in range(batch.num_rows):
                    if out is None or room <= 0:
                        if out:
                            out.close()
                        names.append(f"{uuid.uuid4().hex}.warc.gz")
                        out, room = fs.open_output_stream(f"{root}/_staging/{names[-1]}", compression=None, buffer_size=1 << 20), FILE_BYTES
                    row = {n: column[n][i].as_py() for n in WRITE_COLUMNS}
                    data = gzip_member(record_bytes(row["record_id"], row["record_type"], row["target_uri"], row["refers_to"], row["payload"] or b""))
                    out.write(data)
                    room -= len(data)
        finally:
            if out:
                out.close()
        return Written(names)

    def commit(self, messages) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        for m in messages:
            for name in m.names if m else []:
                fs.move(f"{root}/_staging/{name}", f"{root}/{name}")
        self._drop(fs, root)

    def abort(self, messages) -> None:
        self._drop(*pafs.FileSystem.from_uri(self.path))

    @staticmethod
    def _drop(fs, root) -> None:
        if fs.get_file_info(f"{root}/_staging").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/_staging")


class Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class FileGroup(InputPartition):
    def __init__(self, files: tuple[str, ...]):
        self.files = files


def _passes(f: Filter, row: dict) -> bool:
    v = row.get(f.attribute[0])
    if isinstance(f, IsNotNull):
        return v is not None
    if isinstance(f, EqualNullSafe):
        return v == f.value
    if v is None:
        return False
    if isinstance(f, EqualTo):
        return v == f.value
    if isinstance(f, In):
        return v in f.value
    if isinstance(f, StringStartsWith):
        return v.startswith(f.value)
    return {GreaterThan: v > f.value, GreaterThanOrEqual: v >= f.value, LessThan: v < f.value, LessThanOrEqual: v <= f.value}[type(f)]


def parse_head(data: bytes) -> tuple[dict[str, str], int] | None:
    """Headers (lower-case names; continuation lines joined) and where the
    block begins; None if the head is not complete."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    text = re.sub(r"\r\n[ \t]+", " ", data[:end].decode("utf-8", "replace"))
    lines = text.split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise Damaged(f"not a WARC record: {lines[0][:40]!r}")
    pairs = (line.partition(":") for line in lines[1:])
    return {k.strip().lower(): v.strip() for k, colon, v in pairs if colon}, end + 4


class Damaged(ValueError):
    """An archive holds something that is no whole record."""


class Member:
    """One gzip member, inflated no further than asked: a record, or a run of
    them if the member doesn't tell its own length. ``data`` begins where the
    current record does."""

    def __init__(self, stream, start: int):
        self.stream, self.inflate, self.length = stream, zlib.decompressobj(31), None
        stream.seek(start)
        first = stream.read(HEAD_BYTES)
        if first[3:4] and first[3] & 4:
            size = struct.unpack_from("<H", first, 10)[0]
            at, end = 12, 12 + size
            while at + 4 <= end:
                name, n = first[at : at + 2], struct.unpack_from("<H", first, at + 2)[0]
                if name == b"sl" and n == 8:
                    self.length = struct.unpack_from("<I", first, at + 4)[0]
                at += 4 + n
        self.start, self.read, self.over = start, len(first), False
        self.data = self.inflate.decompress(first)

    def grow(self) -> bytes:
        """More of the member, or nothing at its end."""
        while not self.inflate.eof:
            more = self.stream.read(1 << 18)
            if not more:
                raise Damaged("its gzip member is cut off")
            self.read += len(more)
            if out := self.inflate.decompress(more):
                return out
        return b""

    def head(self):
        while not self.over:
            self.data = self.data.lstrip(b"\r\n")
            if found := parse_head(self.data):
                return found
            more = self.grow()
            if not more:
                if self.data:
                    raise Damaged("its header is cut off")
                return None
            self.data += more
        return None

    def block(self, begin: int, length: int) -> bytes:
        parts, have = [self.data], len(self.data)
        while have < begin + length and (more := self.grow()):
            parts.append(more)
            have += len(more)
        self.data = b"".join(parts)
        if have < begin + length:
            raise Damaged("its block is cut off")
        return self.data[begin : begin + length]

    def skip(self, size: int) -> None:
        """On to the record ``size`` bytes further. With a known length the
        member holds no other, and nothing more is inflated."""
        if self.length:
            self.over, self.data = True, b""
            return
        while len(self.data) < size:
            size -= len(self.data)
            self.data = self.grow()
            if not self.data:
                raise Damaged("its block is cut off")
        self.data = self.data[size:]

    def end(self) -> int:
        """Where the next member begins."""
        return self.start + (self.length or self.read - len(self.inflate.unused_data))


class Plain:
    """One record of an archive that is not compressed."""

    def __init__(self, stream, start: int):
        self.stream, self.at, self.over = stream, start, False
        stream.seek(start)
        self.data = stream.read(HEAD_BYTES)

    def head(self):
        while not self.over:
            blank = len(self.data) - len(self.data.lstrip(b"\r\n"))
            self.data, self.at = self.data[blank:], self.at + blank
            if found := parse_head(self.data):
                return found
            more = self.stream.read(HEAD_BYTES)
            if not more:
                if self.data:
                    raise Damaged("its header is cut off")
                return None
            self.data += more
        return None

    def block(self, begin: int, length: int) -> bytes:
        if len(self.data) < begin + length:
            self.data += self.stream.read(begin + length - len(self.data))
        if len(self.data) < begin + length:
            raise Damaged("its block is cut off")
        return self.data[begin : begin + length]

    def skip(self, size: int) -> None:
        if size > len(self.data):  # the payload was not read; its last byte tells whether it is there
            self.stream.seek(self.at + size - 1)
            if not self.stream.read(1):
                raise Damaged("its block is cut off")
        self.over, self.at = True, self.at + size

    def end(self) -> int:
        return self.at


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path")
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.verify = str(options.get("verify", "false")).lower() == "true"
        self.skip_damaged = str(options.get("damaged", "fail")).lower() == "skip"
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.filters: list[Filter] = []

    def pushFilters(self, filters):
        kinds = (IsNotNull, EqualTo, EqualNullSafe, In, StringStartsWith, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
        for f in filters:
            if isinstance(f, kinds) and len(f.attribute) == 1 and f.attribute[0] in _HEADER_OF:
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        fs, root = pafs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=False, allow_not_found=True)) if fs.get_file_info(root).type != pafs.FileType.File else [fs.get_file_info(root)]
        files = sorted((f.size, f.path) for f in found if f.type == pafs.FileType.File and re.search(r"\.warc(\.gz)?$", f.path))
        groups, room = [], 0
        for size, path in files:
            if not groups or room < size:
                groups.append([])
                room = self.partition_bytes
            groups[-1].append(path)
            room -= size
        return [FileGroup(tuple(g)) for g in groups] or [FileGroup(())]

    def read(self, partition: FileGroup):
        fs, _ = pafs.FileSystem.from_uri(self.path)
        rows, held = [], 0
        for path in partition.files:
            kind = Member if path.endswith(".gz") else Plain
            with fs.open_input_file(path) as raw:
                size = raw.size()
                stream = io.BufferedReader(_Raw(raw), 1 << 20)
                at = 0
                while at < size:
                    record = kind(stream, at)
                    try:
                        while (head := record.head()) is not None:
                            row = self.row(record, *head)
                            if row:
                                rows.append(row)
                                held += len(row["payload"] or b"") + 1000
                                if held > BATCH_BYTES:
                                    yield pa.RecordBatch.from_pylist(rows, schema=_READ_ARROW)
                                    rows, held = [], 0
                            record.skip(head[1] + int(head[0].get("content-length", 0)))
                        if record.end() > size:
                            raise Damaged("its member is cut off")
                    except (Damaged, zlib.error) as error:
                        if not self.skip_damaged:
                            raise Damaged(f"{path}, record at byte {at}: {error}") from error
                        break  # what follows can't be told apart
                    at = record.end()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_READ_ARROW)

    def row(self, record, headers: dict[str, str], begin: int) -> dict | None:
        row = {name: headers.get(h) for name, h in _HEADER_OF.items()}
        row["content_length"] = length = int(headers.get("content-length", 0))
        for name in ("record_id", "refers_to"):
            row[name] = row[name] and row[name].strip("<>")
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
        if not all(_passes(f, row) for f in self.filters):
            return None
        row |= {"headers": list(headers.items()), "payload": None, "http_length": None}
        if headers.get("content-type", "").startswith("application/http"):
            want = length if self.payload and row["record_type"] != "revisit" else min(length, HEAD_BYTES)
            block = record.block(begin, want)
            while b"\r\n\r\n" not in block and want < length:  # a long HTTP header
                want = min(length, 4 * want)
                block = record.block(begin, want)
            http, gap, body = block.partition(b"\r\n\r\n")
            if m := re.search(rb"(?im)^content-length:\s*(\d+)", http):
                row["http_length"] = int(m[1])
            if self.payload and gap and row["record_type"] != "revisit":
                row["payload"] = body
        elif self.payload:
            row["payload"] = record.block(begin, length)
        if self.verify and row["payload"] is not None and row["payload_digest"] is not None and row["payload_digest"] != digest32(row["payload"]):
            raise ValueError(f"payload digest of {row['record_id']} does not match")
        return row


class _Raw(io.RawIOBase):
    """pyarrow's file as a raw stream."""

    def __init__(self, f):
        self.f = f

    def readable(self):
        return True

    def seekable(self):
        return True

    def readinto(self, b):
        data = self.f.read(len(b))
        b[: len(data)] = data
        return len(data)

    def seek(self, at, whence=0):
        return self.f.seek(at, whence)

    def tell(self):
        return self.f.tell()


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options.items()))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark, path: str, *, payload: bool = True, verify: bool = False, damaged: str = "fail") -> DataFrame:
    """All records of the archives at ``path``. A record that is cut off or no
    WARC record fails the read; with ``damaged="skip"`` the rest of its file is
    left out instead. An empty folder gives no rows; repeated records all stay."""
    register(spark)
    return spark.read.format(NAME).option("payload", str(payload).lower()).option("verify", str(verify).lower()).option("damaged", damaged).load(path)


def page_records(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """A record per page: of equal payloads of at least ``min_bytes`` bytes, the
    page with the smallest id is the response and the others revisit it.

    Null html is an empty payload, a null url gives no target. Rows that repeat
    the smallest id are all responses. Only payloads that occur twice or more
    enter the join, as digest and smallest id.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"))
    key = F.unhex(F.sha1(F.col("html").cast("binary")))
    small = rows.where(F.octet_length("html") >= min_bytes).select("page_id", key.alias("digest"))
    first = small.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    first = stored(first, "payloads")
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= min_bytes, key))
    rows = rows.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.col(c).cast("string"))
    return rows.select(
        F.coalesce(urn("page_id"), F.lit("urn:page:")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").cast("string").alias("target_uri"),
        F.when(revisit, urn("first")).alias("refers_to"),
        F.col("html").cast("binary").alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, *, min_bytes: int = 0) -> None:
    """Write the pages as archives below ``path``."""
    register(pages.sparkSession)
    arrow_batches(pages.sparkSession)
    page_records(pages, min_bytes=min_bytes).write.format(NAME).mode("append").save(path)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written to archives in the shared folder and read back."""
    path = new_path(spark, "warc")
    write_pages(table(spark, sf_dir, "pages"), path)
    back = read_warc(spark, path, verify=True)
    page = lambda c: F.regexp_extract(F.col(c), r"^urn:page:(-?\d+)$", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("bigint"))
    return back.select(
        number("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("bigint"), F.col("http_length")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )


#: Base32 in SQL: five hexadecimal digits are four characters.
_GROUPS = " || ".join(
    f"list_aggregate(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {5 * g + 1}, 5))::INTEGER >> s) & 31), 1)), 'string_agg', '')"
    for g in range(8)
)
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, strlen(html) AS payload_bytes, {_GROUPS} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
