"""WARC archives as a Python data source.

Writing (``df.write.format("warc")``): each task writes gzip files of one member per
record.  Each member's gzip header has the ``sl`` extra field with its own size, so a
reader can pass over it without inflating it.  A task's files count only once the job's
manifest, written last, names them; files of lost or repeated tasks are never read.

Reading (``spark.read.format("warc")``): the files are planned into partitions by size.
Predicates on the record type and on header columns are pushed down: a record's header
block is inflated first (the first kilobyte), tested, and the payload is inflated only if
the record is wanted and the requested schema has ``payload``.  Otherwise the reader goes
on to the next member.

Paths are opened with ``pyarrow.fs``: local paths and ``file:``, ``hdfs:``, ``s3:`` or
``gs:`` addresses.

Defined results: a null payload is empty.  A null url leaves the header out and reads back
as null; control characters in it are percent-encoded.  A null id reads back as null.  An
empty table gives an archive without files.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage)

from colforge.session import bounded_broadcast, ensure_checkpoint_dir, materialize, scratch_path

from .common import free_name, prepare

SCHEMA = ("record_id string, record_type string, target_uri string, date string, payload_digest string, "
          "refers_to string, payload_bytes long, payload binary")
#: What the writer takes, in this order.
WRITE_SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload binary"
_MANIFEST = "_manifest.json"
_HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
            "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return pafs.LocalFileSystem(), path


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(record_id: str | None, record_type: str, uri: str | None, refers_to: str | None, payload: bytes, date: str) -> bytes:
    """One WARC/1.1 record.  A revisit has the HTTP header, with the payload's length, and
    no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if record_type == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Date: {date}"]
    if record_id is not None:
        lines.append(f"WARC-Record-ID: <urn:page:{record_id}>")
    if uri is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in uri))
    lines.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if record_type == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}"] + ([f"WARC-Refers-To: <urn:page:{refers_to}>"] if refers_to is not None else [])
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int) -> bytes:
    """A gzip member whose ``sl`` field holds its compressed and plain size."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(record) + deflate.flush()
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<H", 8)
    size = len(head) + 8 + len(body) + 8
    sizes = struct.pack("<II", size & 0xFFFFFFFF, len(record) & 0xFFFFFFFF) if size < 1 << 32 else b"\0" * 8
    return head + sizes + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.date = options["path"], options.get("date", "2000-01-01T00:00:00Z")
        self.level, self.roll = int(options.get("level", 1)), int(options.get("file_bytes", 256 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = open_folder(self.path)
        fs.create_dir(folder, recursive=True)
        files, out = [], None
        try:
            for batch in iterator:
                for rid, kind, uri, refers, payload in zip(*(batch.column(i) for i in range(5))):
                    if out is None:
                        files.append([f"part-{uuid.uuid4().hex}.warc.gz", 0])
                        out = fs.open_output_stream(f"{folder}/{files[-1][0]}", compression=None)
                    member = gzip_member(record_bytes(rid.as_py(), kind.as_py(), uri.as_py(), refers.as_py(), payload.as_py() or b"", self.date), self.level)
                    out.write(member)
                    files[-1][1] += len(member)
                    if files[-1][1] >= self.roll:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        fs, folder = open_folder(self.path)
        fs.create_dir(folder, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        if fs.get_file_info(f"{folder}/{_MANIFEST}").type == pafs.FileType.File:  # mode("append")
            with fs.open_input_stream(f"{folder}/{_MANIFEST}") as f:
                files = json.loads(f.read())["files"] + files
        with fs.open_output_stream(f"{folder}/{_MANIFEST}") as f:
            f.write(json.dumps({"files": files}).encode())

    def abort(self, messages: list) -> None:
        fs, folder = open_folder(self.path)
        for name, _ in (f for m in messages if m is not None for f in m.files):
            if fs.get_file_info(f"{folder}/{name}").type == pafs.FileType.File:
                fs.delete_file(f"{folder}/{name}")


@dataclass
class Files(InputPartition):
    names: list


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path, self.columns = options["path"], schema.names
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.tests: list = []

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            name = getattr(f, "attribute", (None,))[0]
            test = _TESTS.get(type(f))
            if name in _HEADERS and test:
                self.tests.append((name, test, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        fs, folder = open_folder(self.path)
        if fs.get_file_info(f"{folder}/{_MANIFEST}").type == pafs.FileType.File:
            with fs.open_input_stream(f"{folder}/{_MANIFEST}") as f:
                files = json.loads(f.read())["files"]
        else:  # an archive from elsewhere
            found = fs.get_file_info(pafs.FileSelector(folder))
            files = [[i.base_name, i.size] for i in found if i.base_name.endswith((".warc.gz", ".warc"))]
        parts, room = [], 0
        for name, size in sorted(files, key=lambda f: (-f[1], f[0])):  # large ones alone, small ones together
            if not parts or room < size:
                parts.append(Files([]))
                room = self.partition_bytes
            parts[-1].names.append(name)
            room -= size
        return parts or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        fs, folder = open_folder(self.path)
        want_payload = "payload" in self.columns
        for name in partition.names:
            with fs.open_input_file(f"{folder}/{name}") as f:
                for header, block in (gzip_records if name.endswith(".gz") else plain_records)(f):
                    row = {c: _clean(c, header.get(h)) for c, h in _HEADERS.items()}
                    if all(test(row[c], value) for c, test, value in self.tests):
                        row["payload"] = row["payload_bytes"] = None
                        if want_payload or "payload_bytes" in self.columns:
                            http = block.http_header()
                            stated = _fields(http).get("content-length", "") if http else ""
                            own = block.left if row["record_type"] != "revisit" else None  # a revisit has no payload of its own
                            row["payload_bytes"] = int(stated) if stated.isdigit() else own
                            if want_payload and row["record_type"] == "response":
                                row["payload"] = block.payload()
                        yield tuple(row[c] for c in self.columns)


class WarcDataSource(DataSource):
    """``format("warc")``; options: ``path``, and ``partition_bytes`` for reading, ``date``,
    ``level`` and ``file_bytes`` for writing."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


_TESTS = {
    EqualTo: lambda x, v: x is not None and x == v, EqualNullSafe: lambda x, v: x == v, In: lambda x, v: x in v,
    IsNull: lambda x, v: x is None, IsNotNull: lambda x, v: x is not None,
    GreaterThan: lambda x, v: x is not None and x > v, GreaterThanOrEqual: lambda x, v: x is not None and x >= v,
    LessThan: lambda x, v: x is not None and x < v, LessThanOrEqual: lambda x, v: x is not None and x <= v,
    StringStartsWith: lambda x, v: x is not None and x.startswith(v), StringEndsWith: lambda x, v: x is not None and x.endswith(v),
    StringContains: lambda x, v: x is not None and v in x,
}


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        out[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def _clean(column: str, value: str | None) -> str | None:
    if value is None:
        return None
    if column in ("record_id", "refers_to"):
        return value.strip("<>").removeprefix("urn:page:")
    return value.removeprefix("sha1:") if column == "payload_digest" else value


class _Stream:
    """Bytes that come in pieces from ``more`` (which gives b"" at the end), read by need;
    ``jump`` passes over some, where that is possible without reading them."""

    def __init__(self, more, jump=None):
        self.more, self.jump, self.held = more, jump, b""

    def _fill(self, n: int) -> None:
        parts, have = [self.held], len(self.held)
        while have < n:
            got = self.more()
            if not got:
                break
            parts.append(got)
            have += len(got)
        self.held = b"".join(parts)

    def until(self, end: bytes, limit: int | None = None) -> bytes:
        """Up to and with ``end``, however far it is, within ``limit`` bytes; all that is left
        if there is none."""
        looked, want = 0, 4096
        while True:
            self._fill(want if limit is None else min(want, limit))
            at = self.held.find(end, max(0, looked - len(end)), limit)
            if at >= 0:
                return self.take(at + len(end))
            if len(self.held) < want or (limit is not None and want >= limit):
                return self.take(len(self.held) if limit is None else min(limit, len(self.held)))
            looked, want = len(self.held), 2 * want

    def take(self, n: int) -> bytes:
        self._fill(n)
        out, self.held = self.held[:n], self.held[n:]
        return out

    def skip(self, n: int) -> None:
        while n > 0:
            step = min(n, len(self.held))
            self.held, n = self.held[step:], n - step
            if n and self.jump:
                return self.jump(n)
            if n:
                self.held = self.more()
                if not self.held:
                    return

    def skip_breaks(self) -> bool:
        """Past line breaks; False at the end."""
        while True:
            self._fill(1)
            if not self.held:
                return False
            self.held = self.held.lstrip(b"\r\n")
            if self.held:
                return True


def _stream_records(stream: _Stream) -> Iterator[tuple]:
    """(header fields, the stream at the block, the block's length) of record after record.
    What the caller leaves of a block is passed over."""
    while stream.skip_breaks():
        header = _fields(stream.until(b"\r\n\r\n"))
        length = header.get("content-length", "")
        length = int(length) if length.isdigit() else 0
        block = _Block(stream, length)
        yield header, block
        stream.skip(block.left)


class _Block:
    """The block of a record: its HTTP header and payload."""

    def __init__(self, stream: _Stream, length: int):
        self.stream, self.length, self.left = stream, length, length

    def http_header(self) -> bytes:
        """The HTTP header with its empty line; b"" if the block is not an HTTP message."""
        start = self.stream.take(min(5, self.left))
        self.stream.held = start + self.stream.held
        if start != b"HTTP/":
            return b""
        head = self.stream.until(b"\r\n\r\n", self.left)
        self.left -= len(head)
        return head

    def payload(self) -> bytes:
        out = self.stream.take(self.left)
        self.left -= len(out)
        return out


def gzip_records(f) -> Iterator[tuple]:
    """The records of all members.  A member with an ``sl`` field holds one record, and what
    the caller does not read of it is not inflated; a member without may hold many."""
    pos, end = 0, f.size()
    while pos < end:
        f.seek(pos)
        raw = f.read(4096)
        size = _member_size(raw)
        inflate = zlib.decompressobj(zlib.MAX_WBITS | 16)

        def more() -> bytes:
            nonlocal raw
            while not inflate.eof:
                if not inflate.unconsumed_tail and not raw:
                    raw = f.read(1 << 16)
                    if not raw:
                        return b""  # cut off
                got = inflate.decompress(inflate.unconsumed_tail or raw, 4096 if size else 1 << 16)
                if not inflate.unconsumed_tail:
                    raw = b""
                if got:
                    return got
            return b""

        stream = _Stream(more)
        if size:
            for record in _stream_records(stream):
                yield record
                break
            pos += size
            continue
        yield from _stream_records(stream)
        while more():  # what a broken header left
            pass
        if not inflate.eof:
            return
        pos = f.tell() - len(inflate.unused_data)


def _member_size(raw: bytes) -> int:
    if len(raw) > 24 and raw[3] & 4 and raw[12:14] == b"sl":
        return struct.unpack("<I", raw[16:20])[0]
    return 0


def plain_records(f) -> Iterator[tuple]:
    """The records of an archive that is not compressed; what is not wanted is not read."""
    return _stream_records(_Stream(lambda: f.read(1 << 16), lambda n: f.seek(f.tell() + n)))


def with_revisits(pages: DataFrame, id_col: str = "page_id", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Add ``payload`` (binary), ``record_type`` and ``refers_to``: of equal payloads of at
    least ``min_bytes``, that with the smallest id is the response.  Rows without an id are
    revisits if an equal payload has one, and rows that share the smallest id are all
    responses.  Input columns of these names are replaced."""
    pages = pages.drop(*[c for c in ("payload", "record_type", "refers_to") if c not in (id_col, html)])
    digest, smallest = free_name(pages, "_digest"), free_name(pages, "_first")
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    own = pages.withColumn("payload", payload).withColumn(digest, F.when(F.length("payload") >= min_bytes, F.sha1("payload")))
    first = materialize(own.where(F.col(digest).isNotNull()).groupBy(digest).agg(F.min(id_col).alias(smallest), F.count(F.lit(1)).alias("n"))
                        .where("n > 1").select(digest, smallest), "warc-copies")
    joined = own.join(bounded_broadcast(first), digest, "left")
    revisit = F.col(smallest).isNotNull() & ~F.col(id_col).eqNullSafe(F.col(smallest))
    return (joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col(smallest))).drop(digest, smallest))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, **options) -> None:
    spark = prepare(pages.sparkSession)
    spark.dataSource.register(WarcDataSource)
    rows = with_revisits(pages, id_col, html, min_bytes).select(
        F.col(id_col).cast("string").alias("record_id"), "record_type", F.col(url).cast("string").alias("target_uri"),
        F.col("refers_to").cast("string").alias("refers_to"), "payload")
    rows.write.format("warc").options(**options).mode("append").save(path)


def read_archive(spark: SparkSession, path: str, columns: str = SCHEMA, **options) -> DataFrame:
    """The records of an archive; name fewer ``columns`` (with types) to skip payloads."""
    prepare(spark).dataSource.register(WarcDataSource)
    return spark.read.format("warc").schema(columns).options(**options).load(path)


def round_trip(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Write ``pages`` to a fresh archive in the shared folder and read it back: of responses
    the payload, which is measured; of revisits the headers alone, their blocks passed over."""
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, "warc")
    write_archive(pages, path, id_col)
    kind = dict(pages.dtypes)[id_col]
    heads = "record_id string, record_type string, payload_digest string, refers_to string"
    responses = read_archive(spark, path, f"{heads}, payload binary").where("record_type = 'response'")
    revisits = read_archive(spark, path, f"{heads}, payload_bytes long").where("record_type = 'revisit'")
    read = responses.withColumn("payload", F.length("payload").cast("long")).withColumnRenamed("payload", "payload_bytes").unionByName(revisits)
    return read.select(F.col("record_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
