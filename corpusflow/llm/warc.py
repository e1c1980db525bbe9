"""WARC archives as a Spark data source.

Writing: each task writes ``.warc.gz`` files with one compressed member per record, and
starts a new file at a size limit; the files of a write count once its manifest is there.
A member's extra field holds its compressed and plain sizes.

Reading: the driver packs the files of all manifests into partitions by size; in a folder
without a manifest, all its ``.warc.gz`` files, and none at all are an error. Equality
tests on the record type and on other header columns are pushed down. A record's headers
are inflated first; if a pushed test fails, or payloads are not asked for
(``option("payload", "false")``), the rest of the member is skipped by its size, or, in
foreign files without that field, inflated and forgotten.

Columns: ``record_id, record_type, target_uri, date, refers_to, payload_digest,
payload_length, payload``. A null column gives no header. Line breaks in header values
become spaces. A response's block is an HTTP response; a revisit holds its HTTP headers
only, where the length of the payload stands. The whole block of a record that is not
HTTP is its payload. An archive of no records reads as no rows. Paths can be any that ``pyarrow.fs`` opens.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    InputPartition,
    WriterCommitMessage,
)

from corpusflow.llm import common

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, "
    "payload_digest string, payload_length long, payload binary"
)
#: Header of each column that has one.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 32 << 20
PARTITION_BYTES = 32 << 20
BATCH_BYTES = 8 << 20
#: Bytes read at a time, and the most that headers may take.
CHUNK = 1 << 16


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def record_bytes(row: dict) -> bytes:
    """One record, without compression."""
    revisit = row["record_type"] == "revisit"
    payload = b"" if revisit else row["payload"] or b""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_length']}\r\n\r\n"
    ).encode()
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        if row[column] is not None:
            value = re.sub(r"[\r\n]+", " ", str(row[column]))
            lines.append(f"{header}: {value}")
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(http) + len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def member(plain: bytes) -> bytes:
    """A gzip member whose extra field ``sl`` holds its whole and its plain size."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(plain) + deflate.flush()
    extra = b"sl" + struct.pack("<HII", 8, 10 + 2 + 12 + len(body) + 8, len(plain) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


def batch_rows(batch: pa.RecordBatch, at_once: int = 64) -> Iterator[dict]:
    """The rows of a batch, a few of them as Python values at a time."""
    for k in range(0, batch.num_rows, at_once):
        yield from batch.slice(k, at_once).to_pylist()


@dataclass
class WrittenFiles(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.write_id = path, uuid.uuid4().hex
        system, folder = file_system(path)
        if overwrite and system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir_contents(folder)
        system.create_dir(folder, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, folder = file_system(self.path)
        files: list[tuple[str, int]] = []
        out, size = None, 0
        for batch in iterator:
            for row in batch_rows(batch):
                if out is None:
                    name = f"{self.write_id[:8]}-{uuid.uuid4().hex}.warc.gz"
                    out, size = system.open_output_stream(f"{folder}/{name}", compression=None), 0
                size += out.write(member(record_bytes(row)))
                if size >= FILE_BYTES:
                    out.close()
                    files.append((name, size))
                    out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return WrittenFiles(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, folder = file_system(self.path)
        files = sorted(f for m in messages if m is not None for f in m.files)
        with system.open_output_stream(f"{folder}/manifest-{self.write_id}.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files without a manifest are never read."""
        system, folder = file_system(self.path)
        for message in messages:
            for name, _ in message.files if message is not None else ():
                system.delete_file(f"{folder}/{name}")


@dataclass
class FileSet(InputPartition):
    names: list[str]


class _Ahead:
    """A stream with what was read last, so that small members share a read."""

    def __init__(self, stream):
        self.stream, self.start, self.held = stream, 0, b""

    def at(self, offset: int, least: int = 1) -> bytes:
        """Bytes from ``offset`` on, ``least`` of them unless the stream ends before."""
        inside = offset - self.start
        rest = self.held[inside:] if 0 <= inside < len(self.held) else b""
        if len(rest) < least:
            self.stream.seek(offset + len(rest))
            self.start, self.held = offset, rest + self.stream.read(CHUNK)
            rest = self.held
        return rest


class _Member:
    """A gzip member at ``offset``: inflates on demand, and knows where the next one is."""

    def __init__(self, ahead: _Ahead, offset: int):
        self.ahead, self.offset = ahead, offset
        self.pending = ahead.at(offset, 24)
        self.given, self.start = len(self.pending), self.pending[:24]
        self.inflate = zlib.decompressobj(31)

    def more(self) -> bytes:
        """The next plain bytes; none at the member's end."""
        while not self.inflate.eof:
            if not self.pending:
                self.pending = self.ahead.at(self.offset + self.given)
                self.given += len(self.pending)
                if not self.pending:
                    raise EOFError("the archive ends inside a record")
            plain = self.inflate.decompress(self.pending, CHUNK)
            self.pending = self.inflate.unconsumed_tail
            if plain:
                return plain
        return b""

    def until(self, mark: bytes, plain: bytes = b"") -> tuple[bytes, bytes]:
        """What comes before ``mark``, however long, and what has been inflated behind it."""
        held, seen = bytearray(plain), 0
        while (at := held.find(mark, seen)) < 0:
            seen = max(0, len(held) - len(mark) + 1)
            if not (piece := self.more()):
                return bytes(held), b""
            held += piece
        return bytes(held[:at]), bytes(held[at + len(mark) :])

    def end(self) -> int:
        """Where the next member starts: by this one's stated size, or by inflating the rest."""
        if len(self.start) == 24 and self.start[3] & 4 and self.start[12:14] == b"sl":
            return self.offset + struct.unpack("<I", self.start[16:20])[0]
        while self.more():
            pass
        return self.offset + self.given - len(self.inflate.unused_data)


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def read_records(stream, wanted: dict[str, str], payload: bool) -> Iterator[tuple]:
    """The rows of one file whose columns equal ``wanted``."""
    offset, length, ahead = 0, stream.size(), _Ahead(stream)
    while offset < length:
        one = _Member(ahead, offset)
        head, block = one.until(b"\r\n\r\n")
        headers = parse_headers(head)
        row = {column: headers.get(name.lower()) for column, name in HEADERS.items()}
        if all(row.get(column) == value for column, value in wanted.items()):
            whole = int(headers["content-length"])
            if headers.get("content-type", "application/http").startswith("application/http"):
                http, body = one.until(b"\r\n\r\n", block)
                inside = max(0, whole - len(http) - 4)
                size = int(parse_headers(http).get("content-length", inside))
            else:
                body, size, inside = block, whole, whole
            if payload and row["record_type"] != "revisit":
                parts = [body]
                while piece := one.more():  # to the end, so that the check sum is tested
                    parts.append(piece)
                yield (*row.values(), size, b"".join(parts)[:inside])
            else:
                yield (*row.values(), size, None)
        offset = one.end()


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload = path, payload
        self.wanted: dict[str, str] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            column = one.attribute[0] if isinstance(one, EqualTo) and len(one.attribute) == 1 else None
            if column in HEADERS and self.wanted.get(column, one.value) == one.value:
                self.wanted[column] = one.value
            else:
                yield one

    def partitions(self) -> list[InputPartition]:
        """Files packed by size: a partition has about PARTITION_BYTES, or one larger file."""
        system, folder = file_system(self.path)
        files: list[tuple[str, int]] = []
        listed = system.get_file_info(fs.FileSelector(folder))
        manifests = [f for f in listed if f.base_name.startswith("manifest-")]
        for info in manifests:
            with system.open_input_stream(info.path) as manifest:
                files += [tuple(f) for f in json.loads(manifest.read())]
        if not manifests:
            files = [(f.base_name, f.size) for f in listed if f.base_name.endswith(".warc.gz")]
            if not files:
                raise FileNotFoundError(f"no manifest and no .warc.gz file in {self.path}")
        packed, size = [], PARTITION_BYTES
        for name, length in sorted(files):
            if size + length > PARTITION_BYTES:
                packed.append(FileSet([]))
                size = 0
            packed[-1].names.append(name)
            size += length
        return packed or [FileSet([])]

    def read(self, partition: FileSet) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(self.path)
        kinds = [pa.string()] * 6 + [pa.int64(), pa.binary()]
        names = [*HEADERS, "payload_length", "payload"]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else ([] for _ in kinds)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names=names
            )

        rows, held = [], 0
        for name in partition.names:
            with system.open_input_file(f"{folder}/{name}") as stream:
                for row in read_records(stream, self.wanted, self.payload):
                    rows.append(row)
                    held += 500 + len(row[-1] or b"")
                    if held > BATCH_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
        yield batch(rows)


class WarcDataSource(DataSource):
    """``format("warc")``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true") == "true")

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Makes ``format("warc")`` known to the session, with push-down of filters."""
    common.workers_find_package(spark)
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
