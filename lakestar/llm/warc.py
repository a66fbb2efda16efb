"""Operator 10: WARC files as a Python data source.

Writing: each task rolls files of about ``FILE_BYTES`` in the target folder and
returns their names; the commit writes a manifest, and only files in a manifest
are read, so retried or speculative tasks leave nothing visible. A record is a
gzip member of its own whose header carries the member's length (the
skip-lengths field ``sl`` of the WARC standard's annex on compression).

Reading: files are planned into partitions of about ``PARTITION_BYTES``.
Equality, membership and prefix predicates on header columns are pushed down.
The reader parses a record's headers first, decoding no more than it needs for
them; a record that a predicate refuses, or whose payload no column asks for,
is skipped by its length without decoding the payload. Files without
skip-lengths and uncompressed files are read too.

Paths are opened through ``pyarrow.fs`` in the tasks, so local, HDFS and
object-store URIs work alike.

Defined results: a null payload is empty; null headers are left out and read as
null; line breaks and other control characters in header values are
percent-encoded; equal rows give a record each; writing no rows leaves an empty
manifest, which reads as an empty table. The input may hold any other columns:
only those of ``WRITE_SCHEMA`` are written.
"""

from __future__ import annotations

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
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from lakestar.llm.common import bounded_batches, checkpointed
from lakestar.session import work_dir

WRITE_SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, date string, payload_bytes long, payload_digest string, payload binary"
READ_SCHEMA = WRITE_SCHEMA + ", file string, offset long"
#: Columns that a record's headers give.
HEADER_COLUMNS = ("record_id", "record_type", "target_uri", "refers_to", "date", "payload_bytes", "payload_digest")

FILE_BYTES = 128 << 20
PARTITION_BYTES = 128 << 20
BATCH_BYTES = 4 << 20
LEVEL = 4

# fixed values
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_warc-manifest-"
_ID = "urn:record:"
_GZIP = struct.Struct("<BBBBIBBHBBHII")  # header with one extra field of two lengths
_FLAG_EXTRA = 4


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI; a bare path is local."""
    return pafs.FileSystem.from_uri(uri) if ":" in uri.split("/", 1)[0] else (pafs.LocalFileSystem(), uri)


# -- records


def _value(text: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(row: dict) -> bytes:
    """A response with its payload, or a revisit with headers alone."""
    payload = row["payload"] or b""
    kind = row["record_type"]
    size = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    headers = [("WARC-Type", kind), ("WARC-Date", row["date"] or "1970-01-01T00:00:00Z")]
    if row["record_id"] is not None:
        headers.append(("WARC-Record-ID", f"<{_ID}{_value(row['record_id'])}>"))
    if row["target_uri"] is not None:
        headers.append(("WARC-Target-URI", _value(row["target_uri"])))
    if row["payload_digest"] is not None:
        headers.append(("WARC-Payload-Digest", f"sha1:{_value(row['payload_digest'])}"))
    if kind == "revisit":
        headers.append(("WARC-Profile", REVISIT_PROFILE))
    if row["refers_to"] is not None:
        headers.append(("WARC-Refers-To", f"<{_ID}{_value(row['refers_to'])}>"))
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def member(raw: bytes, level: int = LEVEL) -> bytes:
    """A gzip member whose header tells its own length and that of its content."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    size = _GZIP.size + len(body) + 8
    if size >= 1 << 32:  # the field can't hold it; readers inflate such a member
        return struct.pack("<BBBBIBB", 31, 139, 8, 0, 0, 0, 255) + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)
    head = _GZIP.pack(31, 139, 8, _FLAG_EXTRA, 0, 0, 255, 12, ord("s"), ord("l"), 8, size, len(raw) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def parse_headers(head: bytes) -> dict[str, str]:
    """Headers by lower-case name, without the version line."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def _plain(value: str | None) -> str | None:
    if value is None:
        return None
    value = value.strip("<>")
    return value[len(_ID) :] if value.startswith(_ID) else value


def columns_of(headers: dict[str, str]) -> dict:
    digest = headers.get("warc-payload-digest")
    return {
        "record_id": _plain(headers.get("warc-record-id")),
        "record_type": headers.get("warc-type"),
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": _plain(headers.get("warc-refers-to")),
        "date": headers.get("warc-date"),
        "payload_digest": digest.partition(":")[2] if digest and ":" in digest else digest,
    }


class Stream:
    """Records of a file: headers first, payloads only on demand.

    ``inflated`` counts the content bytes decoded, for tests and tuning.
    """

    CHUNK = 1 << 16

    def __init__(self, source, size: int) -> None:
        self.source, self.size, self.inflated = source, size, 0

    def __iter__(self) -> Iterator["Entry"]:
        at = 0
        while at < self.size:
            self.source.seek(at)
            start = self.source.read(self.CHUNK)
            if not start:
                return
            if start[:2] == b"\x1f\x8b":
                entry: Entry = Packed(self, at, start)
            else:
                skipped = len(start) - len(start.lstrip(b"\r\n"))
                if skipped:
                    at += skipped
                    continue
                entry = Plain(self, at, start)
            yield entry
            at = entry.end()


class Entry:
    """A record whose headers have been read."""

    def __init__(self, stream: Stream, offset: int) -> None:
        self.stream, self.offset = stream, offset
        self.known = bytearray()  # content so far
        while (cut := self.known.find(b"\r\n\r\n")) < 0 and self.more():
            pass
        self.body = cut + 4 if cut >= 0 else len(self.known)
        self.headers = parse_headers(bytes(self.known[: max(0, cut)]))
        try:
            self.block_size = int(self.headers.get("content-length", "0"))
        except ValueError:
            self.block_size = 0

    def more(self) -> bool:
        """Decode some more content; false at the end of it."""
        raise NotImplementedError

    def end(self) -> int:
        """Where the next record starts."""
        raise NotImplementedError

    def _until(self, size: int) -> None:
        while len(self.known) < size and self.more():
            pass

    def http_cut(self) -> int:
        """Where the payload starts in the content; an HTTP block has headers of its own."""
        if "application/http" not in self.headers.get("content-type", ""):
            return self.body
        stop = self.body + self.block_size
        while (cut := self.known.find(b"\r\n\r\n", self.body)) < 0 and len(self.known) < stop and self.more():
            pass
        return min(cut + 4, stop) if cut >= 0 else stop

    def payload_bytes(self) -> int:
        """Length of the payload as the block's own headers have it; only headers are decoded."""
        cut = self.http_cut()
        if cut > self.body:
            length = parse_headers(bytes(self.known[self.body : cut])).get("content-length", "")
            if length.isdigit():
                return int(length)
        return self.body + self.block_size - cut

    def payload(self) -> bytes:
        cut, stop = self.http_cut(), self.body + self.block_size
        self._until(stop)
        return bytes(self.known[cut:stop])


class Packed(Entry):
    """A gzip member."""

    def __init__(self, stream: Stream, offset: int, start: bytes) -> None:
        self.engine = zlib.decompressobj(31)
        self.input, self.read_to = start, offset + len(start)
        self.length = 0
        if len(start) >= _GZIP.size and start[3] & _FLAG_EXTRA:
            fields = _GZIP.unpack_from(start)
            if fields[8:11] == (ord("s"), ord("l"), 8):
                self.length = fields[11]
        super().__init__(stream, offset)

    def more(self) -> bool:
        while not self.engine.eof:
            if not self.input:
                self.stream.source.seek(self.read_to)
                self.input = self.stream.source.read(Stream.CHUNK)
                self.read_to += len(self.input)
                if not self.input:
                    return False
            # the first step is small: most headers need no more
            out = self.engine.decompress(self.input, 2048 if not self.known else Stream.CHUNK)
            self.input = self.engine.unconsumed_tail
            if out:
                self.known += out
                self.stream.inflated += len(out)
                return True
        return False

    def end(self) -> int:
        if self.length:
            return self.offset + self.length
        while self.more():  # no skip-lengths: inflate to the member's end, keeping nothing
            self.known = self.known[:0]
        return self.read_to - len(self.engine.unused_data)


class Plain(Entry):
    """An uncompressed record."""

    def __init__(self, stream: Stream, offset: int, start: bytes) -> None:
        self.pending, self.read_to = start, offset + len(start)
        super().__init__(stream, offset)

    def more(self) -> bool:
        if not self.pending:
            self.stream.source.seek(self.read_to)
            self.pending = self.stream.source.read(Stream.CHUNK)
            self.read_to += len(self.pending)
        self.known += self.pending
        self.stream.inflated += len(self.pending)
        got, self.pending = bool(self.pending), b""
        return got

    def end(self) -> int:
        return self.offset + self.body + self.block_size + 4


# -- the data source


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


@dataclass
class Files(InputPartition):
    paths: list[tuple[str, int]]


class WarcDataSource(DataSource):
    """``format("warc")``; option path; a schema of fewer columns reads fewer."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], schema.fieldNames())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("warc: archives are only appended to")
        return WarcWriter(self.options["path"], int(self.options.get("level", LEVEL)))


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, level: int) -> None:
        self.path, self.level = path.rstrip("/"), level

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        files: list[str] = []
        sink, size = None, 0
        names = [c.split()[0] for c in WRITE_SCHEMA.split(", ")]
        try:
            for batch in iterator:
                present = [n for n in names if n in batch.schema.names]
                for values in zip(*(batch.column(n) for n in present)):
                    row = dict.fromkeys(names) | {n: v.as_py() for n, v in zip(present, values)}
                    if sink is None or size >= FILE_BYTES:
                        if sink is not None:
                            sink.close()
                        files.append(f"{uuid.uuid4().hex}.warc.gz")
                        sink, size = fs.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
                    raw = member(record(row), self.level)
                    sink.write(raw)
                    size += len(raw)
        finally:
            if sink is not None:
                sink.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/{MANIFEST}{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps([f for m in messages if m is not None for f in m.files]).encode())

    def abort(self, messages: list) -> None:
        fs, folder = file_system(self.path)
        for m in messages:
            for name in m.files if m is not None else ():
                fs.delete_file(f"{folder}/{name}")


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]) -> None:
        self.path, self.columns = path.rstrip("/"), columns
        self.wanted: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column not in HEADER_COLUMNS:
                yield f
            elif isinstance(f, EqualTo):
                self.wanted.append((column, "in", frozenset([f.value])))
            elif isinstance(f, In):
                self.wanted.append((column, "in", frozenset(v for v in f.value if v is not None)))
            elif isinstance(f, StringStartsWith):
                self.wanted.append((column, "prefix", f.value))
            elif isinstance(f, IsNotNull):
                self.wanted.append((column, "some", None))
            else:
                yield f

    def _files(self) -> list[tuple[str, int]]:
        fs, root = file_system(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File:
            return [(root, info.size)]
        found = {f.base_name: f for f in fs.get_file_info(pafs.FileSelector(root)) if f.type == pafs.FileType.File}
        manifests = [f.path for n, f in found.items() if n.startswith(MANIFEST)]
        if manifests:
            names = []
            for m in sorted(manifests):
                with fs.open_input_stream(m) as source:
                    names += json.loads(source.read())
        else:
            names = sorted(n for n in found if n.endswith((".warc", ".warc.gz")))
        return [(found[n].path, found[n].size) for n in names]

    def partitions(self) -> list[Files]:
        """Files in order, together up to ``PARTITION_BYTES``."""
        groups: list[list[tuple[str, int]]] = []
        size = 0
        for path, length in self._files():
            if not groups or size + length > PARTITION_BYTES:
                groups.append([])
                size = 0
            groups[-1].append((path, length))
            size += length
        return [Files(g) for g in groups] or [Files([])]

    def _refused(self, row: dict) -> bool:
        for column, how, value in self.wanted:
            held = row[column]
            if held is None or how == "in" and held not in value or how == "prefix" and not held.startswith(value):
                return True
        return False

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        schema = pa.schema([(c, {"payload": pa.binary(), "payload_bytes": pa.int64(), "offset": pa.int64()}.get(c, pa.string())) for c in self.columns])
        sized = "payload_bytes" in self.columns or any(c == "payload_bytes" for c, _, _ in self.wanted)
        rows, held = [], 0
        for path, size in partition.paths:
            with fs.open_input_file(path) as source:
                for entry in Stream(source, size):
                    row = columns_of(entry.headers) | {"file": path.rsplit("/", 1)[-1], "offset": entry.offset}
                    if sized:
                        row["payload_bytes"] = entry.payload_bytes()
                    if self._refused(row):
                        continue
                    if "payload" in self.columns:
                        row["payload"] = entry.payload()
                        held += len(row["payload"])
                    rows.append(row)
                    held += 200
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


#: Rows up to which the list of repeated payloads is sent to every task; beyond, payloads are shuffled to it.
BROADCAST_ROWS = 100_000


def records(pages: DataFrame, least: int = 1000, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """Rows to write: of equal payloads of at least ``least`` bytes the greatest id is the response.

    Rows that share this id are all responses; a row without an id is a revisit
    if one of its group has an id, else a response.
    """
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("target_uri"), F.encode(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.select("*", F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    groups = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.max("id").alias("first"), F.count("*").alias("n"))
    groups = checkpointed(groups.where("n > 1 and first is not null").select("payload_digest", "first"))
    if groups.count() <= BROADCAST_ROWS:
        groups = F.broadcast(groups)
    rows = rows.join(groups, "payload_digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return rows.select(
        F.col("id").cast("string").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(revisit, F.col("first").cast("string")).alias("refers_to"),
        F.lit(None).cast("string").alias("date"),
        "payload_bytes",
        "payload_digest",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def round_trip(pages: DataFrame, least: int = 1000, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) as the archives hold them after writing."""
    spark = pages.sparkSession
    register(spark)
    bounded_batches(spark)
    folder = f"{work_dir(spark)}/warc-{uuid.uuid4().hex}"
    records(pages, least, id_col, url_col, text_col).write.format("warc").mode("append").save(folder)
    held = spark.read.format("warc").load(folder)
    response = F.col("record_type") == "response"
    return held.select(
        F.col("record_id").cast("long").alias(id_col),
        F.when(response, F.length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )
