"""WARC archives behind a Python data source that writes and reads them.

Archives are plain, from Spark's text writer, or gzip with one member a record; each member's header
tells its length (the extra field ``sl``: compressed and plain bytes), which other
gzip readers pass over. The reader plans one partition a file. Predicates on the record type
and on header columns are pushed down; a record's headers are parsed first, and the
block of a record that is not wanted, or whose payload column is not asked for, is
skipped by a seek: over the plain bytes, or over the rest of the member, of which no more than
the first bytes are inflated. Gzip files of other writers, without the lengths, are read through.

A gzip write is committed by the list of files that its successful tasks wrote, so files of lost or repeated
tasks are never read.

Writing marks records with equal payloads of at least ``least_bytes`` bytes: the one
with the smallest page_id is a response, the others are revisits of it without a
payload, which tell the payload's digest and length in their own headers. Payloads that
more than ``max(HOT_ROWS, rows / HOT_PAYLOADS)`` pages share are at most ``HOT_PAYLOADS``, a
table of proven size that is broadcast; pages of the rest meet their payload's first page by
a join on the digest, so no key of that join is frequent.

Defined results: null html counts as empty; a null url has no target header; line
ends in a url are percent-encoded; rows that repeat the smallest page_id of a
payload are all responses, as is a row without page_id; rows that repeat a page_id with other
payloads are told by their own payloads; an empty table writes an archive without records; extra
columns are ignored.
"""

from __future__ import annotations

import gzip
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from fringeflow.plans.lineage import settle, shared_path

SCHEMA = "warc_type string, record_id string, target_uri string, payload_digest string, refers_to string, content_length long, payload_length long, payload binary"
_HEADER_OF = {"warc_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
_END = "\r\n"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BATCH_BYTES = 8 << 20
_HEAD_BYTES = 4096
_FILES = "_files-"
HOT_ROWS = 256
HOT_PAYLOADS = 8192
FILE_BYTES = 512 << 20
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}


def base32_sha1(raw: Column) -> Column:
    """SHA-1 of bytes in upper-case base 32, which 20 bytes fill without padding."""
    hexed = F.sha1(raw)
    parts = []
    for i in range(8):
        five = F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("int")
        parts += [F.substring(F.lit(_ALPHABET), F.shiftright(five, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


@dataclass
class FilePartition(InputPartition):
    path: str


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(folder)``; a schema with fewer columns of ``SCHEMA`` may be given."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> "WarcReader":
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> "WarcWriter":
        return WarcWriter(self.options["path"], int(self.options.get("maxrecordsperfile", 20_000)))


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType) -> None:
        self.path, self.columns = path, [(f.name, f.dataType.simpleString()) for f in schema.fields]
        self.wanted: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In, StringStartsWith)) and len(f.attribute) == 1 and f.attribute[0] in _HEADER_OF:
                self.wanted.append(f)
            else:
                yield f

    def partitions(self) -> list[FilePartition]:
        fs, root = pyarrow.fs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pyarrow.fs.FileSelector(root, recursive=True))
        lists = [f.path for f in found if f.is_file and f.base_name.startswith(_FILES)]
        if lists:
            files = [f"{root}/{name}" for path in lists for name in json.loads(fs.open_input_file(path).read())]
        else:
            files = [f.path for f in found if f.is_file and f.size and not f.base_name.startswith(("_", "."))]
        return [FilePartition(p) for p in sorted(files) or [""]]

    def _passes(self, heads: dict[str, str]) -> bool:
        for f in self.wanted:
            value = heads.get(_HEADER_OF[f.attribute[0]])
            if value is None:
                return False
            if isinstance(f, EqualTo) and value != f.value or isinstance(f, In) and value not in f.value or isinstance(f, StringStartsWith) and not value.startswith(f.value):
                return False
        return True

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = pyarrow.fs.FileSystem.from_uri(self.path)
        names = [n for n, _ in self.columns]
        kinds = [_KINDS[k] for _, k in self.columns]
        rows, held = [], 0
        with fs.open_input_file(partition.path) as raw:
            for heads, payload in (members if partition.path.endswith(".gz") else records)(raw, self._passes, "payload" in names):
                known = {c: heads.get(h) for c, h in _HEADER_OF.items()} | {"content_length": int(heads["content-length"]), "payload_length": _number(heads.get("x-payload-length")), "payload": payload}
                rows.append([known[n] for n in names])
                held += 200 + len(payload or b"")
                if held >= _BATCH_BYTES:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
        if rows:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class _Buffered:
    """Lines, bytes and skips over a file that can seek."""

    def __init__(self, source, block: int = 1 << 20) -> None:
        self.source, self.block, self.data, self.at = source, block, b"", 0

    def line(self) -> bytes | None:
        while True:
            end = self.data.find(b"\n", self.at)
            if end >= 0:
                found, self.at = self.data[self.at : end + 1], end + 1
                return found
            more = self.source.read(self.block)
            if not more:
                found, self.data, self.at = self.data[self.at :], b"", 0
                return found or None
            self.data, self.at = self.data[self.at :] + more, 0

    def take(self, n: int) -> bytes:
        found = self.data[self.at : self.at + n]
        self.at += len(found)
        return found if len(found) == n else found + self.source.read(n - len(found))

    def skip(self, n: int) -> None:
        here = min(n, len(self.data) - self.at)
        self.at += here
        if n > here:
            self.source.seek(n - here, 1) if isinstance(self.source, gzip.GzipFile) else self.source.seek(self.source.tell() + n - here)


def records(source, passes, with_payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers (names in lower case) of the records that pass, and their payloads if they are asked for.

    Blocks of the rest are skipped without being read.
    """
    stream = _Buffered(source)
    while (heads := _heads(stream)) is not None:
        n = int(heads["content-length"])
        if not passes(heads):
            stream.skip(n)
        elif not with_payload:
            stream.skip(n)
            yield heads, None
        else:
            yield heads, _payload(heads, stream.take(n))


def _number(value: str | None) -> int | None:
    return int(value) if value is not None else None


def _heads(stream: _Buffered) -> dict[str, str] | None:
    """The headers of the next record, None at the end."""
    while (line := stream.line()) is not None:
        if line.startswith(b"WARC/"):
            heads = {}
            while (line := stream.line()) is not None and line.strip():
                name, _, value = line.decode("utf-8", "replace").partition(":")
                heads[name.strip().lower()] = value.strip()
            return heads
        if line.strip():
            raise ValueError(f"a record starts with {line[:40]!r}")
    return None


def _payload(heads: dict[str, str], block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2] if heads.get("content-type", "").startswith("application/http") else block


def member(record: bytes) -> bytes:
    """A record as one gzip member whose header holds its lengths."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = packer.compress(record) + packer.flush()
    length = _MEMBER.size + len(packed) + 8
    return _MEMBER.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, length, len(record) & 0xFFFFFFFF) + packed + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


_MEMBER = struct.Struct("<4sIBBH2sHII")  # gzip mark and flags, time, level, system, extra bytes, field, its bytes, both lengths


def members(raw, passes, with_payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """As ``records``, of a gzip file; the rest of a member that is not wanted is neither read nor inflated."""
    at, size = 0, raw.size()
    while at < size:
        raw.seek(at)
        start = raw.read(_MEMBER.size)
        told = _MEMBER.unpack(start) if len(start) == _MEMBER.size else None
        if not told or told[0] != b"\x1f\x8b\x08\x04" or told[5] != b"sl":
            raw.seek(at)
            yield from records(gzip.GzipFile(fileobj=raw), passes, with_payload)
            return
        stream = _Inflated(raw, told[7] - _MEMBER.size)
        heads = _heads(stream)
        if heads is not None and passes(heads):
            yield heads, _payload(heads, stream.take(int(heads["content-length"]))) if with_payload else None
        at += told[7]


class _Inflated(_Buffered):
    """A member's bytes, inflated block by block as they are asked for."""

    def __init__(self, raw, left: int) -> None:
        super().__init__(self, _HEAD_BYTES)
        self.raw, self.left, self.inflater = raw, left, zlib.decompressobj(-15)

    def read(self, n: int) -> bytes:
        out = b""
        while len(out) < n:
            data = self.inflater.unconsumed_tail
            if not data and self.left:
                data = self.raw.read(min(self.left, max(_HEAD_BYTES, n - len(out))))
                self.left -= len(data)
            if not data:
                break
            out += self.inflater.decompress(data, n - len(out))
            if self.inflater.eof:
                break
        return out


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Appends one gzip member for each ``value`` to files of the path, in any file system that Arrow opens."""

    def __init__(self, path: str, most: int) -> None:
        self.path, self.most = path, most

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = pyarrow.fs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        files, out, held, n = [], None, 0, 0
        try:
            for batch in iterator:
                for value in batch.column(0):
                    if out is None:
                        files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, held, n = fs.open_output_stream(f"{root}/{files[-1]}", compression=None), 0, 0
                    packed = member(value.as_buffer().to_pybytes() + b"\r\n\r\n")
                    out.write(packed)
                    held, n = held + len(packed), n + 1
                    if n >= self.most or held >= FILE_BYTES:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = pyarrow.fs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{_FILES}{uuid.uuid4().hex}") as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = pyarrow.fs.FileSystem.from_uri(self.path)
        for name in (f for m in messages if m for f in m.files):
            fs.delete_file(f"{root}/{name}")


def _head(*lines: tuple[str, Column]) -> Column:
    """Header lines; those with a null value are left out."""
    return F.concat_ws("", *[F.concat(F.lit(f"{name}: "), value, F.lit(_END)) for name, value in lines])


def page_records(pages: DataFrame, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One WARC record a row as ``value``, without the blank lines that end it."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    body = F.encode("html", "UTF-8")
    own = own.withColumn("digest", base32_sha1(body)).withColumn("n", F.octet_length(body))
    groups = own.where(F.col("n") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("pages"))
    shared = settle(groups.where("pages > 1"), "warc-shared")
    least = max(HOT_ROWS, pages.count() // HOT_PAYLOADS)
    hot = shared.where(F.col("pages") > least).select("digest", F.col("first").alias("hot_first"))  # at most HOT_PAYLOADS rows
    cold = shared.where(F.col("pages") <= least).select(F.col("digest").alias("key"), F.col("first").alias("cold_first"))
    met = own.join(F.broadcast(hot), "digest", "left")
    # Pages of frequent payloads take no part in the second join: their keys meet nothing and spread.
    met = met.withColumn("key", F.when(F.col("hot_first").isNull(), F.col("digest")).otherwise(F.concat("digest", F.lit(":"), F.col("page_id"))))
    met = met.join(cold, "key", "left").withColumn("first", F.coalesce("hot_first", "cold_first"))
    again = (F.col("n") >= least_bytes) & (F.col("first") != F.col("page_id"))
    again = F.coalesce(again, F.lit(False))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), F.col("n").cast("string"), F.lit(_END * 2))
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("html")))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    heads = _head(
        ("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:>"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("WARC-Refers-To", F.when(again, urn(F.col("first")))),
        ("X-Payload-Length", F.col("n").cast("string")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length(F.encode("block", "UTF-8")).cast("string")),
    )
    return met.withColumn("block", block).select(F.concat(F.lit(f"WARC/1.1{_END}"), heads, F.lit(_END), F.col("block")).alias("value"))


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, records_per_file: int = 20_000, gzip_files: bool = True) -> None:
    """Archives of all pages under ``path``; plain ones in any file system that Spark writes to.

    Either kind lets the reader seek past blocks; gzip files take less disk.
    """
    found = page_records(pages, least_bytes)
    if gzip_files:
        pages.sparkSession.dataSource.register(WarcDataSource)
        found.select(F.encode("value", "UTF-8").alias("value")).write.format("warc").option("maxRecordsPerFile", records_per_file).mode("append").save(path)
    else:
        found.write.option("lineSep", _END * 2).option("maxRecordsPerFile", records_per_file).option("compression", "none").text(path)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Records under ``path``; without ``payload`` among the columns no block is read.

    Turns on the session's push-down of filters to Python data sources, which is off by default.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    kept = [c for c in SCHEMA.split(", ") if columns is None or c.split()[0] in columns]
    return spark.read.format("warc").schema(", ".join(kept)).load(path)


def _page(urn: str) -> Column:
    return F.nullif(F.regexp_extract(urn, r"<urn:page:(-?\d*)>", 1), F.lit("")).cast("long")


def archive_round_trip(pages: DataFrame, least_bytes: int = 0, gzip_files: bool = True) -> DataFrame:
    """What the archives say of each page after they are written and read back."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_warc(pages, path, least_bytes, gzip_files=gzip_files)
    full = read_warc(spark, path, ["warc_type", "record_id", "payload"]).where("warc_type = 'response'")
    full = full.select(_page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"), F.col("warc_type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    light = read_warc(spark, path, ["warc_type", "record_id", "refers_to", "payload_digest", "payload_length"]).where("warc_type = 'revisit'")
    light = light.select(_page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), F.col("warc_type").alias("record_type"), _page("refers_to").alias("refers_to"))
    return full.union(light)
