"""WARC archives as a Spark data source, written and read by Python tasks.

Writing: one gzip member per record. Of records with equal payloads of at least
``MIN_REVISIT`` bytes the one with the smallest page_id is a response, the
others are revisits that refer to it and carry headers only. Each member notes
its own length in a gzip extra field, so that a reader can step over it.

Reading: files are planned into partitions by size; predicates on the record
type and on header columns are pushed down; of every record the headers are
inflated and parsed first, and a payload that no one wants is neither inflated
(if the member tells its length) nor decoded. Plain and gzipped archives from
elsewhere are read as well.

Edge cases: a null payload is an empty one; a null url or page_id leaves its
header out; rows that repeat the smallest page_id of a group are all responses;
an empty table gives an archive without files and reading it gives no rows;
control characters of urls are percent-encoded; other columns are left out.
"""

from __future__ import annotations

import struct
import uuid
import gzip
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
    StringStartsWith, WriterCommitMessage,
)

from fundcast.llm import files

FORMAT = "fundcast_warc"
MIN_REVISIT = 100
FILE_BYTES = 256 << 20
#: Small files are read together up to this size.
PART_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"  # fixed, so that archives of equal tables are equal
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Result columns that come from one header each: name -> (header, type).
HEADERS = {
    "record_type": ("warc-type", "string"), "record_id": ("warc-record-id", "string"),
    "target_uri": ("warc-target-uri", "string"), "date": ("warc-date", "string"),
    "content_type": ("content-type", "string"), "payload_digest": ("warc-payload-digest", "string"),
    "page_id": ("x-page-id", "long"), "payload_bytes": ("x-payload-length", "long"),
    "refers_to": ("x-refers-to-page-id", "long"),
}
SCHEMA = ", ".join(f"{k} {t}" for k, (_, t) in HEADERS.items()) + ", payload binary"
_NAMES = [*HEADERS, "payload"]
_TYPES = [pa.int64() if t == "long" else pa.string() for _, t in HEADERS.values()] + [pa.binary()]
_EXTRA = struct.Struct("<2sHII")  # tag, size, bytes of the member, bytes inflated


def _uri(url: str) -> str:
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}').urn}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit (``refers_to`` given) has HTTP headers but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as a gzip member that notes its own length where 32 bits hold it."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    total = 10 + 2 + _EXTRA.size + len(body) + 8
    if total >= 1 << 32 or len(data) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\x00\xff" + body + tail
    extra = _EXTRA.pack(b"SL", _EXTRA.size - 4, total, len(data))
    return b"\x1f\x8b\x08\x04\0\0\0\0\x00\xff" + struct.pack("<H", len(extra)) + extra + body + tail


@dataclass
class Written(WriterCommitMessage):
    paths: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        part = TaskContext.get().partitionId()
        done: list[str] = []
        out, size = None, 0
        try:
            for batch in iterator:
                for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                    page_id, url, payload, digest, refers_to = (x.as_py() for x in row)
                    if out is None or size >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        # unfinished files are hidden by their first character
                        done.append(files.child(self.path, f"_part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.warc.gz"))
                        where, name = files.locate(done[-1])
                        out, size = where.open_output_stream(name, compression=None), 0
                    size += out.write(member(record(page_id, url, payload or b"", digest, refers_to)))
            if out is not None:
                out.close()
        except BaseException:
            if out is not None:
                out.close()
            files.delete(done)
            raise
        return Written(done)

    def commit(self, messages: list) -> None:
        for m in messages:
            for p in m.paths if m else []:
                where, name = files.locate(p)
                folder, _, last = name.rpartition("/")
                where.move(name, f"{folder}/{last[1:]}")

    def abort(self, messages: list) -> None:
        files.delete([p for m in messages if m for p in m.paths])


class FileGroup(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Records:
    """Steps over the records of one archive: headers, then the payload on demand."""

    def __init__(self, f, zipped: bool):
        self.f, self.zipped = f, zipped
        self.left = b""  # read, not used yet

    def _more(self, n: int = 1 << 16) -> bytes:
        return self.f.read(n)

    def _take(self, n: int) -> bytes:
        while len(self.left) < n and (data := self._more(max(1 << 16, n - len(self.left)))):
            self.left += data
        out, self.left = self.left[:n], self.left[n:]
        return out

    def _skip(self, n: int) -> None:
        if n <= len(self.left):
            self.left = self.left[n:]
        else:
            self.f.seek(self.f.tell() + n - len(self.left))
            self.left = b""

    def __iter__(self):
        return self._gzip() if self.zipped else self._plain()

    def _plain(self):
        while True:
            while b"\r\n\r\n" not in self.left.lstrip(b"\r\n") and (data := self._more()):
                self.left += data
            self.left = self.left.lstrip(b"\r\n")
            if b"\r\n\r\n" not in self.left:
                return
            head, self.left = self.left.split(b"\r\n\r\n", 1)
            headers = parse(head)
            size, used = int(headers.get("content-length", 0)), []

            def payload(used=used, size=size):
                used.append(True)
                return self._take(size)

            yield headers, payload
            if not used:
                self._skip(size)

    def _gzip(self):
        while True:
            if len(self.left) < 32 and (data := self._more()):
                self.left += data
                continue
            if not self.left:
                return
            length = None
            if self.left[3] & 4 and self.left[12:14] == b"SL":
                length = _EXTRA.unpack_from(self.left, 12)[2]
            member_at = self.f.tell() - len(self.left)
            if length is None:  # members of any content: records run on within and across them
                self.f.seek(member_at)
                yield from type(self)(gzip.GzipFile(fileobj=self.f), False)._plain()
                return
            inflate = zlib.decompressobj(31)
            data, feed = b"", self.left
            while b"\r\n\r\n" not in data and not inflate.eof:
                data += inflate.decompress(feed, 1 << 12)
                feed = inflate.unconsumed_tail or (b"" if inflate.eof else self._more())
                if not feed and not inflate.eof and not inflate.unconsumed_tail:
                    break
            head, _, begun = data.partition(b"\r\n\r\n")
            headers = parse(head)
            state = {"feed": feed, "done": False}

            def rest(inflate=inflate, state=state):
                parts, feed = [], state["feed"]
                while not inflate.eof:
                    if not feed and not (feed := self._more()):
                        break
                    parts.append(inflate.decompress(feed, 1 << 20))
                    feed = inflate.unconsumed_tail
                state["done"] = True
                self.left = inflate.unused_data
                return b"".join(parts)

            def payload(begun=begun, headers=headers, rest=rest):
                return (begun + rest())[: int(headers.get("content-length", 0))]

            yield headers, payload
            if not state["done"]:  # the rest of this member is not even inflated
                self.f.seek(member_at + length)
                self.left = b""


def parse(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _value(column: str, headers: dict[str, str]):
    name, kind = HEADERS[column]
    value = headers.get(name)
    if value is None:
        return None
    if column == "payload_digest":
        return value.partition(":")[2] or value
    return int(value) if kind == "long" else value


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.wanted: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = getattr(f, "attribute", ("",))
            if len(column) == 1 and column[0] in HEADERS and isinstance(f, EqualTo | In | StringStartsWith):
                kind = {EqualTo: "is", In: "in", StringStartsWith: "starts"}[type(f)]
                self.wanted.append((column[0], kind, f.value))
            else:
                yield f

    def partitions(self) -> list[FileGroup]:
        groups: list[FileGroup] = []
        room = 0
        for path, size in files.listed(self.path, ".warc.gz") + files.listed(self.path, ".warc"):
            if size > room or not groups:
                groups.append(FileGroup([]))
                room = PART_BYTES
            groups[-1].paths.append(path)
            room -= size
        return groups or [FileGroup([])]

    def _wants(self, headers: dict[str, str]) -> bool:
        for column, kind, want in self.wanted:
            value = _value(column, headers)
            if value is None:
                return False
            if not (value == want if kind == "is" else value in want if kind == "in" else str(value).startswith(want)):
                return False
        return True

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for path in partition.paths:
            where, name = files.locate(path)
            with where.open_input_file(name) as f:
                for headers, payload in _Records(f, path.endswith(".gz")):
                    if not self._wants(headers):
                        continue
                    body = None
                    if self.payload and headers.get("warc-type") != "revisit":
                        body = payload()
                        if headers.get("content-type", "").startswith("application/http"):
                            body = body.partition(b"\r\n\r\n")[2]
                    rows.append((*(_value(c, headers) for c in HEADERS), body))
                    size += len(body or b"") + 500
                    if size >= 8 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def with_revisits(pages: DataFrame, payload: str = "html") -> DataFrame:
    """page_id, url, payload, digest, refers_to. Only digests that occur more than
    once are joined back; a digest of a third of all rows is split by AQE."""
    body = F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b""))
    shown = pages.select("page_id", "url", body.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    thin = pages.select("page_id", F.sha2(body, 256).alias("_digest"), F.length(body).alias("_n"))
    first = (
        thin.where(F.col("_n") >= MIN_REVISIT).groupBy("_digest")
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_rows")).where("_rows > 1")
    )
    refers = F.when(F.col("page_id").eqNullSafe(F.col("_first")), None).otherwise(F.col("_first"))
    return shown.join(first, F.col("digest") == F.col("_digest"), "left").select(
        F.col("page_id").cast("long").alias("page_id"), "url", "payload", "digest", refers.cast("long").alias("refers_to")
    )


def write(pages: DataFrame, path: str, payload: str = "html") -> str:
    """Archive ``pages`` (page_id, url, payload column) below ``path`` (new or empty)."""
    pages.sparkSession.dataSource.register(WarcSource)
    files.make_dir(path)
    with_revisits(pages, payload).write.format(FORMAT).mode("append").option("path", path).save()
    return path


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records below ``path`` with header columns and, if wanted, payloads.
    Filters on header columns are evaluated before payloads are touched (this
    enables Spark's filter push-down for Python sources in the session)."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(FORMAT).option("path", path).option("payload", str(payload).lower()).load()
