"""WARC archives as a Spark data source.

Reading plans one partition per record-aligned split of each file.  Predicates
on the record type and on other header columns are pushed into the scan: a
record's headers are parsed first, and the payload of a record that does not
qualify, or whose schema asks for no payload column, is skipped by seeking.

Writing makes gzip members, one a record, each with a skip length in its gzip
header ("sl" extra field), under names of their own; each commit of the driver
lists the files of successful tasks in a manifest of its own, so that repeated or
failed tasks leave nothing that a reader would see.  A reader sees the files of
all manifests; mode "append" adds one, mode "overwrite" takes the others away.

Archives of others, plain or gzip, without manifest or skip lengths, can be read
as well, one partition a file.  ``option("splitMembers", "true")`` cuts gzip files
at members that begin with a record; it is off by default, since a payload that
is an archive itself could look like such a member.  A record with a header that
is malformed or has no valid Content-Length comes with null content_length and
null payload, and reading goes on at the next record or member.

Defined cases: a null page is an empty payload; a null id leaves the id header
out and reads back as null; among equal payloads the largest id is the response
(rows that repeat that id are responses as well); with null ids only, all are
responses; an empty table gives a manifest without files; other columns, whatever
their names, are ignored; payloads of any size are read in linear time, whole in
memory one at a time (a gzip member's lengths are 32 bits: 4 GB at most).
``register`` turns on Spark's filter push-down to Python sources for the session.
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
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
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
from pyspark.sql.types import StructType

from millrace.llm.common import file_system, put_file, read, shared_dir

MANIFEST = "_records"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPLIT_BYTES = 16 << 20
#: Columns a reader can give; those from the payload need its bytes, the others need headers only.
HEADER_COLUMNS = {"record_type": "string", "record_id": "string", "target_uri": "string", "date": "string", "page_id": "long", "refers_to": "long", "header_digest": "string", "header_length": "long", "content_length": "long", "headers": "map<string,string>"}
PAYLOAD_COLUMNS = {"payload": "binary", "payload_bytes": "long", "payload_digest": "string"}
URN = "urn:millrace:page:"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, date: str = "2000-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http;msgtype=response"]
    lines.append(f"WARC-Record-ID: <{URN}{page_id}>" if page_id is not None else f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>")
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{URN}{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    """A gzip member whose header tells its own length and that of its content."""
    pack = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    total = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int | None
    search: bool

    def __init__(self, path: str, start: int, end: int | None, search: bool = False):
        super().__init__((path, start, end))
        self.path, self.start, self.end, self.search = path, start, end, search


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    records: int
    splits: list[int]
    size: int


class Stream:
    """Plain bytes of a file from an offset; knows where gzip members begin and can step over the rest of one."""

    def __init__(self, file, at: int, end: int, search: bool = False):
        self.file, self.at, self.end = file, at, end
        self.buffer, self.pos, self.raw, self.unpack, self.next = b"", 0, b"", None, None
        file.seek(0)
        self.packed = file.read(2) == b"\x1f\x8b"
        file.seek(at)
        if search and at and self.packed:
            self._seek_member()

    def begin(self) -> bool:
        """To the start of the next record; False at the end of the split."""
        if not self.packed:
            return self.at - (len(self.buffer) - self.pos) < self.end and self._fill(1)
        if self._fill(1):  # several records in one member
            return True
        while self._member():
            if self._fill(1):
                return True
        return False

    def _member(self) -> bool:
        start = self.at - len(self.raw)
        if start >= self.end:
            return False
        while len(self.raw) < 24 and (more := self.file.read(1 << 16)):
            self.raw += more
            self.at += len(more)
        if not self.raw:
            return False
        self.next = start + struct.unpack_from("<I", self.raw, 16)[0] if len(self.raw) >= 24 and self.raw[3] & 4 and self.raw[12:14] == b"sl" else None
        self.unpack = zlib.decompressobj(31)
        return True

    def _seek_member(self) -> None:
        """To the next place where a gzip member with a record begins."""
        while True:
            i = self.raw.find(b"\x1f\x8b\x08")
            if i < 0 or len(self.raw) - i < 1 << 10:
                more = self.file.read(1 << 16)
                self.at += len(more)
                if more:
                    self.raw = self.raw[i:] + more if i >= 0 else self.raw[-2:] + more
                    continue
                if i < 0:
                    self.raw = b""
                    return
            try:
                if zlib.decompressobj(31).decompress(self.raw[i : i + (1 << 10)], 5) == b"WARC/":
                    self.raw = self.raw[i:]
                    return
            except zlib.error:
                pass
            self.raw = self.raw[i + 1 :]

    def _more(self, want: int) -> bytes:
        """Further plain bytes, none at the end of the file or member."""
        if not self.packed:
            more = self.file.read(max(1 << 16, want))
            self.at += len(more)
            return more
        while self.unpack is not None and not self.unpack.eof:
            if not self.raw:
                self.raw = self.file.read(1 << 16)
                self.at += len(self.raw)
            try:
                if not self.raw:
                    rest, self.unpack = self.unpack.flush(), None
                    return rest
                out = self.unpack.decompress(self.raw, max(1 << 14, want))
            except zlib.error:  # a broken member ends here; the next one is looked for
                self.raw, self.unpack, self.next = self.raw[1:], None, None
                self._seek_member()
                return b""
            self.raw = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
            if out:
                return out
        return b""

    def _fill(self, n: int) -> bool:
        """At least n bytes in the buffer, if there are so many; parts are joined once."""
        have = len(self.buffer) - self.pos
        if have >= n:
            return True
        parts = [self.buffer[self.pos :]]
        while have < n and (more := self._more(n - have)):
            parts.append(more)
            have += len(more)
        self.buffer, self.pos = b"".join(parts), 0
        return have >= n

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (i := self.buffer.find(mark, self.pos + seen)) < 0:
            have = len(self.buffer) - self.pos
            seen = max(0, have - len(mark))
            if not self._fill(max(have + 1, 2 * have)) and len(self.buffer) - self.pos == have:
                return None
        out, self.pos = self.buffer[self.pos : i], i + len(mark)
        return out

    def take(self, n: int) -> bytes:
        self._fill(n)
        out = self.buffer[self.pos : self.pos + n]
        self.pos += len(out)
        return out

    def skip(self, n: int) -> None:
        """Over the rest of a record of which n bytes are left."""
        if self.packed and self.next is not None:
            self.file.seek(self.next)
            self.at, self.buffer, self.pos, self.raw, self.unpack = self.next, b"", 0, b"", None
            return
        here = min(n, len(self.buffer) - self.pos)
        self.pos += here
        n -= here
        if not self.packed:
            self.at += n
            self.file.seek(self.at)
            return
        while n > 0 and self._fill(1):
            here = min(n, len(self.buffer) - self.pos)
            self.pos += here
            n -= here

    def resume(self) -> None:
        """After a malformed record: to what looks like the next record of the member or plain file, or behind it."""
        if self.packed and self.next is not None:
            self.skip(0)
        elif self.until(b"\r\n\r\nWARC/") is not None:
            self.pos -= 5
        else:
            self.pos = len(self.buffer)


def _page(text: str | None) -> int | None:
    text = (text or "").strip("<>")
    return int(text[len(URN) :]) if text.startswith(URN) and text[len(URN) :].lstrip("-").isdigit() else None


def records(file, start: int, end: int, wanted, payload: bool, search: bool = False) -> Iterator[dict]:
    """Records that begin in [start, end) and whose header columns ``wanted`` accepts."""
    stream = Stream(file, start, end, search)
    while stream.begin():
        head = stream.until(b"\r\n\r\n")
        if head is None:
            stream.pos = len(stream.buffer)
            if not stream.packed:
                return
            continue
        fields = {}
        for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        size = fields.get("content-length", "0")
        length = int(size) if size.isascii() and size.isdigit() else None
        sound = length is not None and head.startswith(b"WARC/")
        row = {
            "record_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "page_id": _page(fields.get("warc-record-id")),
            "refers_to": _page(fields.get("warc-refers-to")), "header_digest": (fields.get("warc-payload-digest") or "").rpartition(":")[2] or None, "content_length": length if sound else None, "headers": fields,
        }
        if not sound:
            stream.resume()
            if wanted(row):
                yield row
            continue
        if not wanted(row):
            stream.skip(length + 4)
            continue
        is_http = fields.get("content-type", "").startswith("application/http")
        body, http = None, b""
        if payload:
            block = stream.take(length)
            http, _, body = block.partition(b"\r\n\r\n") if is_http else (b"", b"", block)
            stream.skip(4)
        elif is_http:
            # no farther than the block goes, for it may lack the empty line
            block = stream.take(min(length, 1 << 10))
            while b"\r\n\r\n" not in block and len(block) < length and (more := stream.take(min(length - len(block), 1 << 14))):
                block += more
            http = block.partition(b"\r\n\r\n")[0]
            stream.skip(length - len(block) + 4)
        else:
            stream.skip(length + 4)
        sizes = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        row["header_length"] = (int(sizes[0]) if sizes and sizes[0].isdigit() else None) if is_http else length
        if body is not None:
            row |= {"payload": body, "payload_bytes": len(body), "payload_digest": digest(body)}
        yield row


_TESTS = {
    EqualTo: lambda v, w: v == w, GreaterThan: lambda v, w: v > w, GreaterThanOrEqual: lambda v, w: v >= w,
    LessThan: lambda v, w: v < w, LessThanOrEqual: lambda v, w: v <= w, In: lambda v, w: v in w, StringStartsWith: lambda v, w: v.startswith(w),
}


def _manifests(system, folder: str) -> list[str]:
    from pyarrow import fs

    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if system.get_file_info(folder).type == fs.FileType.Directory else []
    return sorted(x.path for x in found if x.base_name.startswith(MANIFEST) and x.base_name.endswith(".json"))


def _listed(system, manifest: str) -> list[dict]:
    with system.open_input_stream(manifest) as f:
        return json.loads(f.read())


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str, split_members: bool):
        self.names, self.path, self.split_members, self.tests = schema.names, path, split_members, []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column not in HEADER_COLUMNS or column == "headers" or not (type(f) in _TESTS or isinstance(f, IsNotNull)):
                yield f
            elif isinstance(f, IsNotNull):
                self.tests.append((column, None, None))
            else:
                self.tests.append((column, type(f).__name__, f.value))

    def partitions(self):
        system, folder = file_system(self.path)
        files = [x for m in _manifests(system, folder) for x in _listed(system, m)]
        if files or _manifests(system, folder):
            return [Split(f"{folder}/{x['name']}", a, b) for x in files for a, b in zip(x["splits"], [*x["splits"][1:], x["size"]], strict=True)] or [Split("", 0, 0)]
        from pyarrow import fs

        found = system.get_file_info(fs.FileSelector(folder, recursive=True)) if system.get_file_info(folder).type == fs.FileType.Directory else [system.get_file_info(folder)]
        out = []
        for x in found:
            if x.path.endswith((".warc", ".warc.gz")):
                step = SPLIT_BYTES if self.split_members and x.path.endswith(".gz") else max(1, x.size)
                out += [Split(x.path, at, min(x.size, at + step), True) for at in range(0, max(1, x.size), step)]
        return out or [Split("", 0, 0)]

    def read(self, split: Split):
        if not split.path:
            return
        by_name = {k.__name__: t for k, t in _TESTS.items()}

        def wanted(row: dict) -> bool:
            return all((v := row.get(c)) is not None and (kind is None or by_name[kind](v, value)) for c, kind, value in self.tests)

        system, _ = file_system(self.path)
        with system.open_input_file(split.path) as f:
            for row in records(f, split.start, split.end, wanted, any(n in PAYLOAD_COLUMNS for n in self.names), split.search):
                yield tuple(row.get(n) for n in self.names)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator):
        system, folder = file_system(self.path)
        out, name, n, at, splits = None, f"part-{uuid.uuid4().hex}.warc.gz", 0, 0, [0]
        for batch in iterator:
            if out is None and batch.num_rows:
                system.create_dir(folder, recursive=True)
                out = system.open_output_stream(f"{folder}/{name}", compression=None, buffer_size=1 << 20)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("record_type", "page_id", "url", "html", "refers_to")]
            for i in range(batch.num_rows):
                kind, page_id, url, html, refers = (c[i].as_py() for c in columns)
                if at - splits[-1] >= SPLIT_BYTES:
                    splits.append(at)
                data = member(record(kind, page_id, url, (html or "").encode("utf-8", "replace"), refers))
                out.write(data)
                at += len(data)
                n += 1
        if out is not None:
            out.close()
        return Written(name if n else None, n, splits, at)

    def commit(self, messages):
        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        files = [{"name": m.name, "records": m.records, "splits": m.splits, "size": m.size} for m in messages if m and m.name]
        old = _manifests(system, folder) if self.overwrite else []
        put_file(self.path, f"{MANIFEST}-{uuid.uuid4().hex}.json", json.dumps(files).encode())
        for manifest in old:  # first out of sight, then gone
            names = [x["name"] for x in _listed(system, manifest)]
            system.delete_file(manifest)
            for name in names:
                system.delete_file(f"{folder}/{name}")

    def abort(self, messages):
        system, folder = file_system(self.path)
        for m in messages:
            if m and m.name:
                system.delete_file(f"{folder}/{m.name}")


class WarcDataSource(DataSource):
    """``spark.read.format("warc").schema(...).load(folder)``; a schema without payload columns never touches payloads."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return ", ".join(f"{n} {t}" for n, t in (HEADER_COLUMNS | PAYLOAD_COLUMNS).items())

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(schema, self.options["path"], self.options.get("splitMembers", "false").lower() == "true")

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def archive(pages: DataFrame, folder: str) -> None:
    """Write a record per page; of pages with equal payloads all but the one with the largest id are revisits."""
    register(pages.sparkSession)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    again = rows.groupBy("sha").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "last")
    rows = rows.join(again, "sha", "left")
    revisit = F.coalesce(F.col("page_id") < F.col("last"), F.col("page_id").isNull() & F.col("last").isNotNull())
    out = rows.select("page_id", "url", "html", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("last")).alias("refers_to"))
    out.write.format("warc").mode("append").save(folder)


def read_back(spark, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): responses from their payloads, revisits from headers alone."""
    register(spark)
    scan = spark.read.format("warc")
    full = scan.schema("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long").load(folder).where("record_type = 'response'")
    head = scan.schema("page_id long, header_length long, header_digest string, record_type string, refers_to long").load(folder).where("record_type = 'revisit'")
    return full.unionAll(head)


def op5_warc_source(spark, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    archive(read(spark, sf_dir, "pages"), folder)
    return read_back(spark, folder)


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
l AS (SELECT h, max(page_id) AS last FROM p GROUP BY h),
b AS (SELECT p.*, last, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4)))::INT % 32, 1)), '') AS payload_digest
      FROM p JOIN l USING (h))
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, payload_digest, CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to FROM b
"""
