"""WARC archives as a Spark data source, for reading and writing.

Writing: one gzip member per record, with the "sl" extra field that holds the
member's compressed and uncompressed length. Tasks write files of their own
under _pending; the driver moves those of successful tasks on commit.

Reading: files are planned into partitions of about equal size. Filters on
header columns are pushed down: a record's headers are inflated and parsed
first, and a record that the filters reject, or whose payload is not in the
schema, is skipped by its length without inflating the rest. Members without
lengths, and plain files, are read in one pass.

Paths may have any scheme that pyarrow.fs knows.
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
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
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

from docloom.llm.shared import scratch, small_batches

# Fixed values of the format: version line, header of each column, revisit profile, suffix.
VERSION = b"WARC/1.1"
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SUFFIXES = (".warc", ".warc.gz")
#: Lists of files that a finished job wrote, and the names of such files.
LISTED = "_files-"
OURS = re.compile(r"part-[0-9a-f]{32}\.warc\.gz")
SCHEMA = ", ".join([f"{c} string" for c in HEADERS]) + ", content_length bigint, http_length bigint, payload binary, digest_ok boolean"


#: What the connectors of Spark call a store, and what pyarrow does.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss", "gcs": "gs"}


def store_uri(path: str) -> str:
    """path with a scheme that pyarrow knows: workers reach the store without the JVM, with the credentials of their environment."""
    scheme, colon, rest = path.partition("://")
    return f"{SCHEMES.get(scheme, scheme)}{colon}{rest}"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    path = store_uri(path)
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def header_safe(value: str) -> str:
    """Header values hold no control characters; those become percent escapes."""
    return "".join(quote(c) if ord(c) < 32 or ord(c) == 127 else c for c in value)


# ---- writing


def record(row: dict) -> bytes:
    """The bytes of one record. A revisit has HTTP headers, with the payload's length, but no payload."""
    payload = row.get("payload") or b""
    kind = row["record_type"] or "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.get('http_length') or len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = [f"{name}: {header_safe(str(row[c]))}" for c, name in HEADERS.items() if row.get(c) is not None]
    if kind == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """data as one gzip member with its lengths in an extra field (left out if they don't fit)."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    total = 10 + 2 + 12 + len(body) + 8
    end = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    if max(total, len(data)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\x00\xff" + body + end
    return b"\x1f\x8b\x08\x04\0\0\0\0\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total, len(data)) + body + end


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Tasks write their files where they stay; a list of the files of a job, written at its end, makes them part of the archive.

    Files of ours that no list names (of failed or repeated tasks) are not
    read, so nothing has to be moved.
    """

    def __init__(self, options, overwrite: bool) -> None:
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.level, self.most = int(options.get("level", 6)), int(options.get("max_file_bytes", 1 << 30))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, path = filesystem(self.path)
        fs.create_dir(path, recursive=True)
        files: list[str] = []
        out = None
        size = 0
        for part in iterator:
            for i in range(part.num_rows):
                if out is None or size >= self.most:
                    if out is not None:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{path}/{files[-1]}", compression=None), 0
                data = member(record(part.slice(i, 1).to_pylist()[0]), self.level)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, path = filesystem(self.path)
        fs.create_dir(path, recursive=True)
        before = [i.path for i in fs.get_file_info(pafs.FileSelector(path)) if i.is_file] if self.overwrite else []
        names = [f for m in messages if m is not None for f in m.files]
        with fs.open_output_stream(f"{path}/{LISTED}{uuid.uuid4().hex}", compression=None) as out:
            out.write("\n".join(names).encode())
        kept = {f"{path}/{n}" for n in names}
        for old in before:
            if old not in kept and (old.endswith(SUFFIXES) or old.rpartition("/")[2].startswith(LISTED)):
                fs.delete_file(old)

    def abort(self, messages: list[Written | None]) -> None:
        fs, path = filesystem(self.path)
        for name in (f for m in messages if m is not None for f in m.files):
            fs.delete_file(f"{path}/{name}")


# ---- reading


class Member:
    """One gzip member of a file: its first bytes are inflated, the rest only if asked for."""

    HEAD = 4096

    def __init__(self, file: io.BufferedReader, start: int) -> None:
        self.file, self.start = file, start
        fixed = file.read(10)
        if len(fixed) < 10 or fixed[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at {start}")
        flags, self.length, skip = fixed[3], 0, b""
        if flags & 4:
            (n,) = struct.unpack("<H", file.read(2))
            extra = file.read(n)
            while len(extra) >= 4:
                name, size = struct.unpack("<2sH", extra[:4])
                if name == b"sl" and size == 8:
                    self.length = struct.unpack("<II", extra[4:12])[0]
                extra = extra[4 + size :]
        for bit in (8, 16):
            while flags & bit and (skip := file.read(1)) not in (b"\0", b""):
                pass
        if flags & 2:
            file.read(2)
        self.inflate = zlib.decompressobj(-15)
        self.data = bytearray()

    def more(self, most: int) -> bool:
        """Inflates up to most further bytes; False at the member's end."""
        if self.inflate.eof:
            return False
        source = self.inflate.unconsumed_tail or self.file.read(65536 if most > self.HEAD else 4096)
        if not source:
            raise ValueError(f"member at {self.start} is cut off")
        self.data += self.inflate.decompress(source, most)
        return True

    def head(self) -> bytes:
        """Up to the blank line after the headers."""
        while (at := self.data.find(b"\r\n\r\n")) < 0 and self.more(self.HEAD):
            pass
        return bytes(self.data[: at + 4])

    def whole(self) -> bytes:
        while self.more(1 << 22):
            pass
        return bytes(self.data)

    def upto(self, n: int) -> bytes:
        while len(self.data) < n and self.more(self.HEAD):
            pass
        return bytes(self.data[:n])

    def end(self) -> int:
        """Where the next member begins: by its length, else by inflating to the end."""
        if self.length:
            return self.start + self.length
        while self.more(1 << 22):
            del self.data[:-4096]
        return self.file.tell() - len(self.inflate.unused_data) + 8


class Plain:
    """One record of a file that is not compressed."""

    def __init__(self, file: io.BufferedReader, start: int) -> None:
        self.file, self.start, self.text, self.size = file, start, b"", 0

    def head(self) -> bytes:
        out = bytearray()
        while line := self.file.readline():
            if out or line.strip():
                out += line
                if line == b"\r\n":
                    break
        self.text = bytes(out)
        self.size = int(fields(self.text).get("content-length", 0)) if out else 0
        self.body = self.file.tell()
        return self.text

    def upto(self, n: int) -> bytes:
        self.file.seek(self.body)
        return self.text + self.file.read(max(0, min(n - len(self.text), self.size)))

    def whole(self) -> bytes:
        return self.upto(len(self.text) + self.size)

    def end(self) -> int:
        return self.body + self.size + 4


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    found = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


def holds(test: Filter, value: str | None) -> bool:
    if isinstance(test, IsNotNull):
        return value is not None
    if value is None:
        return False
    if isinstance(test, EqualTo):
        return value == test.value
    if isinstance(test, In):
        return value in test.value
    if isinstance(test, StringStartsWith):
        return value.startswith(test.value)
    return {GreaterThan: value.encode() > test.value.encode(), GreaterThanOrEqual: value.encode() >= test.value.encode(), LessThan: value.encode() < test.value.encode(), LessThanOrEqual: value.encode() <= test.value.encode()}[type(test)]


@dataclass
class Files(InputPartition):
    files: list[tuple[str, int]]


class WarcReader(DataSourceReader):
    def __init__(self, options, schema) -> None:
        self.path, self.columns = options["path"].rstrip("/"), [f.name for f in schema.fields]
        self.per_partition = int(options.get("partition_bytes", 128 << 20))
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):
        """Takes comparisons of header columns with strings; the others stay with Spark."""
        for test in filters:
            known = isinstance(test, (EqualTo, In, StringStartsWith, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, IsNotNull))
            if known and len(test.attribute) == 1 and test.attribute[0] in HEADERS and (isinstance(test, IsNotNull) or all(isinstance(v, str) for v in (test.value if isinstance(test, In) else [test.value]))):
                self.tests.append(test)
            else:
                yield test

    def partitions(self) -> list[Files]:
        """Files, largest first, each to the emptiest partition. Files that only an unfinished job wrote are left out."""
        fs, path = filesystem(self.path)
        found = [i for i in fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True)) if i.is_file]
        listed = set()
        for info in (i for i in found if i.base_name.startswith(LISTED)):
            with fs.open_input_file(info.path) as file:
                listed.update(f"{info.path.rpartition('/')[0]}/{name}" for name in file.read().decode().split("\n"))
        infos = [i for i in found if i.base_name.endswith(SUFFIXES) and (i.path in listed or not OURS.fullmatch(i.base_name))]
        infos.sort(key=lambda i: (-i.size, i.path))
        n = max(1, min(len(infos), -(-sum(i.size for i in infos) // self.per_partition)))
        plans, sizes = [Files([]) for _ in range(n)], [0] * n
        for info in infos:
            k = sizes.index(min(sizes))
            plans[k].files.append((info.path, info.size))
            sizes[k] += info.size
        return plans

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(self.path)
        shape = pa.schema([(c, {"payload": pa.binary(), "digest_ok": pa.bool_()}.get(c, pa.int64() if c.endswith("_length") else pa.string())) for c in self.columns])
        rows: list[dict] = []
        size = 0
        for path, length in partition.files:
            with fs.open_input_file(path) as raw:
                for row in self.records(io.BufferedReader(raw, 1 << 20), length, path.endswith(".gz")):
                    rows.append(row)
                    size += len(row.get("payload") or b"") + 200
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=shape)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=shape)

    def records(self, file: io.BufferedReader, length: int, packed: bool) -> Iterator[dict]:
        at = 0
        while at < length:
            file.seek(at)
            part = (Member if packed else Plain)(file, at)
            head = part.head()
            if not head.strip():
                return
            found = fields(head)
            row = {c: found.get(name.lower()) for c, name in HEADERS.items()}
            if row["payload_digest"]:
                row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
            if all(holds(t, row[t.attribute[0]]) for t in self.tests):
                self.fill(row, part, head, int(found.get("content-length", 0)), found.get("content-type", ""))
                yield row
            at = part.end()

    def fill(self, row: dict, part, head: bytes, length: int, kind: str) -> None:
        """Adds the columns that lie behind the headers; the payload is inflated only for columns that need it."""
        row["content_length"] = length
        needs_payload = "payload" in self.columns or "digest_ok" in self.columns
        if not needs_payload and "http_length" not in self.columns:
            return
        block = part.whole()[len(head) : len(head) + length] if needs_payload else part.upto(len(head) + min(length, 8192))[len(head) :]
        http, gap, payload = block.partition(b"\r\n\r\n") if kind.startswith("application/http") else (b"", b"", block)
        if gap:
            size = fields(http).get("content-length", "")
            row["http_length"] = int(size) if size.isdigit() else None
        if needs_payload and row["record_type"] != "revisit":
            row["payload"] = payload
            row["digest_ok"] = row["payload_digest"] == sha1_base32(payload) if row["payload_digest"] else None


class WarcDataSource(DataSource):
    """format("warc"). Options: path; for reading partition_bytes; for writing level and max_file_bytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes format("warc") known and lets its filters be pushed down (settings of the session, which stay)."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of binary data: 5 hexadecimal digits at a time are 4 digits to base 32."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def page_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages (page_id, url, html) as records to write: one per row.

    Of the pages with equal payloads of at least least_bytes, the one with the
    largest page_id is the response and the others revisit it; shorter ones are
    all responses. Null html is an empty payload. Rows that share the largest
    page_id of their payload are all responses; a null page_id counts as the
    smallest and has record id urn:page:.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    digest = base32_sha1(payload)
    keep = pages.select("page_id", digest.alias("d"), F.length(payload).alias("n")).where(F.col("n") >= least_bytes)
    keep = keep.groupBy("d").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("many")).where("many > 1")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    rows = pages.select("page_id", "url", payload.alias("payload"), digest.alias("digest")).join(keep, F.col("digest") == F.col("d"), "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn("page_id").alias("record_id"), F.lit("2024-01-01T00:00:00Z").alias("date"), F.col("url").alias("target_uri"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"), F.when(revisit, urn("keeper")).alias("refers_to"), F.length("payload").cast("bigint").alias("http_length"), F.when(~revisit, F.col("payload")).alias("payload"),
    )


def archive_pages(pages: DataFrame, path: str, least_bytes: int = 0, level: int = 6) -> None:
    """Adds pages to the archive at path. Batches are bounded in bytes; a task holds one payload a few times over."""
    register(pages.sparkSession)
    small_batches(pages.sparkSession)
    page_records(pages, least_bytes).write.format("warc").option("level", level).mode("append").save(path)


def read_records(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    register(spark)
    return spark.read.format("warc").schema(columns).load(path)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages, written as archives and read back: page_id, payload_bytes, payload_digest, record_type, refers_to, digest_ok.

    Responses are read with their payloads, from which length and digest are
    taken; revisits by their headers alone. Null html counts as empty; repeated
    rows each have their record; an empty table gives an empty result; columns
    other than page_id, url and html are not read. A payload may be of any
    length that a task can hold a few times over. The archives lie below
    spark.checkpoint.dir, which may be a local folder or an object store that
    pyarrow reaches too (s3a, abfs, wasb, gs and hdfs paths).
    """
    spark, path = pages.sparkSession, scratch(pages.sparkSession, "warc")
    archive_pages(pages, path, least_bytes)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")
    responses = read_records(spark, path, "record_type string, record_id string, payload binary, digest_ok boolean").where("record_type = 'response'")
    responses = responses.select(page("record_id").alias("page_id"), F.length("payload").cast("bigint").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"), "record_type", F.lit(None).cast("bigint").alias("refers_to"), "digest_ok")
    revisits = read_records(spark, path, "record_type string, record_id string, payload_digest string, refers_to string, http_length bigint").where("record_type = 'revisit'")
    revisits = revisits.select(page("record_id").alias("page_id"), F.col("http_length").alias("payload_bytes"), "payload_digest", "record_type", page("refers_to").alias("refers_to"), F.lit(None).cast("boolean").alias("digest_ok"))
    return responses.unionByName(revisits)
