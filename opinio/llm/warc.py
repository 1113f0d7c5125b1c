"""WARC archives (11): a deterministic sharded writer and a reader.

Records are range-sorted by their payload's SHA-256, then by descending id, so that
equal payloads stand together; each task writes the records of its range, one gzip
member each, to files that it rolls by compressed size.  Headers and digests are
made anew from the payload.  Of records with equal payloads of ``least`` bytes or
more, that with the largest id is the response and the others are revisits, which
hold the HTTP header alone.  The ``HOT`` most frequent payloads are broadcast with
the id of their response and their records dealt over ranges by a hash of the id, and
those without the largest id travel without their payload; any other group has less
than one in ``HOT`` records and stays in one range, where its first record is the
response.

Files are written under temporary names, one folder per task attempt.  The rows that
describe them are staged by Spark's own commit, so one attempt of each task counts; a
second job gives its files their names (a repeated move finds them in place), and the
manifest, written last, is what readers go by.  ``commit`` finishes a write that was
interrupted after staging.  The records, and their bytes, depend on the rows alone;
how they are dealt over files depends on the ranges too.

Defined cases: a null payload is the empty one; a null id has no row-id header and
ranks below all others; a null url has no target header, white space and control
characters in it are percent-encoded.  Repeated rows each have a record (of equal
ones the first is the response).  Of an empty table the manifest is empty.  A very
long payload is a record of its own, held once in memory by its task, and may exceed
the size of a file.  Only the three named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.sources.storage import file_system

#: Payloads whose records are dealt over several ranges, and over how many.
HOT, SPREAD = 1024, 256
#: Compressed bytes after which a file is closed.
FILE_BYTES = 256 << 20
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("8c9f6a0e-3f0b-5d0e-9a55-6f1d3f6f2b11")
_STAGED = "name string, temporary string, records bigint, bytes bigint, sha1 string"


class NotCommitted(RuntimeError):
    """The folder holds no archives whose manifest is complete."""


def digest_field(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _fields(pairs: list[tuple[str, str | None]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs if v is not None).encode()


def _escaped(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\x00-\x20\x7f-\xa0  ]", lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), url)


def record_id(row: str | None, payload_sha1: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{row} {payload_sha1} {copy}')}>"


def record(kind: str, row: str | None, copy: int, url: str | None, size: int, payload_sha1: str, payload: bytes | None, refers_to: str | None, date: str) -> bytes:
    """The bytes of one record; a revisit's payload is left out."""
    block = b"HTTP/1.1 200 OK\r\n" + _fields([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))]) + b"\r\n"
    revisit = kind == "revisit"
    if not revisit:
        block += payload
    head = _fields([
        ("WARC-Type", kind), ("WARC-Record-ID", record_id(row, payload_sha1, copy)), ("WARC-Date", date), ("WARC-Target-URI", _escaped(url)),
        ("WARC-Payload-Digest", digest_field(payload_sha1)), ("WARC-Block-Digest", digest_field(hashlib.sha1(block).hexdigest())),
        ("WARC-Profile", PROFILE if revisit else None), ("WARC-Refers-To", record_id(refers_to, payload_sha1, 0) if revisit else None),
        ("X-Row-ID", row), ("X-Refers-To-Row-ID", refers_to if revisit else None),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block))),
    ])
    return VERSION.encode() + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _info(name: str, date: str) -> bytes:
    body = _fields([("format", "WARC File Format 1.1")])
    unique = f"<urn:uuid:{uuid.uuid5(_NAMES, name)}>"
    head = _fields([("WARC-Type", "warcinfo"), ("WARC-Record-ID", unique), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(body)))])
    return VERSION.encode() + b"\r\n" + head + b"\r\n" + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without a time in its header."""
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder there, as a task sees them."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


class _Files:
    """The files of one task attempt, rolled by compressed size."""

    def __init__(self, path: str, prefix: str, part: int, most: int, date: str):
        self.storage, self.root = storage(path)
        self.folder = f"_temporary/{part}-{uuid.uuid4().hex}"
        self.prefix, self.part, self.most, self.date, self.out = prefix, part, most, date, None
        self.rows: list[tuple] = []

    def add(self, data: bytes) -> None:
        data = member(data)
        if self.out and self.records and self.size + len(data) > self.most:
            self.close()
        if not self.out:
            self.name = f"{self.prefix}-{self.part:05d}-{len(self.rows):05d}.warc.gz"
            self.storage.create_dir(f"{self.root}/{self.folder}", recursive=True)
            self.out = self.storage.open_output_stream(f"{self.root}/{self.folder}/{self.name}", compression=None)
            self.size, self.records, self.sha1 = 0, 0, hashlib.sha1()
            self._write(member(_info(self.name, self.date)))
        self._write(data)
        self.records += 1

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)
        self.sha1.update(data)

    def close(self) -> None:
        if self.out:
            self.out.close()
            self.rows.append((self.name, f"{self.folder}/{self.name}", self.records, self.size, self.sha1.hexdigest()))
            self.out = None


def _write(path: str, prefix: str, most: int, least: int, date: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files = _Files(path, prefix, TaskContext.get().partitionId(), most, date)
    before = lead = None
    for batch in batches:
        for key, row, leader, hot, url, size, sha1, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (key, row) == before:
                copy += 1  # noqa: F821 - set by the first row
            else:
                copy = 0
            if before is None or key != before[0]:
                lead = row
            before = key, row
            first = leader if hot else lead
            revisit = size >= least and (row != first or copy > 0)
            files.add(record("revisit" if revisit else "response", row, copy, url, size, sha1, payload, first if revisit else None, date))
    files.close()
    columns = list(zip(*files.rows, strict=True)) or [()] * 5
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["name", "temporary", "records", "bytes", "sha1"])


def _move(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    store, root = storage(path)
    for batch in batches:
        for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist(), strict=True):
            old, new = store.get_file_info([f"{root}/{temporary}", f"{root}/{name}"])
            if old.type == fs.FileType.File:
                store.move(old.path, new.path)
            elif new.type != fs.FileType.File:
                raise FileNotFoundError(f"neither {temporary} nor {name} is in {path}")
        yield batch


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 1000,
    prefix: str = "part", file_bytes: int = FILE_BYTES, date: str = "1970-01-01T00:00:00Z", hot: int = HOT,
) -> DataFrame:
    """Writes a record per row of ``pages`` (payload: the text in UTF-8) under ``path``, a folder that driver and
    executors share; returns the manifest (name, records, bytes, sha1)."""
    spark = pages.sparkSession
    payload = F.coalesce(pages[payload_col], F.lit("")).cast("binary")
    own = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), payload.alias("payload")).withColumn("key", F.unhex(F.sha2("payload", 256)))
    long = own.where(F.octet_length("payload") >= least)
    groups = long.groupBy("key").agg(F.max(F.struct("id")).alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    most = groups.orderBy(F.col("n").desc(), "key").limit(hot).select("key", F.col("leader.id").alias("leader"), F.lit(True).alias("hot"))
    own = own.join(F.broadcast(most), "key", "left")
    other = F.col("hot") & ~F.col("id").eqNullSafe(F.col("leader"))
    rows = own.select(
        "key", F.col("id").cast("string").alias("row"), F.col("leader").cast("string").alias("leader"), F.coalesce("hot", F.lit(False)).alias("hot"), "url",
        F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("sha1"), F.when(other, F.lit(None)).otherwise(F.col("payload")).alias("payload"),
        "id", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SPREAD))).otherwise(F.lit(0)).alias("part"),
    )
    order = ["key", "part", F.col("id").desc_nulls_last(), F.col("url").asc_nulls_first()]
    ranged = rows.repartitionByRange("key", "part").sortWithinPartitions(*order).drop("id", "part")
    staged = ranged.mapInArrow(partial(_write, path, prefix, file_bytes, least, date), _STAGED)
    staged.write.parquet(f"{path}/_staged")
    return commit(spark, path)


def commit(spark: SparkSession, path: str) -> DataFrame:
    """Gives staged files their names and writes the manifest; returns it.  May be repeated."""
    store, root = file_system(spark, path)
    there = lambda name: store.exists(root.suffix(f"/{name}/_SUCCESS"))
    if not there("_manifest"):
        if not there("_staged"):
            raise NotCommitted(path)
        staged = spark.read.schema(_STAGED).parquet(f"{path}/_staged")
        staged.mapInArrow(partial(_move, path), _STAGED).drop("temporary").write.mode("overwrite").parquet(f"{path}/_manifest")
        store.delete(root.suffix("/_temporary"), True)
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    store, root = file_system(spark, path)
    if not store.exists(root.suffix("/_manifest/_SUCCESS")):
        raise NotCommitted(path)
    return spark.read.schema("name string, records bigint, bytes bigint, sha1 string").parquet(f"{path}/_manifest")


def members(stream, size: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member."""
    data, offset = stream.read(size), 0
    while data:
        inflate, parts, used = zlib.decompressobj(31), [], 0
        while not inflate.eof:
            if not data:
                raise EOFError("an archive ends inside a member")
            parts.append(inflate.decompress(data))
            used += len(data) - len(inflate.unused_data)
            data = inflate.unused_data or (b"" if inflate.eof else stream.read(size))
        yield offset, b"".join(parts)
        offset += used
        data = data or stream.read(size)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:20]!r}")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    n = int(fields["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is not its header's")
    return fields, rest[:n]


_RECORD = (
    "file string, offset bigint, record_type string, record_id string, refers_to_id string, row_id string, refers_to_row_id string, url string, "
    "payload_bytes bigint, payload_digest string, digests_hold boolean, payload binary"
)


def _read(path: str, wanted: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    store, root = storage(path)
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    names = [f.split()[0] for f in _RECORD.split(", ")]
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    for batch in batches:
        for name in batch.column("name").to_pylist():
            rows, held = [], 0
            with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                for offset, data in members(stream):
                    f, block = parse(data)
                    if f["warc-type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"(?mi)^content-length: *(\d+)", http).group(1))
                    digest = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
                    revisit = f["warc-type"] == "revisit"
                    holds = f["warc-block-digest"] == digest_field(hashlib.sha1(block).hexdigest())
                    holds = holds and (revisit or hashlib.sha1(payload).hexdigest() == digest and len(payload) == size)
                    rows.append((name, offset, f["warc-type"], f["warc-record-id"], f.get("warc-refers-to"), f.get("x-row-id"), f.get("x-refers-to-row-id"),
                                 f.get("warc-target-uri"), size, digest, holds, payload if wanted and not revisit else None))
                    held += len(payload) if wanted else 100
                    if held > 1 << 23 or len(rows) >= 10_000:
                        yield pack(rows)
                        rows, held = [], 0
            if rows:
                yield pack(rows)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the committed files: its place, header fields, digest (lower-case hex), whether the digests
    hold, and the payload (null for revisits)."""
    files = manifest(spark, path)
    n = files.count()
    # one file at a time in each task
    return files.select("name").repartition(max(min(n, 50_000), 1)).mapInArrow(partial(_read, path, payloads), _RECORD)
