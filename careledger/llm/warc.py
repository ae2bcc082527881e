"""Operator 1, WARC archives as a PySpark Python data source.

Writing: every task writes its records to own files in the target folder (a new
file after ``fileBytes`` of records); each record is a gzip member of its own
unless ``compression`` is ``none``.  The commit writes a manifest that lists the
files of successful tasks, so files that a lost executor or a repeated task left
behind are never read.

Reading: the manifest (or, for foreign archives, the folder's ``*.warc`` and
``*.warc.gz``) is planned into partitions of about ``partitionBytes``.  A task
parses the headers of a record first and tests the pushed predicates on them
(record type and every other header column); the payload of a record that fails,
or whose payload the read schema does not ask for, is skipped and not decoded.

Columns: record_id, record_type, target_uri, date, content_type, payload_digest,
refers_to, payload_bytes (of the full payload, from the HTTP header), payload
(null for a revisit, which stores HTTP headers only).

Defined results: a null payload is written as an empty one; a null header value
is not written and reads as null; control characters and blanks in a target URI
are percent-encoded; an empty table gives an archive without files, which reads
as no rows.  A record cut off at a file's end raises.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter,
                                    In, InputPartition, IsNotNull, IsNull, Not, StringContains, StringEndsWith,
                                    StringStartsWith, WriterCommitMessage)
from pyspark.sql.types import StructType

from careledger.llm.common import attach_group, shared_path

SCHEMA = ("record_id string, record_type string, target_uri string, date string, content_type string, "
          "payload_digest string, refers_to string, payload_bytes bigint, payload binary")
#: Fixed values of the WARC 1.1 format.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
           "date": "WARC-Date", "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest",
           "refers_to": "WARC-Refers-To"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest.json"


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- writing

def _record(row: dict) -> bytes:
    """The bytes of one record, without compression."""
    kind, payload = row["record_type"], row["payload"] or b""
    full = row.get("payload_bytes")
    http = kind in ("response", "revisit")
    block = payload
    if http:
        block = (f"HTTP/1.1 200 OK\r\nContent-Type: {row.get('content_type') or 'text/html; charset=utf-8'}\r\n"
                 f"Content-Length: {len(payload) if full is None else full}\r\n\r\n").encode() + (
            payload if kind == "response" else b"")
    head = ["WARC/1.1"]
    for name, header in HEADERS.items():
        value = row.get(name)
        if name == "target_uri" and value is not None:
            value = quote(value, safe="".join(map(chr, range(33, 127))), encoding="utf-8")
        if name == "content_type":
            value = "application/http; msgtype=response" if http else value or "application/octet-stream"
        if value is not None:
            head.append(f"{header}: {value}")
    if kind == "revisit":
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class _Files(WriterCommitMessage):
    files: list[tuple[str, int]] = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.zipped = options.get("compression", "gzip") != "none"
        self.most = int(options.get("filebytes", 64 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _file_system(self.path)
        done = _Files()
        out, written, name = None, 0, ""
        try:
            for batch in iterator:
                for at in range(0, batch.num_rows, 64):        # few rows as Python objects at a time
                    for row in batch.slice(at, 64).to_pylist():
                        data = _record(row)
                        data = gzip.compress(data, 1, mtime=0) if self.zipped else data
                        if out is None:
                            fs.create_dir(root, recursive=True)
                            name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.zipped
                            out, written = fs.open_output_stream(f"{root}/{name}", compression=None), 0
                        out.write(data)
                        written += len(data)
                        if written >= self.most:
                            out.close()
                            done.files.append((name, written))
                            out = None
        finally:
            if out is not None:
                out.close()
        if out is not None:
            done.files.append((name, written))
        return done

    def commit(self, messages: list) -> None:
        fs, root = _file_system(self.path)
        fs.create_dir(root, recursive=True)
        files = sorted(f for m in messages if m is not None for f in m.files)
        with fs.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())


# ---------------------------------------------------------------- reading

@dataclass
class _FileGroup(InputPartition):
    files: list[str]


#: Predicates that a record's headers can decide, with their test.
_TESTS = {
    EqualTo: lambda f, v: v is not None and v == f.value,
    EqualNullSafe: lambda f, v: v == f.value,
    In: lambda f, v: v is not None and v in f.value,
    IsNull: lambda f, v: v is None,
    IsNotNull: lambda f, v: v is not None,
    StringStartsWith: lambda f, v: v is not None and v.startswith(f.value),
    StringEndsWith: lambda f, v: v is not None and v.endswith(f.value),
    StringContains: lambda f, v: v is not None and f.value in v,
}


def _decidable(f: Filter) -> bool:
    return type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in HEADERS and f.attribute[0] != "content_type"


def _passes(f: Filter, row: dict) -> bool:
    if isinstance(f, Not):
        value = row.get(f.child.attribute[0])
        return (value is not None or isinstance(f.child, (IsNull, IsNotNull, EqualNullSafe))) \
            and not _TESTS[type(f.child)](f.child, value)
    return _TESTS[type(f)](f, row.get(f.attribute[0]))


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.path, self.columns = options["path"], schema.names
        self.most = int(options.get("partitionbytes", 32 << 20))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if _decidable(f) or isinstance(f, Not) and _decidable(f.child):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = _file_system(self.path)
        if fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.File:
            with fs.open_input_stream(f"{root}/{MANIFEST}") as lines:
                files = [(f"{root}/{name}", size) for name, size in json.loads(lines.read())]
        else:
            info = fs.get_file_info(pafs.FileSelector(root, recursive=True))
            files = [(i.path, i.size) for i in info if i.path.endswith((".warc", ".warc.gz"))]
        groups, size = [], self.most
        for name, n in sorted(files):
            if size + n > self.most and size:
                groups.append(_FileGroup([]))
                size = 0
            groups[-1].files.append(name)
            size += n
        return groups or [_FileGroup([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fs, _ = _file_system(self.path)
        for name in partition.files:
            with fs.open_input_file(name) as raw:
                stream = gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else io.BufferedReader(raw, 1 << 20)
                yield from self._records(stream, name)

    def _records(self, stream, name: str) -> Iterator[tuple]:
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{name}: no record where one should begin")
            head = _headers(stream)
            row = {k: head.get(h.lower()) for k, h in HEADERS.items()}
            left = int(head.get("content-length", 0))
            if all(_passes(f, row) for f in self.filters):
                left = self._block(stream, head, row, left, name)
                yield tuple(row.get(c) for c in self.columns)
            _skip(stream, left, name)

    def _block(self, stream, head: dict, row: dict, left: int, name: str) -> int:
        """Fill in what the schema asks of the block; returns the bytes that are still unread."""
        row["payload_bytes"], row["payload"] = left, None
        if not {"payload", "payload_bytes", "content_type"} & set(self.columns):
            return left
        if (head.get("content-type") or "").startswith("application/http"):
            before = _Counted(stream)
            before.readline()
            http = _headers(before)
            left -= before.count
            row["content_type"] = http.get("content-type")
            row["payload_bytes"] = int(http.get("content-length", left))
        if "payload" in self.columns and row["record_type"] != "revisit":
            row["payload"] = stream.read(left)
            if len(row["payload"]) < left:
                raise ValueError(f"{name}: a record is cut off")
            left = 0
        return left


class _Counted:
    def __init__(self, stream):
        self.stream, self.count = stream, 0

    def readline(self) -> bytes:
        line = self.stream.readline()
        self.count += len(line)
        return line


def _headers(stream) -> dict[str, str]:
    """Header lines up to the blank one, names in lower case (a folded line continues the one before)."""
    out: dict[str, str] = {}
    last = ""
    while (line := stream.readline().rstrip(b"\r\n")):
        text = line.decode("utf-8", "replace")
        if text[0] in " \t" and last:
            out[last] += " " + text.strip()
            continue
        last, _, value = text.partition(":")
        last = last.strip().lower()
        out[last] = value.strip()
    return out


def _skip(stream, left: int, name: str) -> None:
    if not left:
        return
    if isinstance(stream, io.BufferedReader):
        stream.seek(left, io.SEEK_CUR)
        return
    while left:
        got = len(stream.read(min(left, 1 << 20)))
        if not got:
            raise ValueError(f"{name}: a record is cut off")
        left -= got


class WarcDataSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")`` once registered."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_warc(records: DataFrame, path: str, **options: str) -> None:
    """Write ``records`` (columns of ``SCHEMA``; others are ignored) as archives under ``path``, a new folder."""
    register(records.sparkSession)
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    records.select(*[c for c in names if c in records.columns]).write.format("warc").mode("append").options(
        **options).save(path)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None, **options: str) -> DataFrame:
    """The records under ``path``; only what ``columns`` asks for is decoded."""
    register(spark)
    kinds = dict(f.split() for f in SCHEMA.split(", "))
    return spark.read.format("warc").schema(", ".join(f"{c} {kinds[c]}" for c in columns or kinds)).options(
        **options).load(path)


# ---------------------------------------------------------------- pages

def page_records(pages: DataFrame, least: int = 100, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Records of ``pages``: of equal payloads of ``least`` bytes or more the smallest page_id is the
    response, the others revisit it.

    A record's id names page and payload digest.  Defined results: null html is the empty payload; a null
    page_id counts after all others; rows that repeat page_id and payload of a response are responses too.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", F.col("url").alias("target_uri"), payload.alias("payload")).withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    rows = attach_group(rows, ["payload_digest"], ["page_id"], {"first": ("min", F.min("page_id"))})
    revisit = (F.col("payload_bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    record_id = lambda page: F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")),
                                      F.lit(":sha256:"), F.col("payload_digest"), F.lit(">"))
    return rows.select(
        record_id(F.col("page_id")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.lit(date).alias("date"), F.lit("text/html; charset=utf-8").alias("content_type"),
        F.concat(F.lit("sha256:"), "payload_digest").alias("payload_digest"),
        F.when(revisit, record_id(F.col("first"))).alias("refers_to"), "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"))


def page_of(record_id: str) -> Column:
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+):", 1).try_cast("long")


def archive_report(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives, read them back: responses with their payload, revisits by their headers."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_warc(page_records(pages), path)
    responses = read_warc(spark, path).where(F.col("record_type") == "response").select(
        "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", "refers_to")
    revisits = read_warc(spark, path, ["record_id", "record_type", "payload_digest", "refers_to", "payload_bytes"]) \
        .where(F.col("record_type") == "revisit").select(
        "record_id", "payload_bytes", F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        "record_type", "refers_to")
    return responses.unionByName(revisits).select(
        page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_of("refers_to").alias("refers_to"))
