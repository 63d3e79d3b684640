"""WARC archives as a PySpark data source, and pages written to them with revisit records.

Reading: one task takes files up to a size bound; predicates on record type and headers
are pushed into the reader, which parses headers first and steps over the
blocks of records that are filtered out or whose payload is not asked for.

Writing: each task writes files of its own, of bounded size, under names no other
attempt uses; only the files of committed tasks get into the manifest.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from .common import scratch, stage

#: The format's version line, the revisit profile, and the header name of each column.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "record_date": "WARC-Date",
    "content_type": "Content-Type",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
}
SCHEMA = ", ".join(f"{c} {'long' if c == 'payload_length' else 'string'}" for c in HEADERS) + ", payload binary"

MANIFEST = "_manifest"  # and a name of the job's own, .json
FILE_BYTES = 64 << 20
PARTITION_BYTES = 128 << 20
BATCH_BYTES = 8 << 20

#: From this payload size on, equal payloads are kept once.
LEAST_REVISIT = 100


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)


# ---------------------------------------------------------------- records


def record_bytes(row: dict) -> bytes:
    """One record. Control characters in header values are percent-encoded; a revisit holds the HTTP head only."""
    payload = row.get("payload") or b""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = head if row["record_type"] == "revisit" else head + payload
    values = {**row, "record_date": row.get("record_date") or "1970-01-01T00:00:00Z", "content_type": "application/http; msgtype=response"}
    lines = [VERSION]
    for column, name in HEADERS.items():
        if values.get(column) is not None:
            lines.append(f"{name}: {_one_line(str(values[column]))}")
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


class _Plain:
    """Sequential reading of an uncompressed archive with seeks over what is not wanted."""

    def __init__(self, stream):
        self.stream, self.size, self.at = stream, stream.size(), 0
        self.buffer, self.start = b"", 0

    def _fill(self, n: int) -> bytes:
        """At least ``n`` bytes from the present place, as far as the file goes."""
        have = self.start + len(self.buffer) - self.at
        if not (self.start <= self.at and have >= n):
            self.buffer = self.stream.read_at(min(max(n, 1 << 16), self.size - self.at), self.at) if self.at < self.size else b""
            self.start = self.at
        return self.buffer[self.at - self.start :]

    def head(self) -> bytes | None:
        """Everything up to the blank line of the next record, or None at the end."""
        n = 1 << 12
        while True:
            got = self._fill(n)
            cut = got.find(b"\r\n\r\n")
            if cut >= 0:
                self.at += cut + 4
                return got[:cut]
            if len(got) < n:
                if got.strip():
                    raise ValueError("archive ends inside a record header")
                return None
            n *= 4

    def block(self, n: int) -> bytes:
        got = self._fill(n)[:n]
        if len(got) < n:
            raise ValueError("archive ends inside a record block")
        self.at += n + 4
        return got

    def skip(self, n: int) -> None:
        self.at += n + 4


class _Gzip(_Plain):
    """The same over one gzip member a record: blocks not wanted are inflated away, never decoded."""

    def __init__(self, stream):
        self.stream, self.inflate, self.held = stream, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(31)
        raw = raw or self.stream.read(1 << 16)
        if not raw:
            return False
        self.held += self.inflate.decompress(raw, 1 << 20)
        return True

    def _fill(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        return self.held

    def head(self) -> bytes | None:
        while (cut := self.held.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.held.strip():
                    raise ValueError("archive ends inside a record header")
                return None
        got, self.held = self.held[:cut], self.held[cut + 4 :]
        return got

    def block(self, n: int) -> bytes:
        got = self._fill(n + 4)[:n]
        if len(got) < n:
            raise ValueError("archive ends inside a record block")
        self.held = self.held[n + 4 :]
        return got

    def skip(self, n: int) -> None:
        left = n + 4
        while left and (self.held or self._more()):
            taken = min(left, len(self.held))
            self.held, left = self.held[taken:], left - taken


def parse_head(head: bytes) -> dict[str, str]:
    """Header names in lower case to values; the version line under ''."""
    lines = head.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    found = {"": lines[0]}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        found[name.strip().lower()] = value.strip()
    return found


# ---------------------------------------------------------------- reading

_TESTS = {
    EqualTo: lambda value, x: value == x,
    GreaterThan: lambda value, x: value > x,
    GreaterThanOrEqual: lambda value, x: value >= x,
    LessThan: lambda value, x: value < x,
    LessThanOrEqual: lambda value, x: value <= x,
    In: lambda value, x: value in x,
    StringStartsWith: lambda value, x: value.startswith(x),
    StringEndsWith: lambda value, x: value.endswith(x),
    StringContains: lambda value, x: x in value,
}


def folder_entries(fs, root: str) -> list:
    info = fs.get_file_info(root)
    return fs.get_file_info(pafs.FileSelector(root)) if info.type == pafs.FileType.Directory else [info]


def manifests(entries: list) -> list[str]:
    return [i.path for i in entries if i.path.rsplit("/", 1)[-1].startswith(MANIFEST) and i.path.endswith(".json")]


def listed_files(fs, root: str) -> list[tuple[str, int]]:
    """``(path, size)`` of the archives that the manifests of all jobs list, or of all archives where no manifest is."""
    entries = folder_entries(fs, root)
    if not (names := manifests(entries)):
        return sorted((i.path, i.size) for i in entries if i.path.endswith((".warc", ".warc.gz")))
    files = {}
    for name in names:
        with fs.open_input_stream(name) as f:
            files.update({f"{root}/{n}": size for n, size in json.loads(f.read())})
    return sorted(files.items())


@dataclass
class WarcPartition(InputPartition):
    files: list = field(default_factory=list)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path = options["path"]
        self.most = int(options.get("partitionBytes", PARTITION_BYTES))
        self.columns = schema.fieldNames()
        self.kinds = {f.name: pa.int64() if f.name == "payload_length" else pa.binary() if f.name == "payload" else pa.string() for f in schema.fields}
        self.filters: list[tuple] = []

    def pushFilters(self, filters):
        """Comparisons of header columns are taken over, everything else is left to Spark."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in HEADERS and (type(f) in _TESTS or isinstance(f, IsNotNull)):
                self.filters.append((name, type(f).__name__, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[WarcPartition]:
        fs, root = file_system(self.path)
        files = listed_files(fs, root)
        out, held = [], 0
        for path, size in files:
            if not out or held + size > self.most:
                out.append(WarcPartition([]))
                held = 0
            out[-1].files.append(path)
            held += size
        return out or [WarcPartition([])]

    def _wanted(self, values: dict) -> bool:
        tests = {k.__name__: t for k, t in _TESTS.items()}
        return all(
            values[name] is not None and (kind == "IsNotNull" or tests[kind](values[name], x)) for name, kind, x in self.filters
        )

    def read(self, partition: WarcPartition) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        schema = pa.schema([(c, self.kinds[c]) for c in self.columns])
        for path in partition.files:
            packed = path.endswith(".gz")
            with (fs.open_input_stream(path, compression=None) if packed else fs.open_input_file(path)) as stream:
                source = _Gzip(stream) if packed else _Plain(stream)
                rows, held = [], 0
                while (head := source.head()) is not None:
                    headers = parse_head(head)
                    length = int(headers["content-length"])
                    values = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
                    values["payload_length"] = int(values["payload_length"]) if values["payload_length"] else None
                    if not self._wanted(values):
                        source.skip(length)
                        continue
                    if "payload" in self.columns and values["record_type"] != "revisit":
                        block = source.block(length)
                        if (values["content_type"] or "").startswith("application/http"):
                            block = block.partition(b"\r\n\r\n")[2]
                        values["payload"] = block
                        held += len(block)
                    else:
                        source.skip(length)
                    rows.append([values.get(c) for c in self.columns])
                    if held >= BATCH_BYTES or len(rows) >= 5000:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


# ---------------------------------------------------------------- writing


@dataclass
class WarcFiles(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceWriter):
    """Each job lists its files in a manifest of its own; an overwrite removes the manifests of the jobs before.

    Archives that lay in the folder without any manifest are listed along, so that they stay in sight.
    """

    def __init__(self, options: dict, overwrite: bool = False):
        self.path = options["path"]
        self.overwrite = overwrite
        fs, root = file_system(self.path)
        self.older = manifests(folder_entries(fs, root))
        self.lying = [] if overwrite or self.older else [[path.rsplit("/", 1)[-1], size] for path, size in listed_files(fs, root)]
        self.gzip = options.get("compression", "none") == "gzip"
        self.most = int(options.get("fileBytes", FILE_BYTES))

    def write(self, iterator) -> WarcFiles:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        files, stream, size = [], None, 0
        for row in iterator:
            data = record_bytes(row.asDict())
            if self.gzip:
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = pack.compress(data) + pack.flush()
            if stream is None:
                files.append([f"part-{uuid.uuid4().hex}.warc" + (".gz" if self.gzip else ""), 0])
                stream, size = fs.open_output_stream(f"{root}/{files[-1][0]}", compression=None), 0
            stream.write(data)
            size += len(data)
            files[-1][1] = size
            if size >= self.most:
                stream.close()
                stream = None
        if stream is not None:
            stream.close()
        return WarcFiles(files)

    def commit(self, messages) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        files = sorted(self.lying + [f for m in messages if m is not None for f in m.files])
        with fs.open_output_stream(f"{root}/{MANIFEST}-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())
        for name in self.older if self.overwrite else []:
            fs.delete_file(name)

    def abort(self, messages) -> None:
        fs, root = file_system(self.path)
        for message in messages:
            for name, _ in message.files if message is not None else []:
                fs.delete_file(f"{root}/{name}")


class WarcDataSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``; options path, compression, fileBytes, partitionBytes.

    A schema given to the reader selects columns; without ``payload`` no block is read.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None, **options: str) -> DataFrame:
    """The records under ``path``; only ``columns`` are read."""
    register(spark)
    reader = spark.read.format("warc").options(**options)
    if columns:
        kinds = dict(x.rsplit(" ", 1) for x in SCHEMA.split(", "))
        reader = reader.schema(", ".join(f"{c} {kinds[c]}" for c in columns))
    return reader.load(path)


def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """One record a page. Equal payloads of ``least`` bytes or more are kept once, by the smallest page_id.

    A null html is an empty payload, a null url leaves the header out. Rows
    that repeat the smallest id are all responses; rows without an id
    revisit a page that has one, and are responses where no page with that payload has.
    """
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page"), F.col(url).alias("target_uri"), body.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    size = F.octet_length("payload").cast("long")
    first = (
        rows.where(size >= least).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null").select("digest", "first")
    )
    first = stage(first, "warc-first")
    joined = rows.join(first, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    return joined.select(
        urn("page").alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit(None).cast("string").alias("record_date"),
        F.lit(None).cast("string").alias("content_type"),
        F.when(again, urn("first")).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        size.alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, compression: str = "none", **names: str) -> None:
    register(pages.sparkSession)
    page_records(pages, **names).write.format("warc").option("compression", compression).mode("append").save(path)


def page_summary(spark: SparkSession, path: str) -> DataFrame:
    """Per record page_id, payload_bytes, payload_digest, record_type, refers_to, and whether the stored payload has the stated digest.

    Responses are measured on the payload read back; revisits carry the length and digest of the page they refer to.
    """
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(-?[0-9]+)>', 1) as long)")
    full = read_warc(spark, path, ["record_id", "record_type", "payload_digest", "payload"]).where("record_type = 'response'")
    light = read_warc(spark, path, ["record_id", "record_type", "refers_to", "payload_digest", "payload_length"]).where("record_type = 'revisit'")
    stated = F.substring_index("payload_digest", ":", -1)
    responses = full.select(
        page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"), (F.sha2("payload", 256) == stated).alias("digest_ok"),
    )
    revisits = light.select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), stated.alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"), F.lit(True).alias("digest_ok"),
    )
    return responses.unionByName(revisits)


def warc_query(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return page_summary(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
with p as (select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as n from pages),
f as (select page_id, cast(n as bigint) as payload_bytes, sha256(body) as payload_digest,
             case when n >= 100 then min(page_id) over (partition by body) else page_id end as first
      from p)
select page_id, payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from f
"""
