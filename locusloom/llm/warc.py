"""WARC archives as a Python data source, and pages archived with revisits.

Reading plans whole files into partitions by size and takes over predicates on header columns
(``record_type``, ``record_id``, ``target_uri``, ``refers_to``, ``payload_digest``). A record's
headers are parsed first; unless they pass, its block is skipped by its length and never read,
split or decoded. Writing puts one file per task; a manifest written at commit names the files
of the tasks that counted, so what lost or repeated attempts left behind is not read.

Files are opened with ``pyarrow.fs``, so any folder that executors share serves. Filters reach
the source with ``spark.sql.python.filterPushdown.enabled``, which :func:`register` sets.
"""

from __future__ import annotations

import gzip
import io
import json
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)

PARTITION_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
LEAST_REVISIT = 100
MANIFEST = "_files.json"
SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
    "payload_length long, payload binary"
)
#: Column, header field; the fields and the profile are fixed values of the format, the last one an extension.
FIELDS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "payload_length": "warc-x-payload-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARROW = pa.schema(
    [(c, pa.string()) for c in ("record_type", "record_id", "target_uri", "refers_to", "payload_digest")]
    + [("payload_length", pa.int64()), ("payload", pa.binary())]
)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def parse_headers(stream) -> dict[str, str] | None:
    """Header fields of the next record, by lower-case name; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):  # the two line ends after a block
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    fields: dict[str, str] = {}
    name = ""
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and name:  # a folded line
            fields[name] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def decode_block(fields: dict[str, str], block: bytes) -> bytes:
    """Payload of a block: the entity of an HTTP message, decoded, or else the block."""
    if not fields.get("content-type", "").startswith("application/http"):
        return block
    head, _, body = block.partition(b"\r\n\r\n")
    coding = [line.split(b":", 1)[1].strip().lower() for line in head.split(b"\r\n") if line.lower().startswith(b"content-encoding:")]
    return zlib.decompress(body, 47) if coding and coding[0] in (b"gzip", b"deflate") else body


def _column_value(fields: dict[str, str], column: str) -> str | None:
    value = fields.get(FIELDS[column])
    if value is not None and column == "payload_digest":
        return value.rpartition(":")[2].lower()
    return value


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.wanted = path, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else ""
            if column not in FIELDS or column == "payload_length":
                yield f
            elif isinstance(f, EqualTo):
                self.wanted.append((column, "in", [f.value]))
            elif isinstance(f, In):
                self.wanted.append((column, "in", list(f.value)))
            elif isinstance(f, StringStartsWith):
                self.wanted.append((column, "starts", f.value))
            else:
                yield f

    def partitions(self) -> list[Files]:
        system, root = _open(self.path)
        found = {f.path: f.size for f in system.get_file_info(pafs.FileSelector(root)) if f.is_file}
        manifests = [p for p in found if p.endswith(MANIFEST)]
        names = [p for p in found if p.endswith((".warc", ".warc.gz"))]
        if manifests:
            listed = {n for m in manifests for n in json.loads(system.open_input_stream(m).read())}
            names = [p for p in names if p.rsplit("/", 1)[-1] in listed]
        plans: list[Files] = []
        size = PARTITION_BYTES
        for p in sorted(names):
            if size + found[p] > PARTITION_BYTES:
                plans.append(Files([]))
                size = 0
            plans[-1].paths.append(p)
            size += found[p]
        return plans or [Files([])]

    def passes(self, fields: dict[str, str]) -> bool:
        for column, how, value in self.wanted:
            own = _column_value(fields, column)
            if own is None or not (own in value if how == "in" else own.startswith(value)):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _open(self.path)
        rows, held = [], 0
        for path in partition.paths:
            raw = system.open_input_file(path)
            stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 20)
            while (fields := parse_headers(stream)) is not None:
                length = int(fields.get("content-length", 0))
                if not self.passes(fields):
                    stream.seek(length, io.SEEK_CUR)
                    continue
                block = stream.read(length)
                own = [_column_value(fields, c) for c in ARROW.names[:5]]
                given = fields.get(FIELDS["payload_length"])
                payload = None if own[0] == "revisit" else decode_block(fields, block)
                rows.append((*own, int(given) if given else None, payload))
                held += length + len(payload or b"")
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ARROW.types)], schema=ARROW)
                    rows, held = [], 0
            stream.close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ARROW.types)], schema=ARROW)


def record(row: dict, date: str) -> bytes:
    """One WARC record; payloads of some size are compressed as the HTTP entity."""
    payload = row["payload"] or b""
    if row["record_type"] == "revisit":
        body, coding = b"", ""
    elif len(payload) >= LEAST_REVISIT:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        body, coding = packer.compress(payload) + packer.flush(), "Content-Encoding: gzip\r\n"
    else:
        body, coding = payload, ""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{coding}Content-Length: {len(body)}\r\n\r\n".encode()
    uri = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in row["target_uri"] or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {row['record_id']}",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {uri}"] if uri else []),
        *([f"WARC-Refers-To: {row['refers_to']}", f"WARC-Profile: {PROFILE}"] if row["refers_to"] else []),
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"WARC-X-Payload-Length: {row['payload_length']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + len(body)}",
    ]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + http + body + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    name: str


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.date = path, time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _open(self.path)
        system.create_dir(root)
        name, stream = f"part-{uuid.uuid4().hex}.warc", None
        for batch in iterator:
            for at in range(0, len(batch), 256):
                for row in batch.slice(at, 256).to_pylist():
                    if stream is None:
                        stream = system.open_output_stream(f"{root}/{name}")
                    stream.write(record(row, self.date))
        if stream is None:
            return Written("")
        stream.close()
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _open(self.path)
        system.create_dir(root)
        with system.open_output_stream(f"{root}/{uuid.uuid4().hex}{MANIFEST}") as out:
            out.write(json.dumps(sorted(m.name for m in messages if m and m.name)).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, root = _open(self.path)
        for m in messages:
            if m and m.name:
                system.delete_file(f"{root}/{m.name}")


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)`` and ``df.write.format("warc").mode("append").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """A record per page: of equal payloads of ``least`` bytes or more the smallest ``page_id`` is the response.

    Null html is an empty payload. Rows that repeat the smallest id are responses as well. A page
    without id is a response that nothing refers to. Digests are counted before pages are joined,
    and the join leaves a payload that many pages share to be split at run time.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("target_uri"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"payload_digest": F.sha2("payload", 256), "payload_length": F.length("payload").cast("long")})
    firsts = (
        rows.where((F.col("payload_length") >= least) & F.col("page_id").isNotNull()).groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").select("payload_digest", "first")
    )
    name = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    again = F.coalesce(F.col("page_id") > F.col("first"), F.lit(False))
    return rows.join(firsts, "payload_digest", "left").select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.coalesce(name("page_id"), F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))).alias("record_id"),
        "target_uri",
        F.when(again, name("first")).alias("refers_to"),
        "payload_digest",
        "payload_length",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def archive(pages: DataFrame, path: str) -> None:
    """Write the pages' records below ``path``."""
    register(pages.sparkSession)
    page_records(pages).write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records below ``path``. Load anew for each filtered scan: Spark keeps pushed filters with a loaded table."""
    register(spark)
    return spark.read.format("warc").load(path)


def page_summary(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)``, payload figures from the payload read back.

    Two scans: one decodes the responses, the other takes the headers of revisits and skips all payloads.
    """
    number = lambda c: F.regexp_extract(F.col(c), r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    same = [number("record_id").alias("page_id"), "record_type"]
    responses = read(spark, path).where("record_type = 'response'").select(
        *same, F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest")
    )
    revisits = read(spark, path).where("record_type = 'revisit'").select(
        *same, F.col("payload_length").alias("payload_bytes"), "payload_digest", number("refers_to").alias("refers_to")
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(revisits.select(*columns))
