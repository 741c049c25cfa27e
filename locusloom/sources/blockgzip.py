"""Block-gzip text: large ``.gz`` files of one application format that several tasks can read.

Such a file is a row of gzip members of at most 64 KiB, each with its own length in an extra
field. A file is planned as byte ranges; a task looks for the first member that starts in its
range and reads members from there. As with plain text, a range's lines are those that start
after its first line end, and its last line is read to its end in the ranges that follow.
Ordinary gzip files have no such members: their first range reads them whole, others nothing.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

# Fixed values of the format: the start of a member with extra fields, the field that holds a
# member's length, the largest member, the text that fits one however badly it packs, no text.
MAGIC = b"\x1f\x8b\x08\x04"
LENGTH_FIELD = b"BC"
LARGEST = 1 << 16
TEXT_PER_MEMBER = 0xFF00
HEAD, HEAD_SIZE = "<4sIBBH", 12

SPLIT_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
SCHEMA = "value string, file_path string, _block long, line_order long"


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it of a local path or a URI."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def member_size(data: bytes, at: int = 0) -> int:
    """Length of the member whose head is at ``at``; 0 if there is none."""
    if data[at : at + 4] != MAGIC or len(data) < at + HEAD_SIZE:
        return 0
    end = at + HEAD_SIZE + struct.unpack_from(HEAD, data, at)[4]
    field = at + HEAD_SIZE
    while field + 6 <= min(end, len(data)):
        size = struct.unpack_from("<H", data, field + 2)[0]
        if data[field : field + 2] == LENGTH_FIELD and size == 2:
            return struct.unpack_from("<H", data, field + 4)[0] + 1
        field += 4 + size
    return 0


def unpacked(member: bytes) -> bytes | None:
    """Text of a whole member, None where length or checksum don't fit."""
    inflate = zlib.decompressobj(31)
    try:
        text = inflate.decompress(member)
    except zlib.error:
        return None
    return text if inflate.eof and not inflate.unused_data else None


def packed(text: bytes) -> bytes:
    """One member with ``text``, at most ``TEXT_PER_MEMBER`` bytes."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(text) + deflate.flush()
    extra = LENGTH_FIELD + struct.pack("<HH", 2, HEAD_SIZE + 6 + len(body) + 8 - 1)
    return struct.pack(HEAD, MAGIC, 0, 0, 255, len(extra)) + extra + body + struct.pack("<II", zlib.crc32(text), len(text))


def first_member(file: pa.NativeFile, start: int, size: int) -> int:
    """Where the first member at or after ``start`` begins; ``size`` if none does.

    A member's packed text may hold the bytes of a head, stored as they are even whole members.
    So the one at hand and those that follow it without a gap must unpack to their checksums
    until farther than a member reaches, where a row of members inside another has come to an end.
    Only where there is none, one whose row the file's end cuts off counts: reading it is an error.
    """
    window = file.read_at(min(3 * LARGEST, size - start), start)
    at, cut = window.find(MAGIC), size
    while 0 <= at <= LARGEST:
        last = min(len(window), at + LARGEST)
        follows = at
        while follows < last and (length := member_size(window, follows)):
            if follows + length > len(window):
                cut = min(cut, start + at)
                break
            if unpacked(window[follows : follows + length]) is None:
                break
            follows += length
        if follows >= last:
            return start + at
        at = window.find(MAGIC, at + 1)
    if cut == size and start + LARGEST < size:
        raise ValueError(f"no block-gzip member within {LARGEST} bytes from {start}")
    return cut


def _members(file: pa.NativeFile, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """``(offset, text)`` of the members from ``at`` on."""
    while at < size:
        ahead = file.read_at(min(LARGEST, size - at), at)
        length = member_size(ahead)
        text = unpacked(ahead[:length]) if length else None
        if text is None:
            raise ValueError(f"broken block-gzip member at {at}")
        yield at, text
        at += length


def _whole(file: pa.NativeFile) -> Iterator[tuple[int, bytes]]:
    """Text of an ordinary gzip file, member after member, in pieces of bounded size."""
    file.seek(0)
    inflate, data, begun = zlib.decompressobj(31), b"", False
    while data or (data := file.read(LARGEST)):
        yield 0, inflate.decompress(data, BATCH_BYTES)
        data, begun = inflate.unconsumed_tail, not inflate.eof
        if inflate.eof:
            data, inflate = inflate.unused_data, zlib.decompressobj(31)
    yield 0, inflate.flush()
    if begun and not inflate.eof:
        raise ValueError("a gzip file is cut off")


def range_lines(pieces: Iterator[tuple[int, bytes]], first: bool, end: int) -> Iterator[list[bytes]]:
    """Lines of a range in lists: of the pieces that begin before ``end``, and the line that runs beyond.

    Unless it is a file's ``first``, what stands before the range's first line end belongs to
    the range before.
    """
    held: list[bytes] = []
    size, skipping = 0, not first
    for at, text in pieces:
        if at >= end:
            if skipping:
                return
            head, line_end, _ = text.partition(b"\n")
            held.append(head)
            if line_end:
                yield b"".join(held).split(b"\n")
                return
            continue
        if skipping:
            _, line_end, text = text.partition(b"\n")
            if not line_end:
                continue
            skipping = False
        held.append(text)
        size += len(text)
        if size >= BATCH_BYTES and b"\n" in text:
            whole, _, rest = b"".join(held).rpartition(b"\n")
            yield whole.split(b"\n")
            held, size = [rest], 0
    if not skipping and (text := b"".join(held)):
        yield text.removesuffix(b"\n").split(b"\n")


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    size: int
    number: int


class BlockGzipReader(DataSourceReader):
    def __init__(self, paths: Sequence[str], split_bytes: int):
        self.paths, self.split_bytes = paths, split_bytes

    def partitions(self) -> list[Range]:
        found = []
        for path in self.paths:
            system, place = _system(path)
            info = system.get_file_info(place)
            if info.type == pafs.FileType.NotFound:
                raise FileNotFoundError(path)
            if info.type == pafs.FileType.Directory:
                inside = system.get_file_info(pafs.FileSelector(place, recursive=True))
                names = [(i.path, i.size) for i in inside if i.is_file and not os.path.basename(i.path).startswith(("_", "."))]
                found += [(path.rstrip("/") + p.removeprefix(place.rstrip("/")), s) for p, s in names]
            else:
                found.append((path, info.size))
        ranges = [(p, at, min(at + self.split_bytes, s), s) for p, s in sorted(found) for at in range(0, s, self.split_bytes)]
        return [Range(*r, number) for number, r in enumerate(ranges)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        system, place = _system(part.path)
        with system.open_input_file(place) as file:
            if member_size(file.read_at(min(LARGEST, part.size), 0)):
                pieces = _members(file, first_member(file, part.start, part.size) if part.start else 0, part.size)
            elif part.start:
                return
            else:
                pieces = _whole(file)
            order = part.number << 33
            for lines in range_lines(pieces, part.start == 0, part.end):
                text = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
                columns = [text, [part.path] * len(text), [part.start] * len(text), range(order, order + len(text))]
                types = [pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["value", "file_path", "_block", "line_order"])
                order += len(text)


@dataclass
class Part(WriterCommitMessage):
    name: str


class BlockGzipWriter(DataSourceArrowWriter):
    """A task writes one file under a hidden name; the commit shows the files of the tasks that counted and removes the rest."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        system, folder = _system(self.path)
        system.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.gz"
        held = bytearray()
        with system.open_output_stream(f"{folder}/_{name}", compression=None) as out:
            for batch in iterator:
                for line in batch.column(0).to_pylist():
                    held += (line or "").encode("utf-8") + b"\n"
                    while len(held) >= TEXT_PER_MEMBER:
                        out.write(packed(bytes(held[:TEXT_PER_MEMBER])))
                        del held[:TEXT_PER_MEMBER]
            if held:
                out.write(packed(bytes(held)))
            out.write(packed(b""))
        return Part(name)

    def commit(self, messages: list[Part | None]) -> None:
        system, folder = _system(self.path)
        for message in messages:
            if message is not None:
                system.move(f"{folder}/_{message.name}", f"{folder}/{message.name}")
        self.abort(messages)

    def abort(self, messages: list[Part | None]) -> None:
        system, folder = _system(self.path)
        for info in system.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if os.path.basename(info.path).startswith("_part-"):
                system.delete_file(info.path)


class BlockGzip(DataSource):
    """``format("block_gzip")``: lines of block-gzip files."""

    @classmethod
    def name(cls) -> str:
        return "block_gzip"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BlockGzipReader:
        return BlockGzipReader(json.loads(self.options["paths"]), int(self.options["splitBytes"]))

    def writer(self, schema, overwrite: bool) -> BlockGzipWriter:
        return BlockGzipWriter(self.options["path"])


def read_block_lines(spark: SparkSession, paths: str | Sequence[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(value, file_path, _block, line_order)`` of gzip files and folders of them, as ``lines.read_lines`` gives them.

    Block-gzip files are read by a task for each ``split_bytes``, ordinary gzip files by one task
    each. Lines end at a line feed, a carriage return before it is dropped. An empty file has no
    lines; a broken or cut-off member is an error.
    """
    spark.dataSource.register(BlockGzip)
    places = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format("block_gzip").option("paths", json.dumps(places)).option("splitBytes", str(split_bytes)).load()


def write_block_lines(lines: DataFrame, path: str) -> None:
    """Write ``value`` as lines of block-gzip files, one for each partition, into a new folder; null is an empty line.

    Part names grow with the partition's number, so parts of an ordered table are in order.
    """
    lines.sparkSession.dataSource.register(BlockGzip)
    lines.select(F.col("value").cast("string").alias("value")).write.format("block_gzip").mode("append").save(path)
