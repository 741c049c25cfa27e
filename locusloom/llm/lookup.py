"""Exact counts of 64-bit keys that are too many to be sent to every task, met by the texts that ask for them.

The counts are kept in a folder for each bucket of keys. The texts are read twice, in groups of a
few MB: first a group's keys are taken from it, each once and in order, and dealt by bucket, in
lists. A task answers the lists of its buckets from the counts kept there, and the answers, which are
counts alone in the order of the keys, are dealt by group and kept in a folder named by a digest of
the group's keys. Who reads the texts again finds the answers under the same digest; should the
groups have been cut otherwise, it goes through the buckets instead, which is slow and as right.
Texts do not move, no key is answered from another's count, and a task holds one bucket's counts or
one group at a time. The tables are read with ``pyarrow.fs``, as the archives of ``warc`` are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.llm import bytesops
from locusloom.llm.tables import Scratch

BUCKET = np.uint64(54)  # 1,024 buckets by the highest bits
GROUP = 8 << 20
PACKED = 1 << 18
LISTS = "bucket int, keys binary, a binary, b binary"


def _planes(values: np.ndarray) -> bytes:
    """Bytes of numbers, all lowest ones first and all highest last: small numbers leave runs of zeros to compression."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _numbers(planes: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(planes, np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def _key_lists(keys: np.ndarray) -> Iterator[tuple[int, slice, bytes]]:
    """Bucket, place and packed keys of the runs of sorted keys that have a bucket."""
    bucket = (keys >> BUCKET).astype(np.int32)
    cut = np.flatnonzero(np.concatenate(([len(keys) > 0], bucket[1:] != bucket[:-1])))
    for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(keys)]):
        yield int(bucket[i]), slice(i, j), _planes(np.diff(keys[i:j], prepend=np.uint64(0)))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(schema), schema.types)], schema=schema)


COUNTED = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("a", pa.binary()), ("b", pa.binary())])
ASKED = pa.schema([("bucket", pa.int32()), ("gid", pa.string()), ("keys", pa.binary())])
ANSWERED = pa.schema([("gid", pa.string()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])


def _count_lists(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, ...]]]):
    """``LISTS`` of the ``(keys, a, b)`` that ``rows`` makes of batches, many at a time."""

    def packed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        keys, a, b = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(keys)
        keys, a, b = keys[order], a[order].astype(np.int32), b[order].astype(np.int32)
        return _batch([(k, packed, _planes(a[at]), _planes(b[at])) for k, at, packed in _key_lists(keys)], COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for found in rows(batches):
            held.append(found)
            if sum(len(h[0]) for h in held) >= PACKED:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    return run


def keep_counts(parts: list[tuple[DataFrame, Callable]], scratch: Scratch) -> str:
    """Folder with counts by bucket, from tables and what makes ``(keys, a, b)`` of their batches."""
    lists = reduce(DataFrame.unionByName, [table.mapInArrow(_count_lists(rows), LISTS) for table, rows in parts])
    return scratch.place(scratch.keep(lists.repartition("bucket"), compression="zstd", by="bucket"))


def _read(place: str, name: str, columns: list[str]) -> list[dict] | None:
    """Rows kept under a name, None if there are none."""
    system, path = pafs.FileSystem.from_uri(place) if ":/" in place else (pafs.LocalFileSystem(), place)
    if system.get_file_info(f"{path}/{name}").type == pafs.FileType.NotFound:
        return None
    return pads.dataset(f"{path}/{name}", filesystem=system, format="parquet").to_table(columns=columns, use_threads=False).to_pylist()


def _find(counts: str, bucket: int) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Counts of keys of a bucket."""
    rows = _read(counts, f"bucket={bucket}", ["keys", "a", "b"])
    if rows is None:
        return lambda keys: (np.zeros(len(keys), np.int32),) * 2
    known = np.concatenate([np.cumsum(_numbers(r["keys"], np.uint64), dtype=np.uint64) for r in rows])
    order = np.argsort(known)
    a, b = (np.concatenate([_numbers(r[c], np.int32) for r in rows])[order] for c in ("a", "b"))
    known = known[order]

    def find(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        there = known[at] == keys
        return np.where(there, a[at], 0).astype(np.int32), np.where(there, b[at], 0).astype(np.int32)

    return find


def _name(keys: np.ndarray) -> str:
    return hashlib.blake2b(keys.tobytes(), digest_size=16).hexdigest()


def groups_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows whose keys are asked for together."""
    return bytesops.pieces(batch, "text", GROUP)


def answers(rows: DataFrame, wanted: Callable[[pa.RecordBatch], np.ndarray], counts: str, scratch: Scratch) -> str:
    """Folder with the counts of the sorted keys that ``wanted`` takes from each group of ``rows``, for :func:`read_answers`.

    ``counts`` is the folder of :func:`keep_counts`; a key that is not there counts 0 and 0.
    """

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in groups_of(whole):
                keys = wanted(batch)
                name = _name(keys)
                yield _batch([(bucket, name, packed) for bucket, _, packed in _key_lists(keys)], ASKED)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, find = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["bucket"] != at:
                    at, find = row["bucket"], _find(counts, row["bucket"])
                out.append((row["gid"], at, *map(_planes, find(np.cumsum(_numbers(row["keys"], np.uint64), dtype=np.uint64)))))
            yield _batch(out, ANSWERED)

    asked = rows.mapInArrow(requests, "bucket int, gid string, keys binary").repartition("bucket").sortWithinPartitions("bucket")
    found = asked.mapInArrow(answered, "gid string, bucket int, a binary, b binary").repartition("gid").sortWithinPartitions("gid")
    return scratch.place(scratch.keep(found, compression="zstd", by="gid"))


def read_answers(place: str, counts: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two counts of each of a group's keys, in their order."""
    if not len(keys):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    rows = _read(place, f"gid={_name(keys)}", ["bucket", "a", "b"])
    if rows is None:
        found = [_find(counts, bucket)(keys[at]) for bucket, at, _ in _key_lists(keys)]
    else:
        once = {r["bucket"]: r for r in rows}  # equal groups have equal answers
        found = [[_numbers(once[k][c], np.int32) for c in ("a", "b")] for k in sorted(once)]
    a, b = (np.concatenate(c) for c in zip(*found))
    return a, b
