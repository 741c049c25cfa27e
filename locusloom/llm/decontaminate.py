"""Benchmark items inside documents: size-partitioned MinHash containment, verified exactly.

Sets are distinct ``width``-word shingles. A test item is far smaller than the documents that
may hold it, so similarity says little and containment is asked for: the share of the item's
shingles that the document has. Items are partitioned by set size in powers of two. Each keeps
the ``keep`` smallest of its hashes, where ``keep`` follows from the largest size of the
partition; of a contained item most of them lie in the document, whatever the document's size,
so a document that has fewer than ``needed`` of them is no candidate. Candidates are verified
on all shingles.

The items are the stated query set. They go in blocks of at most ``BLOCK`` shingles (a few
tens of MB), each shipped to all tasks over one scan of the documents; the number of scans
grows with the benchmark, the memory doesn't. Documents are not moved at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.llm import bytesops
from locusloom.llm.tables import bound_batches, text_rows

BLOCK = 2_000_000
KEEP = 24
MISS = 1e-10
FOUND = "doc_id long, item_id long, n_item long, n_shared long"


def retained(largest: int, percent: int) -> tuple[int, int]:
    """Values kept by items of up to ``largest`` shingles, and how many a document must have.

    With ``missing`` shingles allowed to be absent, more than ``missing`` kept values can't all
    be; where that takes over ``KEEP`` values, the number needed is one that a draw without
    replacement falls short of with a chance under ``MISS``.
    """
    missing = largest * (100 - percent) // 100
    if missing < KEEP:
        return KEEP, 1
    keep, t, below = 2 * KEEP, percent / 100, 0.0
    for c in range(keep + 1):
        below += math.comb(keep, c) * t**c * (1 - t) ** (keep - c)
        if below > MISS:
            return keep, max(c, 1)
    return keep, keep


class Items:
    """A block of items: retained values sorted for look-up, and the full sets."""

    def __init__(self, rows: list[tuple[int, np.ndarray]], percent: int):
        self.percent = percent
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.sets = [r[1] for r in rows]
        self.sizes = np.array([len(s) for s in self.sets])
        values, owners, self.needed = [], [], np.ones(len(rows), np.int64)
        for i, found in enumerate(self.sets):
            keep, needed = retained(1 << (len(found) - 1).bit_length(), percent)
            values.append(found[:keep])
            owners.append(np.full(len(values[-1]), i))
            self.needed[i] = min(needed, len(values[-1]))
        values, owners = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(values, kind="stable")
        self.values, self.owners = values[order], owners[order]

    def within(self, found: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Item, its set size and the shingles it shares with a document's sorted set."""
        if not len(found):
            return
        low, high = np.searchsorted(self.values, found, "left"), np.searchsorted(self.values, found, "right")
        hit = np.flatnonzero(high > low)
        if not len(hit):
            return
        owners = np.concatenate([self.owners[low[i] : high[i]] for i in hit])
        items, counts = np.unique(owners, return_counts=True)
        for i in items[counts >= self.needed[items]]:
            own = self.sets[i]
            at = np.minimum(np.searchsorted(found, own), len(found) - 1)
            shared = int(np.count_nonzero(found[at] == own))
            if 100 * shared >= self.percent * len(own):
                yield int(self.ids[i]), len(own), shared


def item_sets(items: DataFrame, width: int, percent: int) -> Iterator[Items]:
    """Blocks of items, read from the driver's side row by row; items without words are left out."""
    rows, size = [], 0
    source = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    for row in source.orderBy("item_id", "text").toLocalIterator():
        if row["item_id"] is None:
            continue
        found = next(bytesops.shingle_rows(pa.array([row["text"]]), width, bytesops.letter_words()))
        if not len(found):
            continue
        rows.append((row["item_id"], found))
        size += len(found)
        if size >= BLOCK:
            yield Items(rows, percent)
            rows, size = [], 0
    if rows:
        yield Items(rows, percent)


def _scan(block: Items, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = bytesops.letter_words()
        for whole in batches:
            for batch in bytesops.pieces(whole, "text"):
                out = [
                    (doc, *hit)
                    for doc, found in zip(batch.column("doc_id").to_pylist(), bytesops.shingle_rows(batch.column("text"), width, inside))
                    for hit in block.within(found)
                ]
                columns = zip(*out) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "n_item", "n_shared"])

    return run


def contained_items(docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, item_id, n_item, n_shared)``: items of which a document has ``percent`` of the shingles or more.

    Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case. An
    item of fewer words than ``width`` is one shingle, found in a document of just these words.
    Null or empty texts hold nothing and items without words are in nothing; rows without
    ``doc_id`` or ``item_id`` are left out. Repeated rows give one pair, an item id with several
    texts the best-held one. Other columns are ignored.
    """
    rows = text_rows(docs).where("doc_id is not null")
    parts = [rows.mapInArrow(_scan(block, width), FOUND) for block in item_sets(items, width, percent)]
    if not parts:
        return docs.sparkSession.createDataFrame([], FOUND)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("share"), "n_item", "n_shared")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.n_item", "best.n_shared")


def _clean(block: Items, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = bytesops.letter_words()
        for whole in batches:
            for batch in bytesops.pieces(whole, "text"):
                sets = bytesops.shingle_rows(batch.column(batch.schema.get_field_index("text")), width, inside)
                yield batch.filter(pa.array([next(block.within(found), None) is None for found in sets], pa.bool_()))

    return run


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item; each block of items filters where the rows are."""
    bound_batches(docs.sparkSession)
    for block in item_sets(items, width, percent):
        docs = docs.mapInArrow(_clean(block, width), docs.schema)
    return docs
