"""Document fingerprints: threshold-scaled sketches that merge and estimate containment.

A text is the set of its distinct ``width``-word shingles, each with a 64-bit hash. Its
fingerprint retains every hash below the fixed fraction ``1 / SCALE`` of all hashes, so it grows
with the text and a short text can be sought in a very long one: the share of its retained
hashes that the other retains estimates the share of its shingles that the other holds. Where
fewer than ``LEAST`` hashes are below the fraction, the ``LEAST`` smallest of all are retained
instead, so that short texts have whole sets. A fingerprint is thus complete up to its *limit*,
which its own values tell; two are compared, and merged, up to the smaller of their limits.

:func:`edited_fingerprints` sets each text beside its neighbour in the order of ids. Ids are cut
into ranges by quantiles, one range to a partition, and the first text of a range is also sent to
the one before it; so texts move once, no window spans the table, and what a task holds is two
neighbours and a piece of its sorted rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.llm import bytesops
from locusloom.llm.tables import text_rows

WIDTH = 5
SCALE = 16
LEAST = 64
BOUND = np.uint64((1 << 64) // SCALE)
NO_LIMIT = np.uint64((1 << 64) - 1)
OWN, COPY, UNNAMED = 0, 1, 2
FINGERPRINTS = "doc_id long, fingerprint binary"
EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, next_doc_id long"
)


def sketches(column: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted retained hashes of every text; fewer words than ``width`` are one shingle, none an empty sketch."""
    data, offsets = bytesops.buffers(column)
    starts, ends, firsts = bytesops.word_spans(data, offsets, bytesops.space_words())
    words, base = bytesops.span_hashes(data, starts, ends, lower=True), np.uint64(bytesops.SHINGLE_BASE)

    def rolled(size: int, low: int, high: int) -> np.ndarray:
        total = np.full(max(0, high - low - size + 1), size, np.uint64)
        for j in range(size):
            total = total * base + words[low + j : low + j + len(total)]
        return bytesops.mix(total)

    whole, out = rolled(width, 0, len(words)), []
    for low, high in zip(firsts[:-1], firsts[1:]):
        hashes = whole[low : high - width + 1] if high - low >= width else rolled(high - low, low, high) if high > low else words[:0]
        kept = np.unique(hashes[hashes < BOUND])
        out.append(kept if len(kept) >= LEAST else np.unique(hashes)[:LEAST])
    return out


def limit(sketch: np.ndarray) -> np.uint64:
    """Largest hash up to which a sketch has all of its text's."""
    return NO_LIMIT if len(sketch) < LEAST else max(BOUND - np.uint64(1), sketch[-1])


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two shingle sets."""
    both = np.union1d(a, b)
    kept = both[both < BOUND]
    return kept if len(kept) >= LEAST else both[:LEAST]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` holds; of an empty set all in an empty one, else none."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if np.array_equal(a, b):
        return 1.0
    asked = a[a <= min(limit(a), limit(b))]
    if not len(asked):
        return 0.0
    at = np.minimum(np.searchsorted(b, asked), len(b) - 1)
    return float(np.count_nonzero(b[at] == asked) / len(asked))


def packed(sketch: np.ndarray) -> bytes:
    return sketch.astype("<u8").tobytes()


def unpacked(fingerprint: bytes) -> np.ndarray:
    return np.frombuffer(fingerprint, "<u8")


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, fingerprint)`` of every row: retained hashes in order, little-endian, 8 bytes each.

    A null or empty text, or one without words, has an empty fingerprint; null ids and repeated
    rows are kept, other columns ignored. Texts stay where they are and are read piece by piece,
    whatever their length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bytesops.pieces(whole, "text"):
                found = [packed(s) for s in sketches(batch.column("text"), width)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "fingerprint"])

    return text_rows(docs).mapInArrow(run, FINGERPRINTS)


def _largest(cuts: np.ndarray):
    """Largest id of each range, one row a batch and range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.sort(batch.column("doc_id").to_numpy())
            part = np.searchsorted(cuts, ids).astype(np.int32)
            ends = np.flatnonzero(np.append(part[1:] != part[:-1], True)) if len(ids) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part[ends]), pa.array(ids[ends])], ["part", "first"])

    return run


def _dealt(cuts: np.ndarray, copies: dict[int, int]):
    """Rows with the number of their range, and a copy for the range before of each row that opens one."""
    opening = np.array(sorted(copies), np.int64)
    target = np.array([copies[i] for i in opening], np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            known = ids.fill_null(0).to_numpy(zero_copy_only=False)
            unnamed = ids.is_null().to_numpy(zero_copy_only=False)
            part = np.where(unnamed, np.arange(len(ids)) % (len(cuts) + 1), np.searchsorted(cuts, known)).astype(np.int32)
            kind = np.where(unnamed, UNNAMED, OWN).astype(np.int8)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(kind), ids, batch.column("text")], ["part", "kind", "doc_id", "text"])
            again = np.flatnonzero(np.isin(known, opening) & ~unnamed)
            if len(again):
                columns = [pa.array(target[np.searchsorted(opening, known[again])]), pa.array(np.full(len(again), COPY, np.int8))]
                yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c).take(pa.array(again)) for c in ("doc_id", "text"))], ["part", "kind", "doc_id", "text"])

    return run


def _edited(width: int):
    """Rows of ranges in falling order of ids, each beside the row after it."""

    def rows(held: list[tuple]) -> pa.RecordBatch:
        """Results of all rows of ``held`` that have a next one in it; those without id stand alone."""
        own = [i for i, r in enumerate(held) if r[0] != COPY and (r[0] == UNNAMED or i + 1 < len(held))]
        edited = []
        for i in own:
            text, half = held[i][2], len(held[i][2]) // 2
            edited.append(text if held[i][0] == UNNAMED else text[: len(text) - half] + held[i + 1][2][:half])
        plain = sketches(pa.array([r[2] for r in held], pa.large_string()), width)
        changed = sketches(pa.array(edited, pa.large_string()), width)
        out = []
        for i, text, sketch in zip(own, edited, changed):
            alone = held[i][0] == UNNAMED
            out.append((
                held[i][1], len(held[i][2]), hashlib.sha256(text.encode("utf-8")).hexdigest(),
                base64.b64encode(packed(plain[i])).decode(), base64.b64encode(packed(sketch)).decode(),
                containment(plain[i], sketch), None if alone else containment(plain[i], plain[i + 1]), None if alone else held[i + 1][1],
            ))
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "next_doc_id"]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int64()]
        columns = list(zip(*out)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[tuple] = []
        part = None
        for whole in batches:
            for batch in bytesops.pieces(whole, "text", 2 << 20):
                for key, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "doc_id", "text"))):
                    if key != part:  # another range in the same task
                        if last:
                            yield rows(last)
                        part, last = key, []
                    if row[0] == COPY and last and last[-1][0] == COPY:
                        continue  # repeated rows of the opening id: the first is the next one
                    last.append(tuple(row))
                if len(last) > 1:
                    yield rows(last)
                    last = last[-1:] if last[-1][0] != UNNAMED else []
        if last:
            yield rows(last)

    return run


def edited_fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how much of the text's shingles others hold.

    The edited text is the text whose last ``n_chars // 2`` code points give way to the first as
    many (or all) of the next document's, in falling order of ``doc_id``; after the last comes the
    first, and a single document is its own next. ``near_edited`` and ``near_next`` are estimated
    containments of the text in the edited text and in the next document.

    A null text is empty; an empty one has an empty fingerprint, wholly contained in an empty one
    and not at all in others. Rows of one ``doc_id`` follow each other in the order of their texts.
    A row without id has no place in the order: its edited text is its own, and its next is null.
    Texts of any length are read whole; an empty table gives an empty one; other columns are ignored.
    """
    rows = text_rows(docs)
    ids = rows.where("doc_id is not null").select("doc_id")
    ranges = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = ids.stat.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if ranges > 1 else []
    cuts = np.unique(np.array(found, np.float64).astype(np.int64))
    firsts = ids.mapInArrow(_largest(cuts), "part int, first long").groupBy("part").agg(F.max("first").alias("first"))
    opens = {r["part"]: r["first"] for r in firsts.collect()}  # a row for each range
    order = sorted(opens)  # the first row of a range, which falls, is next to the last one of the range above it
    copies = {opens[low]: high for low, high in zip(order, order[1:])}
    if order:
        copies[opens[order[-1]]] = order[0]
    dealt = rows.mapInArrow(_dealt(cuts, copies), "part int, kind byte, doc_id long, text string")
    placed = dealt.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "kind", F.desc("doc_id"), "text")
    return placed.mapInArrow(_edited(width), EDITED)
