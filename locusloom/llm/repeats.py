"""Removal of repeated passages from a corpus by prefix-free parsing and suffix order.

1. *Parse.* A rolling hash over ``GRAM`` bytes triggers a phrase at the place whose hash is
   smallest among the places of a ``width``-byte string. Triggers depend on the bytes of that
   string alone, so equal strings are cut alike wherever they stand, and no string of
   ``width`` bytes is without one. The starts that share a trigger form a phrase; its text
   reaches over the last of their strings, so phrases overlap as in a prefix-free parse.
2. *Dictionary.* Phrases are counted by trigger and text. Of equal phrases all but the first
   in corpus order repeat with every start they hold. A trigger seen once repeats nothing.
3. *Suffixes.* What is left are the first places of distinct phrases that share a trigger.
   Their suffixes are put in order up to ``width`` bytes (only equality of the first ``width``
   bytes matters, so fingerprints stand for the text) and, among equal ones, in corpus order:
   all but the first of each run repeat.

Step 3 orders the suffixes of one trigger inside a task where it has at most ``GROUP``
distinct phrases; a trigger with more spreads its suffixes over all tasks by fingerprint.
Both ways give the same rows. No step gathers a group of unknown size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusloom.llm import bytesops
from locusloom.llm.tables import Scratch, likely_rows, text_rows, whole_groups

GRAM = 24
#: Phrases of one trigger ordered inside a task: about 400 kB of text.
GROUP = 2048
PHRASES = "g long, h long, doc_id long, lo int, n short"
SUFFIXES = "g long, h long, doc_id long, lo int, n int, part binary"
SPANS = "doc_id long, lo int, n int"


def phrases(data: np.ndarray, prefix: bytesops.Prefix, width: int) -> tuple[np.ndarray, ...]:
    """Trigger hash, phrase hash, first start and number of starts of each phrase of one text."""
    grams = np.arange(len(data) - GRAM + 1)
    trigger = prefix.hashes(grams, grams + GRAM)
    span = width - GRAM + 1
    best, reach = (trigger >> np.uint64(26) << np.uint64(26)) | grams.astype(np.uint64), 1
    while reach < span:
        step = min(reach, span - reach)
        best = np.minimum(best[:-step], best[step:])
        reach += step
    at = (best & np.uint64((1 << 26) - 1)).astype(np.int64)
    lo = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    n = np.diff(np.append(lo, len(at)))
    return trigger[at[lo]].view(np.int64), prefix.hashes(lo, lo + n - 1 + width).view(np.int64), lo, n


def _parse(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, block = bytesops.byte_codes(False), 1 << 24
        for whole in batches:
            for batch in bytesops.pieces(whole, "text"):
                data, offsets = bytesops.buffers(batch.column("text"))
                ids, found = batch.column("doc_id").to_numpy(zero_copy_only=False), []
                for i in np.flatnonzero(np.diff(offsets) >= width):
                    text = data[offsets[i] : offsets[i + 1]]
                    for begin in range(0, len(text) - width + 1, block):  # blocks share width - 1 bytes
                        part = text[begin : begin + block + width - 1]
                        g, h, lo, n = phrases(part, bytesops.Prefix(part, codes), width)
                        found.append((g, h, np.full(len(g), ids[i], np.int64), lo + begin, n))
                if found:
                    g, h, doc, lo, n = (np.concatenate(x) for x in zip(*found))
                    columns = [g, h, doc, lo.astype(np.int32), n.astype(np.int16)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["g", "h", "doc_id", "lo", "n"])

    return run


def _suffixes(width: int):
    """Text of each open phrase, or for crowded triggers the fingerprint of every suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = bytesops.byte_codes(False)
        for whole in batches:
            for batch in bytesops.pieces(whole, "text"):
                data, offsets = bytesops.buffers(batch.column("text"))
                ids, opened, rows = batch.column("doc_id").to_pylist(), batch.column("open").to_pylist(), []
                for i, (doc, marks) in enumerate(zip(ids, opened)):
                    text = data[offsets[i] : offsets[i + 1]]
                    for m in marks:
                        part = text[m["lo"] : m["lo"] + m["n"] + width - 1]
                        if m["crowded"]:
                            starts = np.arange(m["n"])
                            prints = bytesops.Prefix(part, codes).hashes(starts, starts + width).view(np.int64)
                            rows += [(m["g"], int(p), doc, m["lo"] + j, 1, None) for j, p in enumerate(prints)]
                        else:
                            rows.append((m["g"], None, doc, m["lo"], m["n"], part.tobytes()))
                    if len(rows) > 50_000:
                        yield _rows(rows, SUFFIX_ARROW)
                        rows = []
                if rows:
                    yield _rows(rows, SUFFIX_ARROW)

    return run


SUFFIX_ARROW = pa.schema(
    [("g", pa.int64()), ("h", pa.int64()), ("doc_id", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("part", pa.binary())]
)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)


def _later(g, doc, lo, n, parts: list[bytes], width: int) -> pa.RecordBatch:
    """Starts whose ``width`` bytes stand earlier among the phrases of the same trigger."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    begins = np.concatenate(([0], np.cumsum(n + width - 1)))[:-1]
    row = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    starts = begins[row] + inner
    prints = bytesops.Prefix(data, bytesops.byte_codes(False)).hashes(starts, starts + width)
    place = lo[row] + inner
    order = np.lexsort((place, doc[row], prints, g[row]))
    same = np.zeros(len(order), bool)
    r, p = g[row][order], prints[order]
    same[1:] = (r[1:] == r[:-1]) & (p[1:] == p[:-1])
    group = np.cumsum(~same) - 1
    head = order[np.flatnonzero(~same)][group]  # the first of each run
    later = order[(doc[row][head] != doc[row][order]) | (place[head] != place[order])]
    late = np.zeros(len(row), bool)
    late[later] = True
    begin = np.zeros(len(row) + 1, bool)
    begin[np.cumsum(n) - n] = begin[-1] = True  # a run ends with its phrase
    before, after = np.concatenate(([False], late[:-1])), np.concatenate((late[1:], [False]))
    first = np.flatnonzero(late & (begin[:-1] | ~before))
    last = np.flatnonzero(late & (begin[1:] | ~after)) + 1
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[row][first]), pa.array(place[first].astype(np.int32)), pa.array((last - first).astype(np.int32))],
        ["doc_id", "lo", "n"],
    )


def _order_suffixes(width: int):
    """Over phrases sorted by trigger: the phrases of some whole triggers are ordered together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["g"]):
            yield order(table)

    def order(table: pa.Table) -> pa.RecordBatch:
        g, doc, lo, n = (table.column(c).to_numpy().astype(np.int64) for c in ("g", "doc_id", "lo", "n"))
        return _later(g, doc, lo, n, table.column("part").to_pylist(), width)

    return run


def repeated_starts(docs: DataFrame, scratch: Scratch, width: int = 100) -> DataFrame:
    """``(doc_id, lo, n)``: runs of starts whose ``width`` bytes also start earlier in the corpus."""
    rows = text_rows(docs).where("doc_id is not null")
    parsed = scratch.keep(rows.mapInArrow(_parse(width), PHRASES))
    shared = (
        parsed.groupBy("g").agg(F.count(F.lit(1)).alias("c"), F.min("h").alias("low"), F.max("h").alias("high"))
        .where("c > 1").select("g", (F.col("low") != F.col("high")).alias("several"))
    )
    found = scratch.keep(parsed.join(shared, "g"))
    scratch.drop(parsed)
    heads = found.groupBy("g", "h").agg(F.min(F.struct("doc_id", "lo")).alias("head"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    placed = scratch.keep(
        found.join(heads, ["g", "h"], "left").select(
            "g", "doc_id", "lo", "n", "several", F.coalesce(F.struct("doc_id", "lo") > F.col("head"), F.lit(False)).alias("whole")
        )
    )
    scratch.drop(found)
    open_ = placed.where("several and not whole")
    crowded = open_.groupBy("g").agg(F.count(F.lit(1)).alias("c")).select("g", (F.col("c") > GROUP).alias("crowded"))
    marks = open_.join(crowded, "g").groupBy("doc_id").agg(F.collect_list(F.struct("g", "lo", "n", "crowded")).alias("open"))
    asked = likely_rows(rows, open_.select("doc_id"))
    suffixes = scratch.keep(asked.join(marks, "doc_id").select("doc_id", "text", "open").mapInArrow(_suffixes(width), SUFFIXES))
    near = (
        suffixes.where("part is not null").select("g", "doc_id", "lo", "n", "part")
        .repartition("g").sortWithinPartitions("g").mapInArrow(_order_suffixes(width), SPANS)
    )
    spread = suffixes.where("part is null").select("g", "h", "doc_id", "lo", "n")
    first = spread.groupBy("g", "h").agg(F.min(F.struct("doc_id", "lo")).alias("head"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    far = spread.join(first, ["g", "h"]).where(F.struct("doc_id", "lo") > F.col("head")).select("doc_id", "lo", "n")
    spans = scratch.keep(placed.where("whole").select("doc_id", "lo", F.col("n").cast("int").alias("n")).unionByName(near).unionByName(far))
    scratch.drop(placed, suffixes)
    return spans


def _covered(spans: np.ndarray, size: int, width: int) -> np.ndarray:
    """True at each byte under a repeated string."""
    edges = np.zeros(size + 1, np.int32)
    if len(spans):
        low = np.clip(spans[:, 0], 0, size)
        np.add.at(edges, low, 1)
        np.add.at(edges, np.clip(spans[:, 0] + spans[:, 1] + width - 1, low, size), -1)
    return np.cumsum(edges[:-1]) > 0


def _cut(width: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bytesops.pieces(whole, "text"):
                data, offsets = bytesops.buffers(batch.column("text"))
                lists, out = batch.column("spans"), []
                for i in range(len(batch)):
                    raw = data[offsets[i] : offsets[i + 1]]
                    found = lists[i].as_py() or []
                    if not found:
                        out.append((len(raw), 0, 0, raw.tobytes()))
                        continue
                    gone = _covered(np.array([(s["lo"], s["n"]) for s in found], np.int64), len(raw), width)
                    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                    out.append((len(raw), int(gone.sum()), runs, raw[~gone].tobytes()))
                names = [c for c in batch.schema.names if c not in ("text", "spans")]
                sizes, removed, runs, kept = zip(*out)
                columns = [batch.column(c) for c in names] + [pa.array(x, pa.int64()) for x in (sizes, removed, runs)]
                if with_text:
                    columns.append(pa.array([k.decode("utf-8", "ignore") for k in kept]))
                else:
                    columns.append(pa.array([hashlib.sha256(k).hexdigest() for k in kept]))
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_bytes", "n_removed", "n_spans", "text" if with_text else "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, width: int = 100, with_text: bool = False, carry: list[str] | None = None) -> DataFrame:
    """Every row with its repeated passages taken out.

    Texts are UTF-8 bytes; each byte covered by a ``width``-byte string that also starts
    earlier (smaller ``doc_id``, or the same one and an earlier start) is removed, judged on
    the input. Returns ``doc_id, n_bytes, n_removed, n_spans`` and ``kept_sha256``, or with
    ``with_text`` the remaining text as ``text``, without the remains of characters that a cut
    divided.

    Null texts are empty; texts under ``width`` bytes keep everything. A row without
    ``doc_id`` is outside the corpus order: it loses nothing and makes nothing repeat. Rows
    equal in ``doc_id`` and text lose the same passages, none for each other's sake; if texts
    of one ``doc_id`` differ, what either loses is cut from both, within their length. Columns
    named in ``carry`` go along, others are ignored; an empty table gives an empty one.
    """
    carry = carry or []
    scratch = Scratch(docs.sparkSession)
    spans = repeated_starts(docs, scratch, width)
    gone = spans.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "n")).alias("spans"))
    rows = text_rows(docs, *carry)
    tail = "text" if with_text else "kept_sha256"
    schema = T.StructType([*rows.drop("text").schema, *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans"))])
    return rows.join(gone, "doc_id", "left").select(*rows.columns, "spans").mapInArrow(_cut(width, with_text), schema.add(tail, T.StringType()))
