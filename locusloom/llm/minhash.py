"""Near-duplicate documents by bottom-k sketches under one hash function.

A document is the set of its distinct ``width``-word shingles; its sketch is the ``k``
smallest of their 64-bit hashes. For two sets of similarity ``t`` each of the ``k`` smallest
hashes of the union lies in both sets with probability ``t``, so their sketches share at
least ``needed`` values but for a chance under ``MISS``.

1. Equal sets form a class, which its smallest document stands for from here on.
2. *Inverted lists.* How many sketches retain each value is counted over all classes. Of its
   sketch a class enters the lists of the ``k - needed + 1`` values retained least often: two
   sketches sharing ``needed`` values share one of these. Values of one sketch only are no
   list, and a passage in many documents is passed over for rarer values.
3. *Overlaps.* Each list compares its members with its hub, the member whose values are
   retained most often, which a template or an original is. Pairs whose union sketch keeps
   less than ``needed`` common values are dropped, the others confirmed on the full sets.
4. *Components* of these links. Members of a hub's lists outside its component are then held
   against all members of those lists, so that no link which could join components is missed.
   Near misses make many such pairs, so they are sifted inside tasks, in blocks, by a parity
   bitmap of each set: the bits in which two bitmaps differ are at most the elements in which
   the sets differ, so a pair with more differing bits than its sizes allow is no link. What
   passes goes through the two tests above. Pairs in one component need no test.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.llm import bytesops
from locusloom.llm.components import components
from locusloom.llm.tables import Scratch, likely_rows, text_rows, whole_groups

SKETCH = 48
MISS = 1e-10
BLOCK = 2048
PARITY = 4096
SKETCHES = "doc_id long, n_shingles long, f1 long, f2 long, sketch array<long>"


def needed_overlap(k: int, percent: int) -> int:
    """Largest count that a binomial of ``k`` draws at the similarity falls short of with a chance under ``MISS``."""
    t, below = percent / 100, 0.0
    for c in range(k + 1):
        below += math.comb(k, c) * t**c * (1 - t) ** (k - c)
        if below > MISS:
            return c
    return k


def _sketch(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = bytesops.space_words()
        for whole in batches:
            for batch in bytesops.pieces(whole, "text"):
                sizes, prints, kept = [], [], []
                for found in bytesops.shingle_rows(batch.column("text"), width, inside):
                    sizes.append(len(found))
                    prints.append(xxhash.xxh3_128_digest(found.tobytes()))
                    kept.append(found[:k])
                both = np.frombuffer(b"".join(prints), "<i8").reshape(-1, 2)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in kept]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*kept, np.zeros(0, np.int64)])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), lists],
                    ["doc_id", "n_shingles", "f1", "f2", "sketch"],
                )

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = bytesops.space_words()
        for whole in batches:
            for batch in bytesops.pieces(whole, "text", 1 << 20):
                found = [x.tobytes() for x in bytesops.shingle_rows(batch.column("text"), width, inside)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["id", "full"])

    return run


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmap of each full set: bit i tells whether the number of its hashes that fall on i is odd."""
    for batch in batches:
        found = []
        for full in batch.column("full"):
            at = np.frombuffer(full.as_buffer(), np.int64) & (PARITY - 1)
            found.append(np.packbits((np.bincount(at, minlength=PARITY) & 1).astype(np.uint8)).tobytes())
        sizes = [len(full.as_buffer()) // 8 for full in batch.column("full")]
        columns = [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n", "parity"])


def _confirm(percent: int):
    """Pairs whose full sets are similar enough, the sets being sorted hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for x, y in zip(batch.column("full_a"), batch.column("full_b")):
                one, two = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                both = np.concatenate((one, two))
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                held.append(100 * common >= percent * (len(both) - common))
            mask = pa.array(held, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return run


def _sift(percent: int):
    """Pairs of an asking and an asked row of a group that may be links, judged by their parity bitmaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["hub", "x", "y"]):
            keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("hub", "x", "y")])
            cuts = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0), [True])))
            ids, n, component = (table.column(c).to_numpy() for c in ("id", "n", "component"))
            asks = table.column("asks").to_numpy()
            bits = np.frombuffer(b"".join(table.column("parity").to_pylist()), np.uint64).reshape(len(ids), -1)
            found = []
            for low, high in zip(cuts[:-1], cuts[1:]):
                own = np.arange(low, high)
                others = own[~asks[own]]
                for i in own[asks[own]]:
                    near = others[
                        (component[others] != component[i])
                        & (100 * n[others] >= percent * n[i])
                        & (100 * n[i] >= percent * n[others])
                    ]
                    differ = np.bitwise_count(bits[near] ^ bits[i]).sum(axis=1, dtype=np.int64)
                    near = near[(100 + percent) * differ <= (100 - percent) * (n[near] + n[i])]
                    found.append(np.stack([np.minimum(ids[near], ids[i]), np.maximum(ids[near], ids[i])]))
            pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    return run


class _Search:
    """One run over one table: the class sketches, and the two tests that pairs go through."""

    def __init__(self, docs: DataFrame, width: int, percent: int, k: int, scratch: Scratch):
        self.docs, self.width, self.percent, self.k, self.scratch = docs, width, percent, k, scratch
        self.needed = needed_overlap(k, percent)

    def _similar_size(self, a: str, b: str):
        return (F.col(a) * 100 >= F.col(b) * self.percent) & (F.col(b) * 100 >= F.col(a) * self.percent)

    def lists(self, classes: DataFrame) -> DataFrame:
        """``(v, id, n, weight)``: the inverted lists, each class under its rarest retained values."""
        entries = classes.select("id", "n", F.explode("sketch").alias("v"))
        counts = entries.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        held = F.least(F.col("n"), F.lit(self.k))
        # least overlap: of complete sketches by their size, else by chance
        least = F.least(F.lit(self.needed), F.ceil(F.col("n") * self.percent / 100).cast("int"))
        per_class = entries.join(counts, "v").groupBy("id", "n").agg(
            F.sort_array(F.collect_list(F.struct("df", "v"))).alias("found"), F.sum("df").alias("weight")
        )
        places = (held - least + 1 - (held - F.size("found"))).cast("int")  # values of no list come first
        return per_class.withColumn("places", places).where("places > 0").select(
            F.explode(F.expr("slice(found, 1, places)").getField("v")).alias("v"), "id", "n", "weight"
        )

    def full_sets(self, members: DataFrame) -> DataFrame:
        """``(id, full)`` of the documents in ``members (doc_id)``."""
        asked = likely_rows(self.docs, members).join(members, "doc_id")  # members are distinct; a semi-join would be moved below the bitmap
        return self.scratch.keep(asked.mapInArrow(_full_sets(self.width), "id long, full binary"))

    def links(self, pairs: DataFrame, classes: DataFrame, full: DataFrame | None = None) -> DataFrame:
        """The pairs ``(a, b)`` that pass the union-sketch estimate and then the test on full sets."""
        sketches = classes.select("id", "sketch")
        met = (
            pairs.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sa")), "a")
            .join(sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sb")), "b")
            .withColumn("union", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, self.k))
            .withColumn("common", F.size(F.array_intersect("union", F.array_intersect("sa", "sb"))))
        )
        enough = F.when(F.size("union") < self.k, F.col("common") * 100 >= F.size("union") * self.percent).otherwise(
            F.col("common") >= self.needed
        )
        likely = self.scratch.keep(met.where(enough).select("a", "b"))
        if full is None:
            full = self.full_sets(likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct())
        met = likely.join(full.select(F.col("id").alias("a"), F.col("full").alias("full_a")), "a").join(
            full.select(F.col("id").alias("b"), F.col("full").alias("full_b")), "b"
        )
        out = self.scratch.keep(met.select("a", "b", "full_a", "full_b").mapInArrow(_confirm(self.percent), "a long, b long"))
        self.scratch.drop(likely, full)
        return out

    def star_pairs(self, lists: DataFrame, hubs: DataFrame) -> DataFrame:
        return (
            lists.join(hubs, "v").where((F.col("id") != F.col("hub")) & self._similar_size("n", "hub_n"))
            .select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
        )

    def open_pairs(self, lists: DataFrame, hubs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pairs of members of one hub's lists in different components, one of them outside the hub's, that
        bitmaps allow; and the full sets of these members."""
        names = labels.select(F.col("id").alias("hub"), F.col("component").alias("home"))
        placed = self.scratch.keep(
            lists.join(hubs.select("v", "hub"), "v").where("id <> hub").select("hub", "id").distinct()
            .join(labels, "id", "left").join(names, "hub", "left")
            .select("hub", "id", F.coalesce("component", "id").alias("component"), F.coalesce("home", "hub").alias("home"))
            .withColumn("outside", F.col("component") != F.col("home"))
        )
        size = lambda c: F.ceil(c / BLOCK).cast("int")
        groups = (
            placed.groupBy("hub").agg(F.count(F.lit(1)).alias("m"), F.count_if("outside").alias("o")).where("m > 1 and o > 0")
            .select("hub", size(F.col("m")).alias("ys"), size(F.col("o")).alias("xs"))
        )
        members = self.scratch.keep(placed.join(groups, "hub"))
        full = self.full_sets(members.select(F.col("id").alias("doc_id")).distinct())
        rows = members.join(full.mapInArrow(_parities, "id long, n long, parity binary"), "id")
        slot = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
        every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        told = ["id", "n", "component", "parity"]
        asking = rows.where("outside").select("hub", slot("xs").alias("x"), every("ys").alias("y"), F.lit(True).alias("asks"), *told)
        asked = rows.select("hub", every("xs").alias("x"), slot("ys").alias("y"), F.lit(False).alias("asks"), *told)
        grouped = asking.unionByName(asked).repartition("hub", "x", "y").sortWithinPartitions("hub", "x", "y")
        return grouped.mapInArrow(_sift(self.percent), "a long, b long").distinct(), full


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, k: int = SKETCH) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row.

    Texts are lower-cased in A-Z and split into words ``[^\\x20\\x09-\\x0D]+``; a document with
    fewer words than ``width`` has its whole sequence as one shingle. Documents are linked if
    100 * intersection >= ``percent`` * union of their sets; ``component_id`` is the smallest
    ``doc_id`` reachable by links, and ``kept`` marks the row that has it.

    Documents without words or text have an empty set, are linked with nothing and kept.
    Repeated rows get the same result each. A row without ``doc_id`` can't be named by others:
    it is linked with nothing, its component is null and it is kept. If a ``doc_id`` comes with
    several texts, the one with the smallest fingerprint is compared with other documents and
    all of them share its component. Columns other than ``doc_id`` and ``text``
    are ignored; an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession)
    rows = text_rows(docs)
    sketches = scratch.keep(rows.mapInArrow(_sketch(width, k), SKETCHES))
    usable = sketches.where("doc_id is not null and n_shingles > 0")
    sets = scratch.keep(usable.groupBy("f1", "f2").agg(F.min("doc_id").alias("id")))
    firsts = usable.select(F.col("doc_id").alias("id"), "f1", "f2", F.col("n_shingles").alias("n"), "sketch")
    speaking = sets.groupBy("id").agg(F.min(F.struct("f1", "f2")).alias("f")).select("id", "f.f1", "f.f2")
    classes = scratch.keep(firsts.join(speaking, ["id", "f1", "f2"], "left_semi").dropDuplicates(["id"]).select("id", "n", "sketch"))
    search = _Search(rows.where("doc_id is not null"), width, percent, k, scratch)
    lists = scratch.keep(search.lists(classes))
    hubs = scratch.keep(
        lists.groupBy("v").agg(F.max(F.struct("weight", (-F.col("id")).alias("minus"), "n")).alias("hub"), F.count(F.lit(1)).alias("m"))
        .where("m > 1").select("v", (-F.col("hub.minus")).alias("hub"), F.col("hub.n").alias("hub_n"))
    )
    links = search.links(search.star_pairs(lists, hubs), classes)
    labels = components(links, scratch)
    pairs, full = search.open_pairs(lists, hubs, labels)
    further = search.links(pairs, classes, full)
    if further.limit(1).count():
        labels = components(links.unionByName(further), scratch)
    named = sets.join(labels, "id", "left").select("f1", "f2", F.coalesce("component", "id").alias("component_id"))
    empty = F.col("n_shingles") == 0
    out = sketches.join(named, ["f1", "f2"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.when(empty, F.col("doc_id")).otherwise(F.col("component_id"))).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
