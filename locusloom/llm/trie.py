"""Prefix trie of conversations by vertical bitmaps.

Turns become 128-bit digests where they are read, and conversations are dealt to tasks in ranges
of ids. A task takes them in *shards* of some thousand conversations. For each shard it indexes
every (position, turn) to the bitset of the conversations that have this turn there, and walks
the trie depth first: a node is the bitset of its members, the intersection with the posting of
the next turn of its first open member is a child, and what is in no posting ends here. So a
shard's nodes, member counts and end lists come from ANDs and popcounts of bitsets.

A node's key is the chained digest of its turns, alike in all shards, so Spark sums the shards'
nodes by key; shards hold ascending ids, so the end lists of a node are strung together in the
shards' order and hashed as they pass by, never held. A first turn that a third of all
conversations share is one row per shard. Sums over subtrees double their reach: after ``r``
rounds a node has the sums of all nodes less than ``2**r`` turns below it, which takes as many
rounds as the logarithm of the longest shared prefix. Only nodes of several members take part;
those of one are chains with known sums.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusloom.llm.tables import Scratch

SHARD = 4096
TURNS = 16
ROOT = (0, 0)
NODES = "k1 long, k2 long, p1 long, p2 long, depth long, first long, n long, chars long, shard long, ends binary"
NO_IDS = hashlib.sha256(b"").hexdigest()

Turn = tuple[bytes, int]
Rebuild = Callable[[int, list[Turn], list[Turn]], list[Turn]]


def own_turns(conv_id: int, base: list[Turn], own: list[Turn]) -> list[Turn]:
    return own


def _key(parent: tuple[int, int], digest: bytes) -> tuple[int, int]:
    return struct.unpack("<qq", hashlib.blake2b(struct.pack("<qq", *parent) + digest, digest_size=16).digest())


def shard_nodes(convs: list[tuple[int, list[Turn]]]) -> Iterator[tuple]:
    """``(key, parent key, depth, smallest member, members, characters, end list)`` of a shard's trie, ids ascending."""
    postings: dict[tuple[int, bytes], int] = {}
    ends: dict[int, int] = {}
    for i, (_, turns) in enumerate(convs):
        for place, (digest, _) in enumerate(turns):
            postings[place, digest] = postings.get((place, digest), 0) | 1 << i
        ends[len(turns)] = ends.get(len(turns), 0) | 1 << i
    ids = [c for c, _ in convs]

    def lowest(bits: int) -> int:
        return (bits & -bits).bit_length() - 1

    stack = [(ROOT, (None, None), 0, (1 << len(convs)) - 1, 0)]
    while stack:
        key, parent, depth, members, chars = stack.pop()
        ending = rest = members & ends.get(depth, 0)
        listed = []
        while rest:
            listed.append(ids[lowest(rest)])
            rest &= rest - 1
        yield key, parent, depth, ids[lowest(members)], members.bit_count(), chars, ",".join(map(str, listed)).encode()
        left = members & ~ending
        while left:
            digest, length = convs[lowest(left)][1][depth]
            child = left & postings[depth, digest]
            stack.append((_key(key, digest), key, depth + 1, child, length))
            left &= ~child


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, list[Turn]]]]]:
    """Blocks of rows sorted by (block, conv_id, turn), each with its conversations in order."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("block", "conv_id", "digest", "chars")))

    for block, held in groupby(rows(), lambda r: r[0]):
        yield block, [(c, [(d, n) for _, _, d, n in turns]) for c, turns in groupby(held, lambda r: r[1])]


def _nodes(rebuild: Rebuild, shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(convs: list[tuple[int, list[Turn]]]) -> Iterator[pa.RecordBatch]:
            found = shard_nodes(convs)
            while rows := list(islice(found, 8192)):
                longs = [[r[0][0] for r in rows], [r[0][1] for r in rows], [r[1][0] for r in rows], [r[1][1] for r in rows]]
                longs += [[r[i] for r in rows] for i in range(2, 6)] + [[convs[0][0]] * len(rows)]
                columns = [pa.array(c, pa.int64()) for c in longs] + [pa.array([r[6] or None for r in rows], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in NODES.split(", ")])

        held: list[tuple[int, list[Turn]]] = []
        size = 0
        for block, convs in _blocks(batches):
            base = next((turns for c, turns in convs if c == block), [])
            for c, own in convs:
                turns = rebuild(c, base, own)
                if held and (len(held) == shard or size + len(turns) > TURNS * shard):
                    yield from out(held)
                    held, size = [], 0
                held.append((c, turns))
                size += len(turns)
        if held:
            yield from out(held)

    return run


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's end lists, read in the order of their shards."""
    key, state = None, None
    for batch in batches:
        done = []
        for k1, k2, ends in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ends"))):
            if (k1, k2) == key:
                state.update(b",")
            else:
                if state:
                    done.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256()
            state.update(ends)
        yield _hashed(done)
    if state:
        yield _hashed([(*key, state.hexdigest())])


def _hashed(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    one, two, text = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(text, pa.string())], ["k1", "k2", "ends_sha256"])


def _subtree_sums(shared: DataFrame, scratch: Scratch) -> DataFrame:
    """``(k1, k2, n_leaves, saved_tokens)`` of nodes ``(k1, k2, p1, p2, depth, leaves, saved)``, closed under parents."""
    depth = shared.agg(F.max("depth")).first()[0] or 0
    now = shared.select("k1", "k2", "depth", F.col("p1").alias("a1"), F.col("p2").alias("a2"), "leaves", "saved")
    reach, kept = 1, []
    while reach <= depth:
        # a1, a2: the ancestor ``reach`` turns above, null over the root; sums: of less than ``reach`` turns below
        given = now.where(F.col("depth") >= reach).groupBy("a1", "a2").agg(F.sum("leaves").alias("more"), F.sum("saved").alias("most"))
        far = now.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
        given = given.withColumnsRenamed({"a1": "k1", "a2": "k2"})
        step = scratch.keep(
            now.join(given, ["k1", "k2"], "left").join(far, ["a1", "a2"], "left").select(
                "k1", "k2", "depth", F.col("b1").alias("a1"), F.col("b2").alias("a2"),
                (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("most", F.lit(0))).alias("saved"),
            )
        )
        scratch.drop(*kept)
        now, kept, reach = step, [step], 2 * reach
    return now.select("k1", "k2", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def turn_digests(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, digest, chars)``: a turn's role and text as one digest, and its text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole: Column = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(whole.cast("binary"))).alias("digest"), F.char_length(text).cast("long").alias("chars"),
    )


def prefix_trie(conversations: DataFrame, rebuild: Rebuild = own_turns, block: int = 100, shard: int = SHARD) -> DataFrame:
    """Nodes of the trie of all conversations: one row per distinct sequence of first turns.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``:
    the smallest member, which with the depth names a node; the parent's; members; children;
    childless nodes below or here; characters of last turns below and here that are stored again
    for each further member; and the SHA-256 of the comma-joined ids that end here, ascending.
    ``rebuild(conv_id, base, own)`` may put a conversation together from its own turns and those
    of the block's first conversation, ``conv_id - conv_id % block``.

    Turns go by ``turn``, null first, and turns of one number by their digest; repeated rows are
    turns of their own. A null role or text is empty. Rows without ``conv_id`` belong to no
    conversation and are left out; other columns are ignored; an empty table has no nodes, not
    even a root. Texts of any length count by digest and length, so only these travel. A task
    holds the digests of a block, and of a shard of up to ``shard`` conversations and ``TURNS`` times as many turns.
    """
    scratch = Scratch(conversations.sparkSession)
    turns = turn_digests(conversations).withColumn("block", F.expr(f"conv_id - conv_id % {block}"))
    placed = turns.repartitionByRange("block").sortWithinPartitions("block", "conv_id", F.asc_nulls_first("turn"), "digest")
    parts = scratch.keep(placed.select("block", "conv_id", "digest", "chars").mapInArrow(_nodes(rebuild, shard), NODES))
    same = [F.max(c).alias(c) for c in ("p1", "p2", "depth", "chars")]
    nodes = scratch.keep(parts.groupBy("k1", "k2").agg(F.min("first").alias("first"), F.sum("n").alias("n"), *same))
    ends = parts.where("ends is not null").select("k1", "k2", "shard", "ends").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "shard")
    hashed = ends.select("k1", "k2", "ends").mapInArrow(_end_hashes, "k1 long, k2 long, ends_sha256 string")
    of_parent = {"p1": "k1", "p2": "k2"}
    children = nodes.where("depth > 0").groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n") == 1).alias("lone"))
    known = scratch.keep(nodes.join(children.withColumnsRenamed(of_parent), ["k1", "k2"], "left"))
    # A node of one member is on a chain of such nodes, with one leaf at its end; its top counts for the parent.
    shared = known.where("n > 1 or depth = 0").select(
        "k1", "k2", "p1", "p2", "depth",
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("lone")).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved"),
    )
    sums = _subtree_sums(shared, scratch)
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("first").alias("parent_conv_id"))
    return (
        known.join(parents, ["p1", "p2"], "left").join(hashed, ["k1", "k2"], "left").join(sums, ["k1", "k2"], "left")
        .select(
            F.col("first").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"),
        )
    )


def with_shared_openings(conv_id: int, base: list[Turn], own: list[Turn]) -> list[Turn]:
    """The first ``crc32(conv_id) % 6`` turns of the base conversation, then the own turns after as many."""
    n = zlib.crc32(str(conv_id).encode()) % 6
    return base[:n] + own[n:]
