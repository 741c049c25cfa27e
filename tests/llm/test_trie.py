"""The prefix trie against nested dictionaries over whole turns."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
FIELDS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows, shared):
    own = {}
    for conv_id, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, digest(r[2], r[3]))):
        if conv_id is not None:
            own.setdefault(conv_id, []).append((role or "", text or ""))
    nodes = {}
    for c in sorted(own):
        turns = own[c]
        if shared:
            h = zlib.crc32(str(c).encode()) % 6
            turns = own.get(c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100)), [])[:h] + turns[h:]
        for d in range(len(turns) + 1):
            node = nodes.setdefault(tuple(turns[:d]), {"members": [], "ends": []})
            node["members"].append(c)
            if d == len(turns):
                node["ends"].append(c)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []

    def sums(path):
        below = [sums(p) for p in children.get(path, [])]
        n = nodes[path]["members"]
        leaves = sum(b[0] for b in below) or 1
        saved = (len(n) - 1) * (len(path[-1][1]) if path else 0) + sum(b[1] for b in below)
        parent = nodes[path[:-1]]["members"][0] if path else None
        ends = hashlib.sha256(",".join(map(str, nodes[path]["ends"])).encode()).hexdigest()
        out.append((n[0], len(path), parent, len(n), len(children.get(path, [])), leaves, saved, ends))
        return leaves, saved

    if nodes:
        sums(())
    return sorted(out)


def got(spark, rows, shared, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("block", "digest", "chars", "depth", "k1"):
        frame = frame.withColumn(name, F.lit("clash"))
    rebuild = trie.with_shared_openings if shared else trie.own_turns
    return sorted(tuple(r[f] for f in FIELDS) for r in trie.prefix_trie(frame, rebuild, **options).collect())


@pytest.mark.parametrize("shared", [False, True])
def test_random_conversations_equal_brute_force(spark, shared):
    rng = random.Random(4)
    rows = []
    for c in [*range(-130, 260, 3), 100, 0, 200, 900, 1005, 1 << 40]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hé😀", "", None, "b"])))
    rows += [(7, None, "system", "first"), (7, 2, "a", "tie"), (7, 2, "a", "tie"), (7, 2, "b", "tie"), (None, 0, "user", "nobody's"), (8, 0, "x", "y" * 70_000)]
    rng.shuffle(rows)
    assert got(spark, rows, shared) == brute(rows, shared)


def test_shards_of_two_conversations_and_long_shared_prefixes(spark):
    long = [(c, t, "user", f"turn {t}") for c in (1, 2, 205) for t in range(40)]
    rows = long + [(205, 40, "user", "more")] + [(c, 0, "user", "turn 0") for c in range(300, 340)] + [(c, 1, "user", str(c % 3)) for c in range(310, 340)]
    assert got(spark, rows, False, shard=2) == brute(rows, False)


def test_a_shard_of_more_nodes_than_a_batch(spark):
    rows = [(c, t, "user", f"{c} {t}" if t else "hello") for c in range(4000) for t in range(5)]
    assert got(spark, rows, False) == brute(rows, False)


def test_empty_table_and_turnless_conversations(spark):
    assert got(spark, [], True) == []
    rows = [(c, 0, "user", "only") for c in range(1, 30)]
    want = brute(rows, True)
    assert want[0][1] == 0 and got(spark, rows, True) == want


def test_result_types(spark):
    kinds = {f.name: f.dataType for f in trie.prefix_trie(spark.createDataFrame([(1, 0, "u", "t")], SCHEMA)).schema}
    assert kinds.pop("ends_sha256") == T.StringType() and set(kinds.values()) == {T.LongType()}
