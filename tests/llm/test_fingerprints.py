"""Threshold-scaled fingerprints against a plain version that sees all texts at once."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusloom.llm import fingerprints


def plain_sketch(text):
    """Retained hashes of one text, from a set of its shingles."""
    import pyarrow as pa

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    # A shingle alone is a text of its own, whose one hash is its sketch.
    hashes = sorted(int(fingerprints.sketches(pa.array([" ".join(s)]))[0][0]) for s in shingles)
    below = [h for h in hashes if h < (1 << 64) // fingerprints.SCALE]
    return below if len(below) >= fingerprints.LEAST else hashes[: fingerprints.LEAST]


def brute(rows, sketch=plain_sketch):
    """Expected rows of ``(doc_id, text)`` with ids, from one sorted list."""
    ring = sorted(rows, key=lambda r: (-r[0], r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(ring):
        text, after = text or "", ring[(i + 1) % len(ring)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed, other = (np.array(sketch(t), np.uint64) for t in (text, edited, after))
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
            base64.b64encode(own.astype("<u8").tobytes()).decode(), base64.b64encode(changed.astype("<u8").tobytes()).decode(),
            fingerprints.containment(own, changed), fingerprints.containment(own, other),
        ))
    return sorted(out)


FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def words(rng, n):
    return " ".join(rng.choice(["Ab", "b", "cé", "d", "日本", "f😀", "gg"]) + str(rng.randrange(9)) for _ in range(n))


def test_edited_fingerprints_equal_brute_force(documents):
    rng = random.Random(5)
    texts = [words(rng, rng.choice([0, 1, 3, 5, 9, 40, 300, 1500])) for _ in range(60)]
    rows = [(7 * i - 100, t) for i, t in enumerate([*texts, None, "", "x" * 100_000, texts[3], texts[3]])]
    clash = {"part": F.lit(1), "kind": F.lit("a"), "fingerprint": F.lit(2.0), "first": F.lit(0)}
    got = fingerprints.edited_fingerprints(documents(rows, clash)).collect()
    assert sorted(tuple(r[f] for f in FIELDS) for r in got) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(3, "one two")], [(3, None)], [(2, "a b c d e f g h"), (9, "A b c d e f g i")]])
def test_small_tables(documents, rows):
    got = fingerprints.edited_fingerprints(documents(rows)).collect()
    assert sorted(tuple(r[f] for f in FIELDS) for r in got) == (brute(rows) if rows else [])


def test_rows_without_id_and_repeated_rows(documents):
    rows = [(None, "p q r s t u"), (None, None), (5, "a b c d e f"), (5, "a b c d e f"), (5, "z"), (1, "k l m n o p q")]
    got = fingerprints.edited_fingerprints(documents(rows)).collect()
    alone = [r for r in got if r["doc_id"] is None]
    assert sorted(r["n_chars"] for r in alone) == [0, 11] and all(r["near_edited"] == 1 and r["near_next"] is None for r in alone)
    assert all(r["fingerprint"] == r["edited_fingerprint"] for r in alone)
    named = sorted(tuple(r[f] for f in FIELDS) for r in got if r["doc_id"] is not None)
    assert named == brute([r for r in rows if r[0] is not None])


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = fingerprints.edited_fingerprints(docs).collect()
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == [r[:3] for r in brute(rows, sketch=lambda t: [])]
    assert np.mean([r["near_edited"] > r["near_next"] for r in got]) > 0.9


def test_merging_gives_the_sketch_of_the_union_and_containment_is_close(spark, documents):
    rng = random.Random(9)
    part, long = words(rng, 900), words(rng, 20_000)
    rows = [(0, part), (1, long), (2, part + " . " + long), (3, words(rng, 30))]
    got = {r["doc_id"]: fingerprints.unpacked(r["fingerprint"]) for r in fingerprints.fingerprints(documents(rows)).collect()}
    union = fingerprints.merge(got[0], got[1])
    assert np.isin(union, got[2]).all()  # all but shingles across the seam
    assert fingerprints.merge(union, got[2]).tolist() == got[2].tolist()
    assert fingerprints.merge(got[3], got[3]).tolist() == got[3].tolist()
    assert fingerprints.containment(got[0], got[2]) == 1.0
    assert fingerprints.containment(got[0], got[1]) < 0.1
    assert abs(fingerprints.containment(got[2], got[1]) - 0.957) < 0.05
