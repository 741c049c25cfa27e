"""Collocations against counters over whole texts."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from locusloom.llm import collocations

FIELDS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, percent, top):
    counts, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, words[i : i + k]) for i in range(len(words) - k + 1))
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in found.items():
        inside = lambda p: any(p[i : i + len(words)] == words for i in range(len(p) - len(words) + 1))
        if any(other == lang and len(p) > len(words) and inside(p) and 100 * b >= percent * a for (other, p), b in found.items()):
            continue
        cuts = [(2000000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, total[lang], -score)
        for lang, some in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(some)[:top], 1)
    )


def got(frame, *options):
    return sorted(tuple(r[f] for f in FIELDS) for r in collocations.collocations(frame, *options).collect())


def corpus(seed, n):
    rng = random.Random(seed)
    some = ["The", "the", "of", "é", "日本", "\x85x", "a\x00b", "n\xa0o", "zz", "Quick", "fox"]

    def text():
        words = rng.choices(some, weights=[9, 9, 6, 2, 2, 1, 1, 1, 2, 3, 3], k=rng.choice([0, 1, 2, 8, 60]))
        return "".join(w + rng.choice([" ", " ", "\t", "  ", ", ", ".\n", "\x0b", ":"]) for w in words) + rng.choice(["", " quick brown fox jumps"])

    return [(i, text(), rng.choice(["en", "en", "en", None, "und", "fr"])) for i in range(n)]


def test_random_texts_equal_brute_force(documents, monkeypatch):
    rows = corpus(1, 150) + [(None, None, "en"), (3, "", None), (3, "same same same same same", "de"), (3, "same same same same same", "de")]
    clash = {"segment": F.lit("x"), "n": F.lit(1.5), "a": F.lit(0), "w1": F.lit("q"), "counts": F.lit(2)}
    want = brute(rows, 4, 80, 40)
    assert len({w[0] for w in want}) == 4
    assert got(documents(rows, clash), 4, 80, 40) == want
    monkeypatch.setattr(collocations, "HOT", 4)
    assert got(documents(rows), 4, 80, 40) == want


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "one", "en")], [(1, "a b . c", "en")]])
def test_small_tables(documents, rows):
    assert got(documents(rows), 2, 80, 10) == []


def test_long_text_and_ties(documents):
    rows = [(1, "x y z w " * 30_000, "en"), (2, "b a, b a, d c, d c", "en")]
    assert got(documents(rows), 2, 80, 5) == brute(rows, 2, 80, 5)


def test_words_of_one_hash_are_noticed(spark):
    schema = "lang string, segment int, nexts array<long>, counts array<long>, words array<string>"
    stripes = spark.createDataFrame([("en", 0, [5, 6], [1, 2], ["ab", "x"]), ("en", 0, [5], [1], ["cd"]), ("fr", 0, [5], [4], ["cd"])], schema)
    merged = {r["lang"]: r for r in collocations._merged(stripes, ["lang"], 1).collect()}
    assert (merged["en"]["spellings"], merged["en"]["total"]) == (2, 4) and merged["fr"]["spellings"] == 1


def test_rows_of_stripes_do_not_grow_with_the_frequent_phrases():
    """A piece has a row per language and segment, though thousands of its prefixes are frequent."""
    words = np.random.default_rng(1).integers(0, 3000, 60000)
    batch = pa.record_batch({"lang": ["en"], "text": [" ".join(f"w{n}" for n in words)]})

    class All:
        value = np.full(collocations.BITS >> 16, 255, np.uint8)

    schema = "lang string, segment int, w1 array<long>, w2 array<long>, nexts array<long>, counts array<long>"
    rows = [r for b in collocations._stripes(0, 2, All, np.zeros(0, np.uint64))([batch]) for r in b.to_pylist()]
    assert list(rows[0]) == [c.split()[0] for c in schema.split(", ")]
    assert len(rows) == len({r["segment"] for r in rows}) <= collocations.STRIPES < 59000
    assert sum(sum(r["counts"]) for r in rows) == len(words) - 1


@pytest.mark.parametrize("one_hash", [False, True])
def test_stripes_are_merged_without_a_row_per_entry(spark, monkeypatch, one_hash):
    """What leaves the merge are a total per prefix and frequent extensions, also if prefixes share a hash."""
    if one_hash:
        monkeypatch.setattr(collocations, "phrase_hashes", lambda seeds, words: np.zeros(len(words[0]), np.uint64))
    rng = random.Random(2)
    rows, want, total = [], Counter(), Counter()
    for segment, lang in [(0, "en"), (0, "fr"), (1, "en")]:
        for _ in range(4):
            entries = [(rng.choice([7, -8]), rng.choice([segment, -9]), rng.choice([0, -3, -3, -3, 5, 5, 5, *range(100, 160)]), rng.randint(1, 3)) for _ in range(150)]
            rows.append((lang, segment, *(list(c) for c in zip(*entries))))
            for w1, w2, after, n in entries:
                total[lang, segment, w1, w2] += n
                want[lang, segment, w1, w2, after] += n
    batch = pa.RecordBatch.from_pylist([dict(zip(["lang", "segment", "w1", "w2", "nexts", "counts"], r)) for r in sorted(rows, key=lambda r: r[:2])])
    left = [k[:1] + k[2:] + (n,) for k, n in want.items() if n >= 12 and k[-1]] + [k[:1] + k[2:] + (0, n) for k, n in total.items()]
    out = [r for b in collocations._sums(2, 12)(batch.slice(i, 5) for i in (0, 5, 10)) for r in b.to_pylist()]
    assert sorted(tuple(r.values()) for r in out) == sorted(left) and 12 < len(left) < len(want) / 10
    if not one_hash:
        schema = "lang string, segment int, w1 array<long>, w2 array<long>, nexts array<long>, counts array<long>"
        merged = collocations._extensions(spark.createDataFrame(rows, schema).repartition(3), 2, 12)
        assert sorted(map(tuple, merged.collect())) == sorted(left)
        assert "Generate" not in merged._jdf.queryExecution().toString()
