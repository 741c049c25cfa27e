"""Operators over a whole corpus against brute force: near duplicates, repeats, top-k, archives, totals, shards."""

import gzip
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusloom.llm import minhash, repeats, rollup, sharding, topk, warc
from locusloom.llm.components import components
from locusloom.llm.tables import Scratch


def shingle_sets(rows):
    found = {}
    for d, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        found[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return found


def brute_components(rows, percent):
    sets = shingle_sets(rows)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if common and 100 * common >= percent * union:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def near_corpus(rng):
    """Originals with copies of copies, near misses that share most text, short texts and common passages."""
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for _ in range(12):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 30, 120, 300]))]
        if rng.random() < 0.5:
            text = passage + text
        family = [text]
        for _ in range(rng.randint(1, 14)):
            copy = list(rng.choice(family))
            for _ in range(rng.choice([0, 1, 1, 2, 4, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            family.append(copy)
        rows += [" ".join(t) for t in family]
    rows += [None, "", " \n", "One two THREE", "one  two three", "É a b c d", "é a b c d"]
    rng.shuffle(rows)
    return list(enumerate(rows, 5))


@pytest.mark.parametrize("percent, block", [(85, 2048), (80, 3)])
def test_near_duplicates_equal_brute_force(documents, monkeypatch, percent, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_corpus(random.Random(percent))
    frame = documents(rows, {"n_shingles": F.lit("x"), "id": F.lit(1), "kept": F.lit(0)})
    got = {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(frame, 5, percent).collect()}
    assert got == brute_components(rows, percent)


def test_near_duplicates_of_odd_rows(documents):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (9, "A b c d e f"), (None, "a b c d e f"), (None, None), (3, None), (4, "x " * 50_000)]
    got = sorted(map(tuple, minhash.near_duplicates(documents(rows)).collect()), key=str)
    assert got == sorted(
        [(7, 2, 7, True), (7, 2, 7, True), (9, 2, 7, False), (None, 2, None, True), (None, 0, None, True), (3, 0, 3, True), (4, 1, 4, True)],
        key=str,
    )
    assert minhash.near_duplicates(documents([])).count() == 0


def test_needed_overlap_is_rarely_missed():
    rng = np.random.default_rng(1)
    for percent in (80, 85):
        needed = minhash.needed_overlap(minhash.SKETCH, percent)
        assert 15 < needed < minhash.SKETCH * percent / 100
        assert rng.binomial(minhash.SKETCH, percent / 100, 200_000).min() >= needed


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 200), (200, 300)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def letters(seed, n):
    return "".join(random.Random(seed).choices("abcdefg ", k=n))


def brute_repeats(rows, width):
    seen, out = set(), {}
    for d, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - width + 1):
            if raw[i : i + width] in seen:
                gone[i : i + width] = b"\1" * width
            seen.add(raw[i : i + width])
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        out[d] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def repeat_corpus(rng):
    passages = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (60, 100, 130, 400)]
    rows = []
    for d in range(60):
        parts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([0, 3, 50, 300])))]
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            parts += [p[rng.choice([0, 0, 7]) :], rng.choice(["", "x", "".join(rng.choice("abc") for _ in range(40))])]
        rows.append((d, "".join(parts)))
    return [*rows, (60, "a" * 700), (61, "a" * 99), (62, "ab" * 260), (63, rows[5][1]), (64, rows[5][1]), (65, None), (66, "é" * 120)]


@pytest.mark.parametrize("group", [2048, 1])
def test_repeats_equal_brute_force(documents, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = repeat_corpus(random.Random(4))
    got = {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(documents(rows, {"g": F.lit(1), "lo": F.lit("x")})).collect()}
    assert got == brute_repeats(rows, 100)


def test_repeats_of_odd_rows(documents):
    line = letters(9, 150)
    rows = [(1, line + "é"), (1, line + "é"), (2, "q" + line), (None, line), (None, None), (3, line * 2)]
    got = repeats.remove_repeats(documents(rows, {"extra": F.lit(5)}), with_text=True, carry=["extra", "lang"])
    found = sorted(((r["doc_id"], r["n_removed"], r["text"]) for r in got.collect()), key=str)
    assert found == sorted([(1, 0, line + "é"), (1, 0, line + "é"), (2, 150, "q"), (None, 0, line), (None, 0, ""), (3, 300, "")], key=str)
    assert got.columns == ["doc_id", "extra", "lang", "n_bytes", "n_removed", "n_spans", "text"]
    assert repeats.remove_repeats(documents([])).count() == 0


def test_a_cut_character_is_dropped_from_the_text(documents):
    line = letters(3, 99)
    got = repeats.remove_repeats(documents([(1, line + "é!"), (2, line + "è?")]), with_text=True)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: line + "é!", 2: "?"}  # the lead byte is shared, the rest is left over


def test_phrases_are_the_same_wherever_a_text_stands():
    from locusloom.llm import bytesops

    rng = np.random.default_rng(5)
    common = rng.integers(97, 110, 500).astype(np.uint8)
    codes = bytesops.byte_codes(False)
    cuts = []
    for lead in (0, 37, 400):
        data = np.concatenate([rng.integers(97, 110, lead).astype(np.uint8), common])
        g, h, lo, n = repeats.phrases(data, bytesops.Prefix(data, codes), 100)
        assert n.sum() == len(data) - 99 and (n <= 100 - repeats.GRAM + 1).all()
        inner = lo >= lead + 100
        cuts.append(list(zip(g[inner], h[inner], lo[inner] - lead)))
    assert cuts[0] == cuts[1] == cuts[2] and cuts[0]


def brute_top(rows, asked, k):
    vectors = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in vectors:
        if q in asked:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors if i != q and len(x) == len(y))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("query_block", [2048, 2])
def test_top_k_equals_brute_force(spark, monkeypatch, query_block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", query_block)
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, rows[10][1]) for i in range(15)]  # ties
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] + [1.0] * 5), (304, [float("inf")] + [1.0] * 5)]
    rows += [(400, [1.0, 2.0]), (401, [3.0, -1.0]), (402, [0.0, 0.0]), (None, [1.0] * 6)]
    asked = {0, 10, 205, 77, 300, 303, 400}
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).repartition(4)
    got = topk.top_k(frame, frame.where(F.col("vec_id").isin(list(asked))), 10)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, asked, 10)
    assert topk.top_k(frame, frame.limit(0), 10).count() == 0
    assert topk.top_k(frame.limit(0), frame.limit(0), 10).count() == 0


def test_top_k_keeps_large_components(spark):
    rows = [(i, [float(i % 7) - 3.0, 0.5, float(i % 5)]) for i in range(60)]
    rows += [(100, [2.0**21, 1.0, 0.0]), (101, [-(2.0**30), 0.0, 2.0**22]), (102, [2.0**20, 0.0, -(2.0**20)])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    scaled = {i: [int(1024 * c) for c in x] for i, x in rows}
    for asked in (5, 100):
        got = [tuple(r) for r in topk.top_k(frame, frame.where(F.col("vec_id") == asked), 8).orderBy("rank").collect()]
        found = sorted((-sum(a * b for a, b in zip(scaled[asked], x)), i) for i, x in scaled.items() if i != asked)[:8]
        assert got == [(asked, rank, i, -minus) for rank, (minus, i) in enumerate(found, 1)]
    # The large halves cancel: the sum fits, though neither product does.
    pair = spark.createDataFrame([(1, [2.0**35, -(2.0**35)]), (2, [2.0**35, 2.0**35])], "vec_id long, embedding array<double>")
    assert topk.top_k(pair, pair.where("vec_id = 1"), 1).first()["score"] == 0
    with pytest.raises(Exception, match="exceeds a long"):
        topk.top_k(pair.unionByName(pair.where("vec_id = 1").withColumn("vec_id", F.lit(3).cast("long"))), pair.where("vec_id = 1"), 1).collect()
    with pytest.raises(Exception, match="exceed a long"):
        topk.top_k(spark.createDataFrame([(1, [1.0, 2.0**52]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>"), frame, 1).collect()


PAGES = "page_id long, url string, html string"


def test_archive_round_trip(spark, tmp_path):
    body = "<p>" + "ä" * 200 + "</p>"
    rows = [(5, "http://a/\r\nX: y", body), (3, None, body), (9, "http://c", "short"), (11, "http://d", "short"), (12, "u", None), (3, "z", body)]
    rows += [(None, "n", body), (20, "http://e", "other" * 100), (21, "http://f", "WARC/1.1\r\n\r\nx" * 50)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("payload", F.lit(1)).repartition(3)
    place = str(tmp_path / "archive")
    warc.archive(pages, place)
    got = sorted(map(tuple, warc.page_summary(spark, place).collect()), key=str)
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = 3 if html == body and page == 5 else None
        want.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if first else "response", first))
    assert got == sorted(want, key=str)
    full = {r["record_id"]: r for r in warc.read(spark, place).collect()}
    assert bytes(full["<urn:page:21>"]["payload"]).decode() == rows[-1][2]
    assert full["<urn:page:5>"]["payload"] is None and full["<urn:page:5>"]["refers_to"] == "<urn:page:3>"
    assert warc.read(spark, place).where("target_uri like 'http://e%'").count() == 1
    assert warc.read(spark, place).where("record_id in ('<urn:page:9>', '<urn:page:11>')").count() == 2
    empty = str(tmp_path / "empty")
    warc.archive(pages.limit(0), empty)
    assert warc.page_summary(spark, empty).count() == 0


def test_filters_skip_payloads_and_manifests_name_files(tmp_path, monkeypatch):
    from pyspark.sql.datasource import EqualTo, IsNotNull

    row = {"record_type": "response", "record_id": "<urn:page:1>", "target_uri": "u", "refers_to": None, "payload_digest": "d", "payload_length": 500}
    one = warc.record(row | {"payload": b"x" * 500}, "2020-01-01T00:00:00Z")
    two = warc.record(row | {"record_type": "revisit", "record_id": "<urn:page:2>", "refers_to": "<urn:page:1>", "payload": None}, "2020-01-01T00:00:00Z")
    (tmp_path / "a.warc").write_bytes(one + two)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(two) + gzip.compress(one))
    reader = warc.WarcReader(str(tmp_path))
    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit"), IsNotNull(("record_id",))])) == [IsNotNull(("record_id",))]
    monkeypatch.setattr(warc, "decode_block", lambda *a: pytest.fail("decoded an unwanted payload"))
    found = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["record_id"] for r in found] == ["<urn:page:2>"] * 2
    (tmp_path / "x_files.json").write_text('["a.warc"]')
    assert [p.paths[0].rsplit("/", 1)[1] for p in reader.partitions()] == ["a.warc"]


COUNTS = "source string, lang string, tokenizer string, n_tokens long"


def test_rollup_adds_moves_and_takes_away_once(spark, tmp_path):
    totals = rollup.Rollup(spark, str(tmp_path / "rollup"))
    assert totals.totals().count() == 0
    load = spark.createDataFrame([("a", "en", "1", 10), ("a", "en", "1", 5), (None, "en", "1", None), ("b", "fr", "1", 7)], COUNTS)
    assert totals.commit("load", rollup.inserts(load.withColumn("n_docs", F.lit(99))))
    assert not totals.commit("load", rollup.inserts(load))
    old, new = (spark.createDataFrame([("a", "en", v, n)], COUNTS) for v, n in (("1", 5), ("2", 4)))
    assert totals.commit("revise", rollup.revisions(old, new))
    assert totals.commit("drop", rollup.deletes(load.where("source = 'b'")))
    assert totals.commit("none", rollup.inserts(load.limit(0)))
    want = [(None, "en", "1", 1, 0), ("a", "en", "1", 1, 10), ("a", "en", "2", 1, 4)]
    assert sorted(map(tuple, rollup.Rollup(spark, str(tmp_path / "rollup")).totals().collect()), key=str) == sorted(want, key=str)
    with pytest.raises(ValueError):
        totals.commit("../x", rollup.inserts(load))


def test_rollup_when_another_writer_was_first(spark, tmp_path, monkeypatch):
    totals = rollup.Rollup(spark, str(tmp_path / "rollup"))
    load = spark.createDataFrame([("a", "en", "1", 10)], COUNTS)
    totals.commit("load", rollup.inserts(load))
    answers = iter([False, True])
    monkeypatch.setattr(rollup.Rollup, "committed", lambda self, batch: next(answers))
    assert not totals.commit("load", rollup.inserts(load))
    assert totals.totals().first()["n_tokens"] == 10


def test_count_tokens(documents):
    got = rollup.count_tokens(documents([(1, "a  b\tc"), (2, None), (3, "")]), r"[^\x20\x09-\x0D]+", "w").collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {1: 3, 2: 0, 3: 0}


def test_table_is_even_and_moves_little():
    names = [f"s{i}" for i in range(16)]
    table = sharding.fill_table(names, 1009)
    sizes = [table.count(i) for i in range(16)]
    assert max(sizes) - min(sizes) <= 1
    fewer = sharding.fill_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 15)
    assert moved < 0.15 * 1009
    for bad in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.fill_table(*bad)


def test_place_puts_every_row(documents):
    names = [f"s{i}" for i in range(8)]
    rows = [(i, "x") for i in range(400)] + [(None, "y"), (5, "z")]
    got = sharding.place(documents(rows, {"slot": F.lit("q"), "shard": F.lit(1)}), ["doc_id"], names, 101).collect()
    table = sharding.fill_table(names, 101)
    assert len(got) == len(rows) and all(r["shard"] == names[table[r["slot"]]] for r in got)
    by_key = {}
    for r in got:
        by_key.setdefault(r["doc_id"], set()).add((r["slot"], r["shard"]))
    assert all(len(v) == 1 for v in by_key.values())
    assert all(s == sharding.name_hash(f"={k}") % 101 for k, v in by_key.items() if k is not None for s, _ in v)
    assert sharding.place(documents([]), ["doc_id", "source"], names, 101).count() == 0
