"""Operators on whole texts: byte helpers, encoding, language, toxicity, decontamination."""

import math
import random
import uuid
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from locusloom.llm import bpe, bytesops, decontaminate, langid, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\t", "don't we''ll 'sup it's 's 'S x's 12½³ Áé ΑΣ ΣΑΣ İstanbul ẞ", "<|endoftext|>hi<|startoftext|> <|endoftext|",
    "日本語テキスト 漢字😀😀 ﬁ ﬀ", "\x1c\x1d a\x85b\xa0c​d e", "a" * 5000, "ab" * 3000 + " the", "'" * 7 + "s", "'re're'll'dd 're",
    "x" * 300 + "!?…" * 50, "\u0000 ﻿ z", "ᾳ ǅ Ⅷ ٣ ७", "aaaaaaa aaaaaaaa aaaaaaaaa", "’s o’clock", "é ́x",
]


@pytest.fixture(scope="module")
def tables():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Tables(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_word_and_shingle_hashes_tell_rows_apart():
    texts = pa.array(["A b c", "a  B\tc", "a bc", "", None, "a b c d e f", "x a b c d e f y", "\x85a b"])
    rows = list(bytesops.shingle_rows(texts, 5, bytesops.space_words()))
    assert [len(r) for r in rows] == [1, 1, 1, 0, 0, 2, 4, 1]
    assert rows[0] == rows[1] and rows[0] != rows[2]
    assert set(rows[5]) <= set(rows[6])
    sliced = list(bytesops.shingle_rows(texts.slice(5, 2), 5, bytesops.space_words()))
    assert [s.tolist() for s in sliced] == [r.tolist() for r in rows[5:7]]


def test_round_trip_equals_the_library(documents, library):
    got = bpe.round_trip(documents(list(enumerate(ODD)), {"ids": F.lit(1), "decoded": F.lit("x")}), PATH).collect()
    assert len(got) == len(ODD)
    for row in got:
        want = library.encode(ODD[row["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(row["ids"], "<u4").tolist() == want and row["n_tokens"] == len(want)
        assert row["decoded"] == library.decode(want, skip_special_tokens=False)


def test_round_trip_on_given_documents(spark, library, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in bpe.round_trip(docs, PATH).collect():
        assert np.frombuffer(row["ids"], "<u4").tolist() == library.encode(texts[row["doc_id"]], add_special_tokens=False).ids


@given(st.text(alphabet="abcdestholinr'é", max_size=40))
@settings(max_examples=200, deadline=None)
def test_words_encode_as_the_library(tables, library, text):
    words = [w for w in bpe.normalized(text).replace("'", " ").split() if w]
    for word, tokens in zip(words, tables.encode_words(words) if words else []):
        assert tokens.tolist() == library.encode(word, add_special_tokens=False).ids == tables.merge(symbols(tables, word))


def symbols(tables, word):
    raw = np.frombuffer(word.encode(), np.uint8)
    return [*tables.inner[raw[:-1]].tolist(), int(tables.final[raw[-1]])]


def test_pairs_are_compatible_exactly_if_they_encode_to_themselves(tables):
    rng = np.random.default_rng(3)
    tokens = rng.choice(np.flatnonzero(tables.born >= 0), (400, 2))
    word_end = np.array([tables.strings[t].endswith("</w>") for t in tokens[:, 0]])
    tokens = tokens[~word_end]

    def leaves(t):
        return [t] if tables.born[t] < 0 else leaves(tables.left[t]) + leaves(tables.right[t])

    for (a, b), good in zip(tokens, tables.compatible(tokens[:, 0], tokens[:, 1])):
        assert good == (tables.merge([int(x) for x in leaves(a) + leaves(b)]) == [a, b])


def sentences(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_language_of_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = langid.held_out_identification(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(found) > 10 and (found["lang"] == found["lang_pred"]).mean() > 0.9
    assert found["score"].between(0, 1).all()


def test_language_cases(documents):
    rng = random.Random(1)
    english, spanish = "the house and over there with some water".split(), "la casa y sobre con algo más aquí ñandú".split()
    rows = [(i, sentences(rng, *((english, 30) if i % 2 else (spanish, 30))), "en" if i % 2 else "es") for i in range(60)]
    model = langid.learn(documents(rows))
    assert set(model) == {"en", "es"}
    odd = [(1, None), (2, ""), (3, "12 .. ½ $"), (None, "the house and there"), (5, "casa sobre más algo"), (5, "casa sobre más algo")]
    got = sorted(map(tuple, langid.identify(documents(odd, {"score": F.lit(9), "rejected": F.lit("?")}), model).collect()), key=str)
    by_id = {}
    for doc, lang, score, rejected in got:
        by_id.setdefault(doc, []).append((lang, rejected, score))
    assert [by_id[i][0] for i in (1, 2, 3)] == [("und", True, 0.0)] * 3
    assert by_id[None][0][0] == "en" and len(by_id[5]) == 2 and by_id[5][0] == by_id[5][1] and by_id[5][0][0] == "es"
    assert [r[0] for r in langid.accepted(documents(odd), model).select("doc_id").collect()].count(5) == 2
    empty = documents([])
    assert langid.learn(empty) == {} and langid.identify(empty, {}).count() == 0
    assert langid.identify(documents([(1, "casa")]), {}).first()["lang_pred"] == "und"


def test_toxicity_learns_marked_words(documents, spark):
    rng = random.Random(2)
    plain, bad = [f"word{i}" for i in range(80)], ["vile", "rotten"]
    rows, marks = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(20, 200))]
        if toxic:
            for _ in range(3):
                words.insert(rng.randint(0, len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "vile rotten"), (1003, "vile " * 20000), (1003, "vile " * 20000)]
    labels = spark.createDataFrame([*marks, (1000, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.held_out_scores(documents(rows, {"score": F.lit(1), "toxic": F.lit(0), "held_out": F.lit(1)}), labels).toPandas()
    assert len(got) == len(rows) and got["score"].between(0, 1).all()
    known = got[got["doc_id"] < 600]
    wrong = ((known["predicted"] == 1) != (known["doc_id"] % 4 == 0))[known["held_out"]].mean()
    assert wrong < 0.05
    assert (got[got["doc_id"] == 1003]["predicted"] == 1).all()
    none = toxicity.held_out_scores(documents(rows), spark.createDataFrame([], "doc_id long, toxic int"))
    assert none.agg(F.max("score")).first()[0] == 0
    assert toxicity.held_out_scores(documents([]), labels).count() == 0


class PlainModel:
    """The two Kneser-Ney models over dictionaries, from ``(words, toxic)`` of whole texts."""

    def __init__(self, texts):
        grams = {c: {(w[j - 2] if j > 1 else None, w[j - 1], w[j]) for w, t in texts if t == c for j in range(1, len(w))} for c in (0, 1)}
        self.pairs = {c: Counter((v, w) for _, v, w in grams[c]) for c in (0, 1)}
        self.words = {x for c in (0, 1) for p in self.pairs[c] for x in p}
        self.after = {c: Counter(w for _, w in self.pairs[c]) for c in (0, 1)}
        self.context = {c: Counter() for c in (0, 1)}
        self.kinds = {c: Counter(v for v, _ in self.pairs[c]) for c in (0, 1)}
        for c in (0, 1):
            for (v, _), n in self.pairs[c].items():
                self.context[c][v] += n

    @staticmethod
    def less(counts):
        ones, twos = (sum(n == k for n in counts.values()) for k in (1, 2))
        return ones / (ones + 2 * twos) if ones else 0.5

    def log(self, c, v, w, strength):
        less, total = self.less(self.after[c]), sum(self.after[c].values())
        unigram = max(self.after[c][w] - less, 0) / total + less * len(self.after[c]) / total / len(self.words) if w in self.words else 1 / len(self.words)
        less = self.less(self.pairs[c])
        found = max(self.pairs[c][v, w] - less, 0)
        return math.log((found + (less * self.kinds[c][v] + strength) * unigram) / (self.context[c][v] + strength))

    def evidence(self, words, strength):
        each = [self.log(1, v, w, strength) - self.log(0, v, w, strength) for v, w in zip([None, *words], words)]
        peak = max((sum(each[i : i + toxicity.WINDOW]) for i in range(len(each))), default=0) / toxicity.WINDOW
        return sum(each) / max(1, len(each)), peak


def test_toxicity_equals_dictionaries_and_counts_every_labelled_row(documents, spark, monkeypatch):
    rows = [(i, f"start{i % 7} alpha{i} beta{i % 50} gamma{i % 3}" + (" vile rot" if i % 10 == 0 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    part = (F.col("doc_id") % 4 == 3).cast("int") + F.when(F.col("doc_id") % 20 == 10, 1).otherwise(0)
    counted = [(t.split(), int(i % 10 == 0)) for i, t in rows if i % 4 != 3 and i % 20 != 10]
    plain = PlainModel(counted)
    texts = [*rows, (None, ""), (900, None), (901, "vile rot " * 50), (901, "vile rot " * 50), (902, "Never seen START1 alpha4")]

    def scores(learned):
        assert (learned.held.value.shape["pairs"], learned.held.value.shape["words"]) == (len(plain.pairs[0] | plain.pairs[1]), len(plain.words))
        assert learned.held.value.shape["ordinary"] == sum(plain.pairs[0].values())
        got = toxicity.score(documents(texts), learned).toPandas().fillna(-1).itertuples(index=False, name=None)
        return sorted(got)

    learned = toxicity.learn(documents(rows), labels, part, sample=5)
    base, mean, peak = learned.curve
    want = []
    for i, t in texts:
        m, p = plain.evidence((t or "").lower().split(), learned.strength)
        want.append((-1 if i is None else i, 1 / (1 + math.exp(-max(-30, min(30, base + mean * m + peak * p))))))
    want.sort()
    got = scores(learned)
    assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-6)
    # All counts shared: a slot of one key has its count, so the scores are the same. And hot pairs spread over tasks.
    monkeypatch.setattr(toxicity, "HOT", 1 << 20)
    monkeypatch.setattr(toxicity, "SHARED", 1 << 22)
    shared = toxicity.learn(documents(rows), labels, part, sample=5, whole=1)
    assert len(shared.held.value.pairs.keys) <= 1 and shared.held.value.pairs.marks is not None
    assert np.allclose([g[1] for g in scores(shared)], [w[1] for w in want], atol=1e-6)


def contained(docs, items):
    def words(t):
        out, held = [], ""
        for c in (t or "") + " ":
            if c.isascii() and not c.isalnum():
                out += [held] if held else []
                held = ""
            else:
                held += c.lower() if c.isascii() else c
        return out

    def shingle(t):
        w = words(t)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    found = set()
    for d, text in docs:
        for i, item in items:
            s = shingle(item)
            if s and 100 * len(s & shingle(text)) >= 80 * len(s):
                found.add((d, i, len(s), len(s & shingle(text))))
    return found


def test_contained_items_equal_brute_force(documents, spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "naïve"]
    items = [(i, sentences(rng, vocabulary, n)) for i, n in enumerate([1, 3, 5, 6, 12, 40, 300, 900])]
    docs = []
    for d in range(60):
        parts = [sentences(rng, vocabulary, rng.randint(0, 80))]
        for _, text in rng.sample(items, 2):
            cut = text.split()
            parts.append(" ".join(cut[: int(len(cut) * rng.choice([0.6, 0.85, 1.0])) or 1]).upper())
        docs.append((d, ", ".join(parts)))
    docs += [(100, None), (101, ""), (102, items[1][1]), (103, items[5][1]), (103, items[5][1])]
    frame = spark.createDataFrame([*items, (50, None), (51, "..."), (None, "w1 w2 w3 w4 w5")], "item_id long, text string")
    want = contained(docs, items)
    for block in (2_000_000, 50):
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        got = decontaminate.contained_items(documents(docs, {"n_item": F.lit(0), "item_id": F.lit(1)}), frame)
        assert set(map(tuple, got.collect())) == want and got.count() == len(want)
        left = {r[0] for r in decontaminate.decontaminate(documents([*docs, (None, "w1")]), frame).select("doc_id").collect()}
        assert left == {d for d, _ in docs} - {w[0] for w in want} | {None}
    assert decontaminate.contained_items(documents([]), frame).count() == 0
    assert decontaminate.contained_items(documents(docs), frame.limit(0)).count() == 0


def test_trigrams_of_a_bucket_share_a_row_and_hot_words_are_spread():
    rng = np.random.default_rng(3)
    text = " ".join(f"w{n}" for n in rng.integers(0, 400, 9000)) + " hot" + "".join(f" a{n} hot" for n in range(900))
    batch = pa.record_batch({"text": [text], "toxic": pa.array([1], pa.int32())})
    hot = toxicity.word_hashes(pa.array(["hot"]))[0]
    rows = [r for b in toxicity._grams(hot, 0)([batch]) for r in b.to_pylist()]
    assert len(rows) == len({r["bucket"] for r in rows}) <= toxicity.BUCKETS
    found = [(r["bucket"], *t) for r in rows for t in zip(r["v"], r["w"], r["u"], r["tag"], strict=True)]
    words = toxicity.word_hashes(pa.array([text]))[0].view(np.int64).tolist()
    assert len(found) == len({t[1:4] for t in found}) and {t[1:4] for t in found} == set(zip(words[:-1], words[1:], [0, *words]))
    after = {v: {t[0] for t in found if t[1] == v} for v in {t[1] for t in found}}
    assert len(after.pop(int(hot.view(np.int64)[0]))) > 500 and all(len(b) == 1 for b in after.values())


def test_toxicity_has_own_counts_for_rare_words_and_pairs(documents, spark, monkeypatch):
    """With room for one word and pair in the model all others are looked up, and none has another's count."""
    monkeypatch.setattr(toxicity, "BITS", 1 << 15)
    rows = [(i, f"start{i % 7} alpha{i} beta{i % 50} gamma{i % 3}" + (" vile rot" if i % 10 == 0 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    part = (F.col("doc_id") % 4 == 3).cast("int") + F.when(F.col("doc_id") % 20 == 10, 1).otherwise(0)
    plain = PlainModel([(t.split(), int(i % 10 == 0)) for i, t in rows if i % 4 != 3 and i % 20 != 10])
    texts = [*rows, (None, ""), (900, None), (901, "vile rot " * 50), (901, "vile rot " * 50), (902, "Never seen START1 alpha4")]
    learned = toxicity.learn(documents(rows), labels, part, sample=5, own=1)
    assert len(learned.held.value.pairs.keys) <= 1 and len(learned.held.value.words.keys) <= 1
    base, mean, peak = learned.curve
    want = []
    for i, t in texts:
        m, p = plain.evidence((t or "").lower().split(), learned.strength)
        want.append((-1 if i is None else i, 1 / (1 + math.exp(-max(-30, min(30, base + mean * m + peak * p))))))
    got = sorted(toxicity.score(documents(texts), learned).toPandas().fillna(-1).itertuples(index=False, name=None))
    assert [g[0] for g in got] == [w[0] for w in sorted(want)] and np.allclose([g[1] for g in got], [w[1] for w in sorted(want)], atol=1e-6)
    assert toxicity.score(documents([]), learned).count() == 0
    # Groups that are cut otherwise when the texts are read again find no answers and go through the buckets.
    name = toxicity.lookup._name
    monkeypatch.setattr(toxicity.lookup, "_name", lambda keys: name(keys) + uuid.uuid4().hex)
    again = sorted(toxicity.score(documents(texts), learned).toPandas().fillna(-1).itertuples(index=False, name=None))
    assert np.allclose(again, got, atol=1e-12)
