"""The stages one after the other, each against what it should leave of its own input."""

import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_corpus import brute_components, brute_repeats
from test_texts import contained, sentences
from tokenizers import Tokenizer

import corpus_pipeline


def corpus(rng):
    words = [f"{a}{b}" for a in ("ba", "de", "ki", "lo", "mu", "ra") for b in ("ta", "ne", "si", "po", "ru", "vel", "zor")]
    passage = sentences(rng, words, 45)
    items = [(i, sentences(rng, words, 25)) for i in range(3)]
    rows = [(d, sentences(rng, words, rng.randint(20, 90))) for d in range(40)]
    rows += [(50 + i, rows[i][1] + (" extra" if i % 2 else "")) for i in range(6)]
    rows += [(60 + i, f"{sentences(rng, words, 20)} {passage} {sentences(rng, words, 9)}") for i in range(4)]
    rows += [(70, sentences(rng, words, 30) + " " + items[1][1] + " " + sentences(rng, words, 5)), (71, "12 34 !!"), (72, None), (73, "")]
    return [(*r, "xx") for r in rows] + [(80 + i, sentences(rng, ["the", "house", "with", "some", "over"], 40), "en") for i in range(5)], items


def test_stages(documents, spark, tmp_path):
    rows, items = corpus(random.Random(8))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    columns = docs.dtypes
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "bpe":
            assert docs.dtypes == columns
            kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    given = {r[0]: r[1] for r in rows}
    gone = set(given) - set(kept["language_id"])
    assert {71, 72, 73} <= gone and len(gone) <= 5
    roots = brute_components(list(kept["language_id"].items()), 80)
    assert set(kept["near_dedup"]) == {d for d, r in roots.items() if r[2]}
    cut = brute_repeats(list(kept["near_dedup"].items()), 100)
    assert {d: len(t.encode()) for d, t in kept["suffix_dedup"].items()} == {d: c[0] - c[1] for d, c in cut.items()}
    held = {f[0] for f in contained(list(kept["suffix_dedup"].items()), items)}
    assert 70 in held and set(kept["decontamination"]) == set(kept["suffix_dedup"]) - held
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    final = docs.collect()
    assert {r["doc_id"] for r in final} == set(kept["decontamination"])
    for r in final:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(kept["decontamination"][r["doc_id"]], add_special_tokens=False).ids


def test_run_on_nothing(documents, spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    documents([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_repeated_and_unnamed_rows_stay_once_or_wholly(documents, spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (None, None)]
    got = corpus_pipeline.one_of_each(spark, documents(rows), "").select("doc_id").collect()
    assert sorted((r[0] for r in got), key=str) == [1, None, None]


def test_all_texts_of_an_id_stay(documents, spark):
    same, other = "a b c d e f g", ["q w e r t y u", "z x c v b n m", "h j k l p o i"]
    rows = [(1, same), (4, same), (4, same)]
    for i, text in enumerate(other):
        rows += [(2 + 10 * i, same), (2 + 10 * i, text), (2 + 10 * i, text)]
    got = corpus_pipeline.one_of_each(spark, documents(rows), "").select("doc_id", "text").collect()
    want = [(1, same), *((2 + 10 * i, t) for i, text in enumerate(other) for t in (same, text))]
    assert sorted(map(tuple, got)) == sorted(want)


def test_columns_of_clashing_names_go_along(documents, spark):
    same = "a b c d e f g"
    names = ["kept", "copies", "own_id", "texts", "told", "row", "n", "rest", "spans", "n_bytes", "part", "_bits", "c0"]
    docs = documents([(1, same), (4, same), (4, same), (5, "q w e r t y"), (6, None), (None, same)], {c: F.lit(i) for i, c in enumerate(names)})
    for stage in (corpus_pipeline.one_of_each, corpus_pipeline.without_repeats):
        got = stage(spark, docs, "")
        assert got.columns == docs.columns
        rows = got.collect()
        assert all([r[c] for c in names] == list(range(len(names))) for r in rows)
        assert sorted(str(r["doc_id"]) for r in rows) == ["1", "5", "6", "None"] if stage is corpus_pipeline.one_of_each else len(rows) == 6
