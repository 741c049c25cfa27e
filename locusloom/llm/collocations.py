"""Phrase collocations by the stripes pattern.

A *stripe* is a prefix of words with an associative counter of the words that follow it. Tasks
count the stripes of a piece of text and emit a row per segment, prefixes, words and counts side by
side, where a segment is one of ``STRIPES`` by the prefix's hash: a piece has that many rows a
language at most, however many of its prefixes the corpus makes frequent. Spark brings the rows of a segment
together, and tasks merge the stripes in them elementwise without making a row of each entry: what leaves the merge are
frequent extensions and a total per prefix. The counter has an end entry for occurrences of
the prefix that nothing countable follows, so one merged stripe gives the extensions of a prefix,
in its sum the prefix's own frequency, and in its largest entry what subsumes the prefix.

Prefixes grow by a word per pass: the empty prefix (whose stripe is the vocabulary), one word, two,
three. A phrase is at most as frequent as its parts, so a pass counts an extension only if its
first and its last words but one are frequent. That is asked of a bitmap of fixed size, which
has all frequent phrases: what it lets pass in vain is dropped by its count, so no phrase is lost
and the broadcast doesn't grow; only the share that passes in vain does.

Hot prefixes: the vocabulary's stripe is cut into ``PARTS`` by the word's hash. A prefix of words
that each make up ``1 / HOT`` of all words or more (there are at most ``HOT`` such words, which
are broadcast) is dealt to ``SEGMENTS`` segments by the next word's hash. Others are rarer than that.

Words are 64-bit hashes while they are counted. Two words of one language with one hash would
share a vocabulary entry, which is noticed there, and all is counted anew under another seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusloom.llm import bytesops
from locusloom.llm.tables import Scratch, presence_bits, read_bits, whole_groups

LONGEST = 4
PARTS = 1024
HOT = 4096
SEGMENTS = 64
STRIPES = 4096
BITS = 1 << 28
PIECE = 8 << 20
ROWS = 512
END = np.uint64(0)
STEP = np.uint64(0xC2B2AE3D27D4EB4F)
SEPARATORS = [*b".,;:!?", *range(0x0A, 0x0E)]  # fixed values of the contract
BLANKS = [0x20, 0x09]


class Text:
    """Words of a piece: their hashes, spans, the language of each, and the run (stretch without separator) it is in."""

    def __init__(self, batch: pa.RecordBatch, seed: int):
        data, offsets = bytesops.buffers(batch.column("text"))
        inside, separator = np.ones(256, bool), np.zeros(256, bool)
        inside[SEPARATORS + BLANKS] = False
        separator[SEPARATORS] = True
        self.data = data
        self.starts, self.ends, firsts = bytesops.word_spans(data, offsets, inside)
        hashed = bytesops.span_hashes(data, self.starts, self.ends, lower=True)
        if seed:
            hashed = bytesops.mix(hashed + np.uint64(seed) * STEP)
        self.words = np.where(hashed == END, np.uint64(1), hashed)
        row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(firsts))
        passed = np.searchsorted(np.flatnonzero(separator[data]), self.starts)
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (passed[1:] != passed[:-1])
        self.run = np.cumsum(new, dtype=np.int32)
        langs = batch.column("lang").dictionary_encode()
        self.names = langs.dictionary
        self.lang = langs.indices.to_numpy(zero_copy_only=False)[row] if len(row) else row
        self.seeds = language_seeds(self.names)

    def spelled(self, at: np.ndarray) -> pa.Array:
        """The words at ``at``, lower-cased; they end at ASCII bytes, so each is whole UTF-8."""
        starts, sizes = self.starts[at], self.ends[at] - self.starts[at]
        offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
        found = self.data[np.arange(offsets[-1], dtype=np.int32) + np.repeat((starts - offsets[:-1]).astype(np.int32), sizes)]
        found[(found >= 0x41) & (found <= 0x5A)] += 0x20
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(found))


def language_seeds(names: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(str(n).encode("utf-8")) for n in names.to_pylist()], np.uint64)


def phrase_hashes(seeds: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    out = seeds
    for w in words:
        out = bytesops.mix(out * STEP + w)
    return out


def _stripes_of(batches: Iterator[pa.RecordBatch], seed: int, count) -> Iterator[pa.RecordBatch]:
    """``count`` of every piece's text, ``ROWS`` at a time. Nothing here keeps a piece, so that a worker holds one of them at a time."""
    for whole in batches:
        for batch in bytesops.pieces(whole, "text", PIECE):
            for out in count(Text(batch, seed)):
                yield from (out.slice(at, ROWS) for at in range(0, len(out), ROWS))


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted table's rows differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _lists(values: pa.Array, heads: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(heads, len(values)).astype(np.int32)), values)


def _vocabulary(seed: int):
    """Stripes of the empty prefix: ``(lang, segment, nexts, counts, words)``."""

    def count(text: Text) -> Iterator[pa.RecordBatch]:
        if len(text.words):
            order = np.argsort(text.words, kind="stable")
            order = order[np.argsort(text.lang[order], kind="stable")] if len(text.names) > 1 else order
            heads = _heads(text.words[order], text.lang[order])
            counts, first = np.diff(np.append(heads, len(order))), order[heads]
            segment = (text.words[first] % np.uint64(PARTS)).astype(np.int32)
            stripes = np.lexsort((segment, text.lang[first]))
            first, counts, segment = first[stripes], counts[stripes], segment[stripes]
            cut = _heads(segment, text.lang[first])
            columns = [
                text.names.take(pa.array(text.lang[first[cut]])), pa.array(segment[cut]),
                _lists(pa.array(text.words[first].view(np.int64)), cut), _lists(pa.array(counts), cut),
                _lists(text.spelled(first), cut),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "segment", "nexts", "counts", "words"])

    return lambda batches: _stripes_of(batches, seed, count)


def _stripes(seed: int, size: int, marks: Broadcast, hot: np.ndarray):
    """Stripes of prefixes of ``size`` words, those of a segment in one row: ``(lang, segment, w1..., nexts, counts)``; ``hot`` are sorted phrase
    hashes of words."""

    def count(text: Text) -> Iterator[pa.RecordBatch]:
        bits, n = marks.value, len(text.words) - size + 1
        if n > 0:
            seeds = text.seeds[text.lang]
            prefix = [text.words[j : n + j] for j in range(size)]
            whole = phrase_hashes(seeds[:n], prefix)
            known = (text.run[:n] == text.run[size - 1 :]) & read_bits(bits, whole)
            at = np.flatnonzero(known)
            more = at + 1 < n
            more[more] = known[at[more] + 1] & (text.run[at[more]] == text.run[at[more] + size])
            after = np.full(len(at), END)
            after[more] = text.words[at[more] + size]
            order = np.argsort(bytesops.mix(whole[at] ^ bytesops.mix(after + STEP)))
            at, after = at[order], after[order]
            heads = _heads(text.lang[at], *(p[at] for p in prefix), after)
            counts, at, after = np.diff(np.append(heads, len(at))), at[heads], after[heads]
            often = np.ones(len(at), bool)
            for p in prefix:
                often &= np.isin(phrase_hashes(seeds[at], [p[at]]), hot)
            part = np.where(often, bytesops.mix(whole[at] ^ (after % np.uint64(SEGMENTS) + STEP)), whole[at])
            segment = (part % np.uint64(STRIPES)).astype(np.int32)
            order = np.lexsort((whole[at], segment, text.lang[at]))
            counts, at, after, segment = counts[order], at[order], after[order], segment[order]
            cut = _heads(segment, text.lang[at])
            columns = [
                text.names.take(pa.array(text.lang[at[cut]])), pa.array(segment[cut]), *(_lists(pa.array(p[at].view(np.int64)), cut) for p in prefix),
                _lists(pa.array(after.view(np.int64)), cut), _lists(pa.array(counts), cut),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "segment", *(f"w{j + 1}" for j in range(size)), "nexts", "counts"])

    return lambda batches: _stripes_of(batches, seed, count)


def _sums(size: int, least: int):
    """Stripes of ``size`` words merged, from rows sorted by language and segment: ``(lang, w1..., next, a)``, extensions
    of at least ``least`` and, as the end entry, the total of every prefix in a segment."""
    prefix = [f"w{j + 1}" for j in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["lang", "segment"]):
            table = table.combine_chunks()
            langs, segments = table.column("lang"), table.column("segment").to_numpy()
            group = np.zeros(len(table), np.int64)
            group[_heads(langs.to_numpy(), segments)[1:]] = 1
            rows = np.repeat(np.arange(len(table)), table.column("nexts").combine_chunks().value_lengths().to_numpy())
            group = np.cumsum(group)[rows]
            flat = lambda c: table.column(c).combine_chunks().flatten().to_numpy()
            words, nexts, counts = [flat(p).view(np.uint64) for p in prefix], flat("nexts").view(np.uint64), flat("counts")
            whole = phrase_hashes(bytesops.mix(group.view(np.uint64) + STEP), words)
            order = np.lexsort((nexts, whole))
            if len(_heads(whole[order])) != len(_heads(group[order], *(w[order] for w in words))):  # one hash, two prefixes
                order = np.lexsort((nexts, *words, group))
            words, nexts, counts, group, rows = [w[order] for w in words], nexts[order], counts[order], group[order], rows[order]
            stripes, entries = _heads(group, *words), _heads(group, *words, nexts)
            a = np.add.reduceat(counts, entries)
            often = (a >= least) & (nexts[entries] != END)
            at = np.append(entries[often], stripes)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(pa.array(rows[at])).combine_chunks(), *(pa.array(w[at].view(np.int64)) for w in words),
                    pa.array(np.append(nexts[entries[often]], np.full(len(stripes), END)).view(np.int64)),
                    pa.array(np.append(a[often], np.add.reduceat(counts, stripes))),
                ],
                ["lang", *prefix, "next", "a"],
            )

    return run


def _keys(width: int):
    """Phrase hashes of frequent phrases ``(lang, w1...)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            seeds = language_seeds(langs.dictionary)[langs.indices.to_numpy(zero_copy_only=False)] if len(batch) else np.zeros(0, np.uint64)
            words = [batch.column(f"w{j + 1}").to_numpy().view(np.uint64) for j in range(width)]
            yield pa.RecordBatch.from_arrays([pa.array(phrase_hashes(seeds, words).view(np.int64))], ["key"])

    return run


def _merged(stripes: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Stripes of the empty prefix by segment as one: ``total`` and, as ``entries``, the words of at least ``least``."""
    dealt, keys, end = ["lang", "segment"], [*keys, "segment"], F.lit(int(END))
    lists = [c for c in stripes.columns if c not in dealt]
    flat = stripes.repartition(*dealt).select(*dealt, F.inline(F.arrays_zip(*lists)))
    flat = flat.withColumnsRenamed({"nexts": "next", "words": "word", "counts": "a"})
    summed = flat.groupBy(*keys, "next", "word").agg(F.sum("a").alias("a"))
    kept = F.when((F.col("next") != end) & (F.col("a") >= least), F.struct("next", "word", "a"))
    per_hash = summed.groupBy(*keys, "next").agg(  # one hash, two words
        F.count(F.lit(1)).alias("spellings"), F.max("word").alias("word"), F.sum("a").alias("a")
    )
    return per_hash.groupBy(*keys).agg(F.sum("a").alias("total"), F.max("spellings").alias("spellings"), F.collect_list(kept).alias("entries"))


def _extensions(stripes: DataFrame, size: int, least: int) -> DataFrame:
    """``(lang, w1..., next, a)`` of :func:`_sums` from stripes of ``size`` words."""
    schema = f"lang string, {', '.join(f'w{j + 1} long' for j in range(size))}, next long, a long"
    return stripes.repartition("lang", "segment").sortWithinPartitions("lang", "segment").mapInArrow(_sums(size, least), schema)


class _Counter:
    def __init__(self, docs: DataFrame, least: int):
        self.spark, self.scratch, self.least = docs.sparkSession, Scratch(docs.sparkSession), least
        self.rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        self.seed = 0

    def vocabulary(self) -> tuple[DataFrame, DataFrame]:
        """Words ``(lang, w1, phrase, last, a, ls, rs)`` and ``(lang, n)``."""
        while True:
            schema = "lang string, segment int, nexts array<long>, counts array<long>, words array<string>"
            merged = self.scratch.keep(_merged(self.rows.mapInArrow(_vocabulary(self.seed), schema), ["lang"], self.least))
            if (merged.agg(F.max("spellings")).first()[0] or 1) == 1:
                break
            self.scratch.drop(merged)
            self.seed += 1
        none = F.array().cast("array<long>")
        words = merged.select("lang", F.inline("entries")).select(
            "lang", F.col("next").alias("w1"), F.col("word").alias("phrase"), F.col("word").alias("last"), "a", none.alias("ls"), none.alias("rs")
        )
        totals = self.scratch.keep(merged.groupBy("lang").agg(F.sum("total").alias("n")))
        words = self.scratch.keep(words)
        self.scratch.drop(merged)
        return words, totals

    def hot(self, words: DataFrame, totals: DataFrame) -> np.ndarray:
        """Phrase hashes of the words that are ``1 / HOT`` of all or more: at most ``HOT``."""
        n = totals.agg(F.sum(F.col("n").cast("decimal(38,0)"))).first()[0] or 0
        often = words.where(F.col("a").cast("decimal(38,0)") * HOT >= F.lit(n).cast("decimal(38,0)"))
        return np.sort(often.mapInArrow(_keys(1), "key long").toArrow().column("key").to_numpy().view(np.uint64))

    def extended(self, phrases: DataFrame, size: int, hot: np.ndarray) -> DataFrame:
        """Frequent phrases of ``size + 1`` words from those of ``size``, of the same columns and one word more."""
        prefix = [f"w{j + 1}" for j in range(size)]
        marks = self.spark.sparkContext.broadcast(presence_bits(phrases.mapInArrow(_keys(size), "key long"), BITS))
        schema = f"lang string, segment int, {', '.join(f'{p} array<long>' for p in prefix)}, nexts array<long>, counts array<long>"
        merged = self.scratch.keep(_extensions(self.rows.mapInArrow(_stripes(self.seed, size, marks, hot), schema), size, self.least))
        entries = merged.where(F.col("next") != int(END)).withColumnRenamed("next", f"w{size + 1}")
        totals = merged.where(F.col("next") == int(END)).groupBy("lang", *prefix).agg(F.sum("a").alias("total"))
        first = phrases.select("lang", *prefix, F.col("phrase").alias("first"), F.col("ls").alias("first_ls"))
        rest = phrases.select(
            "lang", *(F.col(f"w{j + 1}").alias(f"w{j + 2}") for j in range(size)),
            F.col("a").alias("rest_a"), F.col("rs").alias("rest_rs"), F.col("last").alias("rest_last"),
        )
        out = self.scratch.keep(
            entries.join(first.join(totals, ["lang", *prefix]), ["lang", *prefix])
            .join(rest, ["lang", *(f"w{j + 2}" for j in range(size))])
            .select(
                "lang", *prefix, f"w{size + 1}", F.concat_ws(" ", "first", "rest_last").alias("phrase"), F.col("rest_last").alias("last"), "a",
                F.concat("first_ls", F.array("total")).alias("ls"), F.concat(F.array("rest_a"), "rest_rs").alias("rs"),
            )
        )
        self.scratch.drop(merged)
        return out


def _unsubsumed(phrases: DataFrame, longer: DataFrame | None, size: int, percent: int) -> DataFrame:
    """Phrases of ``size`` words in no longer frequent one with ``percent`` of their frequency. One word more is
    enough: what a phrase of two words more has, the one between has at least."""
    if longer is None:
        return phrases
    keys = [f"w{j + 1}" for j in range(size)]
    parts = F.array(*(F.struct(*(F.col(f"w{j + k}").alias(f"w{j}") for j in range(1, size + 1))) for k in (0, 1)))
    most = longer.select("lang", F.col("a").alias("over"), F.inline(parts)).groupBy("lang", *keys).agg(F.max("over").alias("over"))
    wide = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(20,0)")
    return phrases.join(most, ["lang", *keys], "left").where(wide("over") * 100 < wide("a") * percent)


def _scored(phrases: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` of the cut with the lowest score, the first of such."""
    cuts = F.expr(
        "transform(sequence(0, size(ls) - 1), k -> named_struct('score',"
        " (cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div (cast(ls[k] as decimal(19,0)) + cast(rs[k] as decimal(19,0))),"
        " 'k', k, 'l', ls[k], 'r', rs[k]))"
    )
    worst = phrases.withColumn("cut", F.array_min(cuts))
    return worst.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").cast("long").alias("score"))


def collocations(docs: DataFrame, least: int = 30, percent: int = 80, top: int = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases of 2 to 4 words.

    A-Z are lower-cased, texts split at ``. , ; : ! ?`` and line ends (0x0A to 0x0D) into pieces and
    these at blanks and tabs into words. A phrase occurs ``a`` times, overlaps included, inside
    pieces; of the cuts into a first part (``l`` times) and a rest (``r`` times) the one with the
    lowest ``floor(2000000 * a / (l + r))`` counts, the earliest of equal ones. Phrases of fewer
    than ``least`` occurrences, and those inside a longer such phrase with ``percent`` of their
    occurrences, are left out. Ranks go by score, then ``a``, falling, then by the phrase's bytes.

    A null text is empty, a null language ``und``; rows without words count nothing, repeated rows
    count again, ids may be null or repeated, other columns are ignored, an empty table has no
    phrases. Texts of any length are read whole, one at a time where they pass a piece's size.
    """
    counter = _Counter(docs, least)
    words, totals = counter.vocabulary()
    hot, levels = counter.hot(words, totals), [words]
    for size in range(1, LONGEST):
        levels.append(counter.extended(levels[-1], size, hot))
    found = [
        _scored(_unsubsumed(levels[size - 1], levels[size] if size < LONGEST else None, size, percent)) for size in range(2, LONGEST + 1)
    ]
    scored = found[0].unionByName(found[1]).unionByName(found[2])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
