"""Toxicity by two Kneser-Ney language models.

From all labelled documents the distinct word trigrams of each class are taken, and from them
continuation counts: after how many different words the class has a pair, and after how many a
word. Copies of a text, of which there may be thousands, thus count once. A word's probability
after another is the discounted count of the pair beside ``strength`` draws from the discounted
count of the word, to which it is backed off; the strength is the one of ``STRENGTHS`` whose curve
fits best. Each class is divided by its own counts, so that the larger class is not the likelier one.
A document's figure is its mean log-likelihood per word in the toxic model less that in the ordinary
one; the same difference is taken for its most toxic ``WINDOW`` words, so that a passage in a long
text counts. A logistic curve over both turns them into a score. Curve and strength are fitted on
labelled documents that the counts have not seen, weighted to the classes' true sizes.

Every word and pair has its own counts. Those of the ``WHOLE`` most frequent pairs (and words) are
sent to all tasks, with a bitmap that tells most of what was never seen; rarer ones are looked up for
a group of texts at a time (``lookup``). So the model that is sent has a bound (about 60 MB, once in
each executor) and no text of a scored document moves. Only a caller that gives ``whole`` has rarer
ones counted in ``SHARED`` slots by their hash instead, each taken to have the mean of its slot.

Bounds: the counts are Spark aggregates over every labelled document and grow with the corpus. Only
the curve, of three numbers, and the strength are fitted on a sample: at most about ``SAMPLE``
documents per class, drawn evenly by a hash of their id. Every document is scored, as a whole. A
pair of two very common words is spread over tasks by the word before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusloom.llm import bytesops, lookup
from locusloom.llm.tables import Scratch, likely_rows, presence_bits, read_bits, text_rows

SAMPLE = 8000
STRENGTHS = (100, 1_000, 10_000, 100_000)
WHOLE = 500_000
SHARED = 1 << 18
BITS = 1 << 27
HOT = 512
SPREAD = 64
BUCKETS = 4096
PASSES = 1
PIECE = 16 << 20
WINDOW = 16
THRESHOLD = 0.7
PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
WORD_PARTS = np.uint64(0x9FB21C651E98DF25) * np.arange(1, 4, dtype=np.uint64)  # a word's six counts are looked up as three keys of two
WORD_COUNTS = ["kt", "ko", "ct", "co", "ft", "fo"]
EVIDENCE = "doc_id long, toxic int, mean double, peak double"
TRIGRAMS = "bucket int, v array<long>, w array<long>, u array<long>, tag array<short>"


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (letters, digits, beyond ASCII; A-Z as a-z), and each row's first word."""
    data, offsets = bytesops.buffers(column)
    starts, ends, firsts = bytesops.word_spans(data, offsets, bytesops.letter_words())
    return bytesops.span_hashes(data, starts, ends, lower=True), firsts


def _grams(hot: np.ndarray, share: int):
    """``(bucket, v, w, u, tag)``: distinct trigrams u v w of a piece whose pair v w is of this share, those of a bucket in one row; u = 0 at a text's
    start. The tag has the classes that have it (1 toxic, 2 ordinary), and 4 times a part that spreads pairs of two words in ``hot``, 0 for others. A
    bucket has all pairs after a word, which then is hardly repeated where it is shuffled; pairs after a word in ``hot`` go to a bucket each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bytesops.pieces(whole, "text", PIECE):
                words, firsts = word_hashes(batch.column("text"))
                toxic = np.repeat(batch.column("toxic").to_numpy(zero_copy_only=False), np.diff(firsts)) == 1
                place = np.arange(len(words)) - np.repeat(firsts[:-1], np.diff(firsts))
                at = np.flatnonzero(place > 0)
                at = at[bytesops.mix(words[at - 1] * PAIR + words[at]) % np.uint64(PASSES) == share]
                if not len(at):
                    continue
                u = np.where(place[at] > 1, words[np.maximum(at - 2, 0)], np.uint64(0))
                v, w, kind = words[at - 1], words[at], np.where(toxic[at], 1, 2).astype(np.int8)
                order = np.lexsort((w, v, u))
                u, v, w, kind = u[order], v[order], w[order], kind[order]
                head = np.flatnonzero(np.concatenate(([True], (u[1:] != u[:-1]) | (v[1:] != v[:-1]) | (w[1:] != w[:-1]))))
                classes = np.bitwise_or.reduceat(kind, head)
                u, v, w = u[head], v[head], w[head]
                part = np.where(np.isin(v, hot) & np.isin(w, hot), 1 + (bytesops.mix(u) % np.uint64(SPREAD)).astype(np.int8), 0).astype(np.int8)
                dealt = np.where(np.isin(v, hot), bytesops.mix((v * PAIR + w) ^ bytesops.mix(part.astype(np.uint64))), v)
                bucket = (bytesops.mix(dealt) % np.uint64(BUCKETS)).astype(np.int32)
                order = np.lexsort((w, v, bucket))
                bucket, tag = bucket[order], (4 * part.astype(np.int16) + classes)[order]
                cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
                ends = pa.array(np.append(cut, len(bucket)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(c)) for c in (*(x[order].view(np.int64) for x in (v, w, u)), tag)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cut]), *lists], [c.split()[0] for c in TRIGRAMS.split(", ")])

    return run


def _common_words(texts: DataFrame) -> np.ndarray:
    """Words that make up ``1 / HOT`` or more of these texts, at most ``HOT``. They decide what is spread, not what is counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bytesops.pieces(whole, "text"):
                words, n = np.unique(word_hashes(batch.column("text"))[0], return_counts=True)
                some = n * 4 * HOT >= n.sum()
                counts = np.append(n[some], n.sum())
                yield pa.RecordBatch.from_arrays([pa.array(np.append(words[some], np.uint64(0)).view(np.int64)), pa.array(counts)], ["word", "n"])

    found = texts.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    word, n = found.column("word").to_numpy().view(np.uint64), found.column("n").to_numpy()
    return np.sort(word[(word != 0) & (n * HOT >= n[word == 0].sum())]) if len(word) else word


def _places(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of sorted keys among others that are sorted, and whether they are there."""
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The keys sorted, each once."""
    keys = np.sort(keys)
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys


@dataclass
class Counts:
    """Counts by hash: own ones of frequent keys, then those of keys looked up or of shared slots, then none."""

    keys: np.ndarray  # sorted
    columns: np.ndarray  # (columns, keys + keys looked up or slots + 1)
    marks: np.ndarray | None  # bitmap of the keys that are rarer, if any are
    more: np.ndarray | None = None  # sorted keys looked up

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Column index of each key."""
        order = np.argsort(wanted)  # sorted keys are found many times as fast
        asked, none = wanted[order], self.columns.shape[1] - 1
        at, found = _places(self.keys, asked)
        index = np.where(found, at, none)
        if self.more is not None:
            at, there = _places(self.more, asked)
            index = np.where(there & ~found, len(self.keys) + at, index)
        elif none > len(self.keys):
            rare = np.flatnonzero(~found)
            rare = rare[read_bits(self.marks, asked[rare])]
            index[rare] = len(self.keys) + (asked[rare] >> np.uint64(40)).astype(np.int64) % (none - len(self.keys))
        out = np.empty(len(wanted), np.int64)
        out[order] = index
        return out

    def rarer(self, wanted: np.ndarray) -> np.ndarray:
        """Those of the keys, each once and sorted, that may have counts but none here."""
        if self.marks is None:
            return wanted[:0]
        rare = _distinct(wanted[read_bits(self.marks, wanted)])
        return rare[~_places(self.keys, rare)[1]]

    def with_more(self, keys: np.ndarray, columns: np.ndarray) -> Counts:
        return replace(self, columns=np.concatenate([self.columns[:, :-1], columns, self.columns[:, -1:]], axis=1), more=keys)


def counts_of(table: DataFrame, columns: list[str], weight: Column, own: int, shared: bool) -> tuple[Counts, int]:
    """Counts of ``table (key, *columns)``: the ``own`` heaviest keys or somewhat fewer have their own there; the others, of less than the weight
    returned, have marks only, or with ``shared`` share slots."""
    sizes = sorted(((r["weight"], r["count"]) for r in table.groupBy(weight.alias("weight")).count().collect()), reverse=True)
    least, room = 0, own
    for size, count in sizes:
        if count > room:
            least = size + 1
            break
        room -= count
    sent = table.where(weight >= least).select("key", *(F.col(c).cast("float").alias(c) for c in columns)).toArrow()
    keys = sent.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    held = np.stack([sent.column(c).to_numpy()[order] for c in columns])
    none, marks = np.zeros((len(columns), 1), np.float32), None
    if least:
        rare = table.where(weight < least)
        marks = presence_bits(rare.select("key"), BITS)
        if shared:
            slot = F.pmod(F.shiftrightunsigned("key", 40), F.lit(SHARED)).cast("int")
            found = rare.groupBy(slot.alias("slot")).agg(*(F.avg(c).cast("float").alias(c) for c in columns)).toArrow()
            slots = np.zeros((len(columns), SHARED), np.float32)
            for i, c in enumerate(columns):
                slots[i, found.column("slot").to_numpy()] = found.column(c).to_numpy()
            held = np.concatenate([held, slots], axis=1)
    return Counts(keys[order], np.concatenate([held, none], axis=1), marks), least


def _word_keys(words: np.ndarray) -> list[np.ndarray]:
    return [bytesops.mix(words ^ part) for part in WORD_PARTS]


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for key, columns in zip(_word_keys(batch.column("key").to_numpy().view(np.uint64)), (("kt", "ko"), ("ct", "co"), ("ft", "fo"))):
            yield key, *(batch.column(c).to_numpy() for c in columns)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        v, w = (batch.column(c).to_numpy().view(np.uint64) for c in ("v", "w"))
        yield bytesops.mix(v * PAIR + w), batch.column("toxic").to_numpy(), batch.column("ordinary").to_numpy()


@dataclass
class Model:
    """Counts of words and pairs, and their totals; index 0 of the classes is toxic, 1 ordinary."""

    shape: dict[str, float]
    words: Counts
    pairs: Counts

    def _pair_keys(self, hashed: np.ndarray) -> np.ndarray:
        return bytesops.mix(np.concatenate(([np.uint64(0)], hashed[:-1])) * PAIR + hashed)

    def wanted(self, texts: pa.RecordBatch) -> np.ndarray:
        """Sorted keys of the words and pairs of these texts that are to be looked up."""
        parts = [key for words in self._rare_words(texts) for key in _word_keys(words)]
        for batch in bytesops.pieces(texts, "text"):
            hashed, firsts = word_hashes(batch.column("text"))
            inner = np.ones(len(hashed), bool)
            inner[firsts[:-1][np.diff(firsts) > 0]] = False
            parts.append(self.pairs.rarer(self._pair_keys(hashed)[inner]))
        return _distinct(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)

    def _rare_words(self, texts: pa.RecordBatch) -> list[np.ndarray]:
        if self.words.marks is None:
            return []
        return [self.words.rarer(word_hashes(batch.column("text"))[0]) for batch in bytesops.pieces(texts, "text")]

    def answered(self, texts: pa.RecordBatch, keys: np.ndarray, counts: tuple[np.ndarray, np.ndarray]) -> Model:
        """The model with the counts of the keys that these texts want."""
        both, found = np.stack(counts).astype(np.float32), replace(self)
        found.pairs = self.pairs.with_more(keys, both)
        if some := self._rare_words(texts):
            words = _distinct(np.concatenate(some))
            held = np.concatenate([both[:, np.searchsorted(keys, k)] for k in _word_keys(words)])
            seen = held.any(axis=0)
            found.words = self.words.with_more(words[seen], held[:, seen])
        return found

    def log_ratios(self, hashed: np.ndarray, firsts: np.ndarray, strengths: tuple[float, ...]) -> list[np.ndarray]:
        """Log-likelihood of each word in the toxic model less that in the ordinary one, for each strength."""
        at, n = self.words.find(hashed), np.diff(firsts)
        none = self.words.columns.shape[1] - 1
        before = np.concatenate(([none], at[:-1]))
        pair = self.pairs.find(self._pair_keys(hashed))
        begin = firsts[:-1][n > 0]
        before[begin], pair[begin] = none, self.pairs.columns.shape[1] - 1
        parts, shape = [], self.shape
        for c, (letter, name) in enumerate((("t", "toxic"), ("o", "ordinary"))):
            own, context, kinds = (self.words.columns[WORD_COUNTS.index(k + letter)] for k in "kcf")
            less, total = discount(shape[f"k{letter}1"], shape[f"k{letter}2"]), shape[f"k{letter}"]
            freed = less * shape[f"k{letter}s"] / total if total else 1.0  # what discounts free, evenly over all words
            unigram = np.maximum(own[at].astype(float) - less, 0) / max(1, total) + freed / shape["words"]
            unigram[at == none] = 1 / shape["words"]
            less = discount(shape[f"{name}1"], shape[f"{name}2"])
            discounted = np.maximum(self.pairs.columns[c][pair].astype(float) - less, 0)
            parts.append((discounted, less * kinds[before], unigram, context[before].astype(float)))
        p = [[(d + (k + s) * u) / (n + s) for d, k, u, n in parts] for s in strengths]
        return [np.log(t) - np.log(o) for t, o in p]

    def evidence(self, column: pa.Array, strengths: tuple[float, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each strength the mean difference per word of each row, and that of its most toxic ``WINDOW`` words."""
        hashed, firsts = word_hashes(column)
        n = np.diff(firsts)
        if not len(hashed):
            return [(np.zeros(len(n)), np.zeros(len(n)))] * len(strengths)
        begin, out = firsts[:-1][n > 0], []
        upto = np.minimum(np.arange(len(hashed)) + WINDOW, np.repeat(firsts[1:], n))
        for each in self.log_ratios(hashed, firsts, strengths):
            total, peak = np.concatenate(([0.0], np.cumsum(each))), np.zeros(len(n))
            peak[n > 0] = np.maximum.reduceat(total[upto] - total[:-1], begin) / WINDOW
            out.append(((total[firsts[1:]] - total[firsts[:-1]]) / np.maximum(n, 1), peak))
        return out


def features(mean: np.ndarray, peak: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(mean)), mean, peak], axis=1)


def discount(ones: int, twos: int) -> float:
    return ones / (ones + 2 * twos) if ones else 0.5


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic fit with a light ridge, by Newton steps."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-12)
    x, b = x / scale, np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - 1e-3 * b
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(b)), gradient)
        b += np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-9:
            break
    return b / scale


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        v, w = (batch.column(c).to_numpy().view(np.uint64) for c in ("v", "w"))
        columns = [pa.array(bytesops.mix(v * PAIR + w).view(np.int64)), batch.column("toxic"), batch.column("ordinary")]
        yield pa.RecordBatch.from_arrays(columns, ["key", "toxic", "ordinary"])


def _loss(x: np.ndarray, y: np.ndarray, weight: np.ndarray, curve: np.ndarray) -> float:
    z = np.clip(x @ curve, -30, 30)
    return float((weight * (np.logaddexp(0, z) - y * z)).sum())


@dataclass
class Learned:
    """The model, broadcast, the folder of the counts to look up if there are any, its strength, and the curve."""

    held: Broadcast
    rare: str | None
    strength: float
    curve: np.ndarray

    def evidence(self, rows: DataFrame) -> DataFrame:
        """``(doc_id, toxic, mean, peak)`` of every row of ``rows (doc_id, text, toxic)``."""
        return _evidence(rows, self.held, self.rare, (self.strength,)).drop("strength")


def learn(docs: DataFrame, labels: DataFrame, part: Column, sample: int = SAMPLE, own: int = WHOLE, whole: int | None = None) -> Learned | None:
    """Models of ``labels (doc_id, toxic)`` rows; ``part`` over ``doc_id`` is 0 for rows that are
    counted, 1 for those that curve and strength are fitted on, null for others. None unless both parts have
    texts of both classes. Labels other than 0 and 1 are no labels; a ``doc_id`` that has both is toxic. The counts of ``own`` words
    and pairs are sent to all tasks and the others looked up; if ``whole`` is given, that many are sent and the others share counts."""
    scratch, context = Scratch(docs.sparkSession), docs.sparkSession.sparkContext
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .withColumn("part", part).where("part is not null")
    )
    counts = {(r["part"], r["toxic"]): r["count"] for r in known.groupBy("part", "toxic").count().collect()}
    if any((p, c) not in counts for p in (0, 1) for c in (0, 1)):
        return None

    def drawn(which: int) -> DataFrame:
        """At most about ``sample`` rows per class of a part."""
        rate = F.lit(0.0)
        for c in (0, 1):
            share = min(1.0, min(sample, 2 * counts[which, 1 - c]) / counts[which, c])
            rate = F.when(F.col("toxic") == c, F.lit(share)).otherwise(rate)
        some = known.where(F.col("part") == which).where(F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53) < rate)
        return text_rows(docs).join(F.broadcast(some.select("doc_id", "toxic")), "doc_id")

    hot = _common_words(drawn(0).select("text"))
    counted = known.where("part = 0").select("doc_id", "toxic")
    labelled = likely_rows(text_rows(docs), counted).join(counted, "doc_id").select("text", "toxic")
    halves = []
    for half in range(PASSES):  # a share of the pairs at a time, where their shuffle is more than the disks hold
        grams = labelled.mapInArrow(_grams(hot, half), TRIGRAMS).repartition("bucket").select("bucket", F.inline(F.arrays_zip("v", "w", "u", "tag")))
        pair = ["bucket", "v", "w", F.shiftright("tag", 2).alias("part")]
        distinct = grams.groupBy(*pair, "u").agg(F.bit_or(F.col("tag").bitwiseAND(3)).alias("classes"))
        found = distinct.groupBy("bucket", "v", "w", "part").agg(
            F.count_if(F.col("classes") != 2).alias("toxic"), F.count_if(F.col("classes") != 1).alias("ordinary")
        ).drop("bucket")
        halves.append(scratch.keep(found, compression="zstd"))
        scratch.drop()
    parts = reduce(DataFrame.unionByName, halves)
    pair_counts = [F.sum(c).alias(c) for c in ("toxic", "ordinary")]
    pairs = parts.where("part = 0").drop("part").unionByName(parts.where("part > 0").groupBy("v", "w").agg(*pair_counts))
    per_word = pairs.selectExpr(
        "stack(2, w, int(toxic > 0), int(ordinary > 0), 0L, 0L, 0, 0,"
        " v, 0, 0, toxic, ordinary, int(toxic > 0), int(ordinary > 0)) as (key, kt, ko, ct, co, ft, fo)"
    )
    words = scratch.keep(per_word.groupBy("key").agg(*(F.sum(c).alias(c) for c in WORD_COUNTS)))

    def totals(table, columns):
        ones = [F.count_if(F.col(c) == n).alias(f"{c}{n}") for c in columns for n in (1, 2)]
        kinds = [F.count_if(F.col(c) > 0).alias(f"{c}s") for c in columns]
        return table.agg(F.count(F.lit(1)).alias("rows"), *(F.sum(c).alias(c) for c in columns), *ones, *kinds).first().asDict()

    both, single = totals(pairs, ["toxic", "ordinary"]), totals(words, ["kt", "ko"])
    shape = both | single | {"pairs": both["rows"], "words": single["rows"]}
    if not shape["words"]:
        scratch.drop(*halves, words)
        return None
    keyed = pairs.mapInArrow(_keyed, "key long, toxic long, ordinary long")
    sent, shared = (own, False) if whole is None else (whole, True)
    word_weight, pair_weight = F.expr("kt + ko + ct + co"), F.expr("toxic + ordinary")
    of_words, least_word = counts_of(words, WORD_COUNTS, word_weight, sent, shared)
    of_pairs, least_pair = counts_of(keyed, ["toxic", "ordinary"], pair_weight, sent, shared)
    rare = None
    if not shared and (least_word or least_pair):
        scratch.drop()
        parts = [(words.where(word_weight < least_word), _word_rows), (pairs.where(pair_weight < least_pair), _pair_rows)]
        rare = lookup.keep_counts(parts, scratch)
    scratch.drop(*halves, words)
    held = context.broadcast(Model(shape, of_words, of_pairs))
    found = _evidence(drawn(1), held, rare, STRENGTHS).select("strength", "mean", "peak", "toxic").toArrow()
    best = None
    for strength in STRENGTHS:
        some = found.filter(pa.array(found.column("strength").to_numpy() == strength))
        mean, peak, y = (some.column(c).to_numpy() for c in ("mean", "peak", "toxic"))
        if not 0 < y.sum() < len(y):
            return None
        prior = np.array([counts[1, 0] / max(1, int((y == 0).sum())), counts[1, 1] / max(1, int((y == 1).sum()))])
        x, y, weight = features(mean, peak), y.astype(float), prior[y]
        curve = _logistic(x, y, weight)
        loss = _loss(x, y, weight, curve)
        if best is None or loss < best[0]:
            best = (loss, Learned(held, rare, strength, curve))
    return best[1]


def _evidence(rows: DataFrame, held: Broadcast, rare: str | None, strengths: tuple[float, ...]) -> DataFrame:
    """``(doc_id, toxic, mean, peak, strength)`` of every row of ``rows (doc_id, text, toxic)`` and strength."""

    def found(model: Model, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for strength, (mean, peak) in zip(strengths, model.evidence(batch.column("text"), strengths)):
            columns = [batch.column("doc_id"), batch.column("toxic"), pa.array(mean), pa.array(peak), pa.array(np.full(len(mean), float(strength)))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "mean", "peak", "strength"])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for whole in batches:
            for batch in bytesops.pieces(whole, "text"):
                yield from found(model, batch)

    schema = EVIDENCE + ", strength double"
    if rare is None:
        return rows.mapInArrow(sent, schema)
    scratch = Scratch(rows.sparkSession)
    place = lookup.answers(rows, lambda batch: held.value.wanted(batch), rare, scratch)
    scratch.drop()

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in lookup.groups_of(whole):
                keys = held.value.wanted(batch)
                model = held.value.answered(batch, keys, lookup.read_answers(place, rare, keys))
                for piece in bytesops.pieces(batch, "text"):
                    yield from found(model, piece)

    return rows.mapInArrow(looked_up, schema)


def score(docs: DataFrame, learned: Learned | None) -> DataFrame:
    """``(doc_id, score)`` of every row; the score is the chance of a toxic label, from the whole text alone.

    A null or empty text, or one without words, scores as evidence of nothing; without a model
    every score is 0. Null ids are kept, repeated rows score alike, other columns are ignored.
    """
    rows = text_rows(docs, F.lit(None).cast("int").alias("toxic"))
    if learned is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    base, mean, peak = map(float, learned.curve)
    z = F.lit(base) + F.lit(mean) * F.col("mean") + F.lit(peak) * F.col("peak")
    return learned.evidence(rows).select("doc_id", (1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))).alias("score"))


def held_out_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``: learned from labels whose id's crc32 is not 1 modulo 3, applied to all.

    Three quarters of these labels are for the counts, the rest for the curve.
    """
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    part = F.when(rest != 1, (F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)) == 0).cast("int"))
    return score(docs, learn(docs, labels, part, sample)).select(
        "doc_id",
        F.coalesce(rest == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
