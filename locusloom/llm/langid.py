"""Language identification by compression with one zstandard dictionary per language.

Each language is a raw-content dictionary: snippets of sampled documents, reduced to their
distinct lower-case words. A text, reduced the same way as a whole, is compressed in blocks
with every dictionary; the language that needs the fewest bytes is chosen, and the choice is
rejected where the runner-up needs hardly more.

The model is a bounded sample by design: ``SNIPPETS`` snippets of ``SNIPPET`` characters and
``DICTIONARY`` bytes for each language, drawn evenly by a hash of the document's id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusloom.llm import bytesops
from locusloom.llm.tables import bound_batches, text_rows

SNIPPETS = 160
SNIPPET = 512
DICTIONARY = 64 << 10
BLOCK = 1024
LEVEL = 5
SHORT = 256
#: Bytes that end every dictionary and precede a short block: zstandard stores a block that gains nothing, which would hide
#: what the language saves.
CARRIER = bytes(range(1, 32)) * 4
MARGIN = 0.001
TEMPERATURE = 0.1
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


def distinct_words(text: str) -> bytes:
    """Lower-case words of letters, each once, in the order of their first place; empty without letters."""
    words = dict.fromkeys(_WORD.findall(text.lower()))
    if not any(c.isalpha() for w in words for c in w):
        return b""
    return " ".join(words).encode("utf-8", "surrogatepass")


def in_fold(doc_id: Column, folds: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; null ids are in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == remainder, F.lit(False))


def learn(labelled: DataFrame) -> dict[str, bytes]:
    """Dictionary of each language from ``(doc_id, text, lang)``.

    Reads all rows for the counts; brings at most ``SNIPPETS`` snippets of each language to
    the driver. Rows without text or language are left out.
    """
    rows = labelled.where("lang is not null and text is not null and doc_id is not null").withColumn(
        "draw", F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    )
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("all"))
    drawn = rows.join(F.broadcast(counts), "lang").where(F.col("draw") * F.col("all") < 4 * SNIPPETS)
    first = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
    begin = (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text") - SNIPPET, F.lit(1))) + 1).cast("int")
    snippets = (
        drawn.select("lang", "draw", "doc_id", F.expr("text").substr(begin, F.lit(SNIPPET)).alias("text"))
        .withColumn("k", F.row_number().over(first)).where(F.col("k") <= SNIPPETS).orderBy("lang", "k").select("lang", "text")
    )
    found: dict[str, list[bytes]] = {}
    for row in snippets.collect():
        found.setdefault(row["lang"], []).append(distinct_words(row["text"]))
    return {lang: b" ".join(parts)[-DICTIONARY:] + CARRIER for lang, parts in found.items() if any(parts)}


def _judge(model: dict[str, bytes], margin: float):
    """Function from a text to its language, score and rejection."""
    langs, machines = sorted(model), []
    for lang in langs:
        known = zstandard.ZstdCompressionDict(model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        machine = zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_dict_id=False, write_checksum=False)
        machines.append(machine.compress)

    def judge(text: str | None) -> tuple[str, float, bool]:
        words = distinct_words(text) if text else b""
        if not words or not langs:
            return UNKNOWN, 0.0, True
        blocks = [words[i : i + BLOCK] for i in range(0, len(words), BLOCK)]
        if len(blocks[-1]) < SHORT:
            blocks[-1] = CARRIER + blocks[-1]
        sizes = [sum(len(compress(b)) for b in blocks) for compress in machines]
        least = min(sizes)
        best = sizes.index(least)
        second = min((s for i, s in enumerate(sizes) if i != best), default=2 * least)
        score = 1 / sum(2.0 ** (-8 * TEMPERATURE * (s - least)) for s in sizes)
        return langs[best], score, second - least <= margin * second

    return judge


def _classify(model: dict[str, bytes], margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(model, margin)
        for whole in batches:
            for batch in bytesops.pieces(whole, "text"):
                names, scores, rejected = zip(*map(judge, batch.column("text").to_pylist()))
                found = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found], ["doc_id", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, model: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` for every row; the whole text counts.

    ``score`` is the weight of the best language among all after sizes in bits are scaled down;
    ``rejected`` marks a lead of at most ``margin`` of the runner-up's bytes. Null texts and
    texts without a letter are ``und`` with score 0 and rejected, and so is every text if no
    language was learned. Equal sizes go to the language first in the alphabet and are
    rejected. Null ids are kept, repeated rows judged alike, other columns ignored.
    """
    return text_rows(docs).mapInArrow(_classify(model, margin), "doc_id long, lang_pred string, score double, rejected boolean")


def _accepted(model: dict[str, bytes], margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(model, margin)
        for whole in batches:
            for batch in bytesops.pieces(whole, "text"):
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                yield batch.filter(pa.array([not judge(t)[2] for t in texts], pa.bool_()))

    return run


def accepted(docs: DataFrame, model: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs`` with all their columns whose language :func:`identify` does not reject, without moving any."""
    bound_batches(docs.sparkSession)
    return docs.mapInArrow(_accepted(model, margin), docs.schema)


def held_out_identification(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Learn from the documents outside fold 0, predict all: adds ``held_out`` to :func:`identify`."""
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    training = labelled.where(F.col("doc_id").isNotNull() & ~in_fold(F.col("doc_id"), folds, 0))
    found = identify(docs, learn(training))
    return found.select("doc_id", in_fold(F.col("doc_id"), folds, 0).alias("held_out"), "lang_pred", "score", "rejected")
