"""Preparation of a text corpus in stages, each written as Parquet and read by the next."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402

from locusloom.llm import bpe, decontaminate, langid, minhash, repeats  # noqa: E402
from locusloom.llm.tables import Scratch, left_tables, marked_rows, read_table, release, shared_folder  # noqa: E402


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells; those without letters or with a tie go.

    Null, empty and letterless texts are rejected, and every text if no row has both text and
    language. Repeated rows are judged alike, rows without id like others; texts of any length are
    read whole; other columns go along; an empty table gives an empty one.
    """
    return langid.accepted(docs, langid.learn(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group linked by five-word shingle similarities of 0.8 or more.

    Rows without id stay, and so do texts without words. Rows that repeat id and text stay once.
    An id that comes with several texts keeps them all, each once: only one of them is compared
    with other documents (see ``near_duplicates``). All columns go along, whatever their names; of
    rows with one id and text those of an arbitrary one. An empty table gives an empty one. Only
    rows of ids that lose a row move; a bitmap finds them where they are.
    """
    scratch = Scratch(spark)
    near = minhash.near_duplicates(docs, width=5, percent=80).where("doc_id is not null")
    ids = scratch.keep(near.groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies"), F.max("kept").alias("kept")))
    told = ids.where("not kept or copies > 1")
    rows = marked_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("*").alias("row")), told, "told")
    asked = rows.where("told").select("doc_id", "row").join(told, "doc_id", "left")
    single = asked.where("copies is null or (copies = 1 and kept)")
    texts = asked.where("copies > 1").groupBy("doc_id", F.sha2(F.col("row.text"), 256).alias("print")).agg(
        F.any_value("row").alias("row"), F.max("kept").alias("kept")
    )
    several = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = texts.join(several, "doc_id").where("kept or n > 1")
    parts = [rows.where("not told"), single, repeated]
    return parts[0].select("row.*").unionByName(parts[1].select("row.*")).unionByName(parts[2].select("row.*"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 100 bytes or more that stand earlier in the corpus; every row stays.

    Null texts become empty and rows without id lose nothing; rows that repeat id and text lose
    the same. ``n_chars``, where there is one, is counted anew; all other columns go along, whatever
    their names. Texts of any length are read whole; an empty table gives an empty one.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    rest = F.struct(F.lit(0).alias("nothing"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)))
    cut = repeats.remove_repeats(docs.select("doc_id", "text", rest.alias("rest")), width=100, with_text=True, carry=["rest"])
    named = {c: F.col(f"rest.c{i}").alias(c) for i, c in enumerate(others)}
    named["n_chars"] = F.length("text").cast("long").alias("n_chars")
    return cut.select(*(named.get(c, F.col(c)) for c in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold 0.8 of the five-word shingles of a benchmark item.

    Null and empty texts hold none and stay, rows without id are judged like others, repeated rows
    alike. Texts of any length are read whole, all columns go along, and with no items or no
    documents the table is returned as it is.
    """
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), width=5, percent=80)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text (little-endian unsigned 32 bits) and digests of them and of the text they decode to.

    A null or empty text has no ids; rows without id and repeated rows are encoded like others,
    other columns are ignored; texts of any length are read whole; an empty table gives an empty one.
    """
    return bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", in_known_language),
    ("near_dedup", one_of_each),
    ("suffix_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("bpe", tokens),
]

#: The stages compress, sketch and fingerprint texts, which SQL can't state; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        place, others = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", left_tables(spark)
        stage(spark, docs, sf_dir).write.parquet(place)
        release(spark, keep=others)
        docs = spark.read.parquet(place)
    return STAGES[-1][1](spark, docs, sf_dir)
