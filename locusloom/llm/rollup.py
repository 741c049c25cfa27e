"""Token-count totals kept up to date by batches of signed changes.

A change is a row ``(source, lang, tokenizer, n_docs, n_tokens)`` with signs: an insert adds a
document and its tokens, a delete takes them away, a revised count adds only the difference, and
moves what it counted if source, language or tokenizer version changed. A batch is summed to its
totals first, so that a source with a third of all rows costs each task one row, and these
totals are written next to those of earlier batches. Totals are additive: the rollup is the
sum over the committed batches.

A batch commits by one rename of its folder to its name, which fails if the name is there. So a
batch counts wholly or not at all, and committing it again, after a lost driver or by a second
writer, changes nothing.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
MEASURES = ("n_docs", "n_tokens")
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def inserts(counts: DataFrame) -> DataFrame:
    """Changes that add documents: ``counts`` has ``source, lang, tokenizer, n_tokens``, one row per document and version."""
    return _changes(counts, 1)


def deletes(counts: DataFrame) -> DataFrame:
    """Changes that take documents away again, given the counts they were added with."""
    return _changes(counts, -1)


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Changes from the old counts of some documents to the new ones, of either version."""
    return deletes(before).unionByName(inserts(after))


def _changes(counts: DataFrame, sign: int) -> DataFrame:
    return counts.select(
        *(F.col(k).cast("string").alias(k) for k in KEYS),
        F.lit(sign).cast("long").alias("n_docs"),
        (sign * F.coalesce(F.col("n_tokens").cast("long"), F.lit(0))).alias("n_tokens"),
    )


def count_tokens(docs: DataFrame, pattern: str, version: str) -> DataFrame:
    """``docs`` with ``n_tokens``, the matches of a pattern in the whole text (null: none), and ``tokenizer``."""
    found = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(pattern)).cast("long"), F.lit(0).cast("long"))
    return docs.withColumn("n_tokens", found).withColumn("tokenizer", F.lit(version))


class Rollup:
    """Totals by source, language and tokenizer version in a folder that all executors share.

    Nulls in source, language or version are a group of their own; a null count adds no
    tokens; columns beyond those named are ignored. An empty batch commits as such, and a
    rollup without batches has no totals. Groups whose documents and tokens have all been
    taken away again leave the totals.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def committed(self, batch: str) -> bool:
        return self._files().exists(self._path(f"batch={batch}"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch once; False if it was there, whoever committed it."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"batch name {batch!r}")
        if self.committed(batch):
            return False
        attempt = f"_attempt-{uuid.uuid4().hex}"
        sums = changes.groupBy(*KEYS).agg(*(F.sum(m).alias(m) for m in MEASURES))
        sums.write.parquet(f"{self.folder}/{attempt}")
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._path(attempt), self._path(f"batch={batch}"), options)
        except Exception:
            if not self.committed(batch):
                raise
            self._files().delete(self._path(attempt), True)  # another writer was first
            return False
        return True

    def totals(self) -> DataFrame:
        """``(source, lang, tokenizer, n_docs, n_tokens)`` over all committed batches."""
        names = [s.getPath().getName() for s in self._files().listStatus(self._path(""))] if self._files().exists(self._path("")) else []
        paths = [f"{self.folder}/{n}" for n in names if n.startswith("batch=")]
        rows = self.spark.read.schema(TOTALS).parquet(*paths) if paths else self.spark.createDataFrame([], TOTALS)
        sums = rows.groupBy(*KEYS).agg(*(F.sum(m).alias(m) for m in MEASURES))
        return sums.where("n_docs <> 0 or n_tokens <> 0")
