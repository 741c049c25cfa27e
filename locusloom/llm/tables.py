"""Intermediate tables in the shared folder, and columns of documents without surprises."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.session import shared_folder


class Scratch:
    """Tables written to the shared folder for one call, removed as soon as they are done with.

    A written table survives lost executors and is not computed twice; dropping it and the
    shuffles behind it keeps the disk needed at any moment to a few stages. Tables that a result
    still reads stay until :func:`release` or the end of the application, whichever is first.
    """

    def __init__(self, spark: SparkSession):
        bound_batches(spark)
        self.spark = spark
        self._places: dict[int, str] = {}

    def keep(self, df: DataFrame, compression: str = "snappy", by: str | None = None) -> DataFrame:
        place = f"{shared_folder(self.spark)}/llm-{uuid.uuid4().hex}"
        df.write.parquet(place, compression=compression, partitionBy=by)
        path, system = _path(self.spark, place)
        system.deleteOnExit(path)
        _LEFT.setdefault(self.spark.sparkContext.applicationId, set()).add(place)
        out = self.spark.read.schema(df.schema).parquet(place)
        self._places[id(out)] = place
        return out

    def place(self, table: DataFrame) -> str:
        """Folder of a table made by :meth:`keep`."""
        return self._places[id(table)]

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables made by :meth:`keep` and let the driver release finished shuffles."""
        for table in tables:
            if place := self._places.pop(id(table), ""):
                _remove(self.spark, place)
        gc.collect()
        self.spark._jvm.System.gc()


_LEFT: dict[str, set[str]] = {}


def _path(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, place: str) -> None:
    path, system = _path(spark, place)
    system.delete(path, True)
    system.cancelDeleteOnExit(path)
    _LEFT.get(spark.sparkContext.applicationId, set()).discard(place)


def left_tables(spark: SparkSession) -> set[str]:
    """Places of the tables that results of calls so far still read."""
    return set(_LEFT.get(spark.sparkContext.applicationId, ()))


def release(spark: SparkSession, keep: set[str] = frozenset()) -> None:
    """Remove the tables that calls so far have left but those in ``keep``, once the results that read them are written."""
    for place in left_tables(spark) - keep:
        _remove(spark, place)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BITMAP_BITS = 1 << 26
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at ``BATCH_BYTES`` in this session: a batch of 10,000 rows may hold any number of bytes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(key).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(key, BATCH_BYTES)


def marked_rows(rows: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``rows`` with a column ``name``: False where ``doc_id`` is surely not in ``ids (doc_id)``, found without moving rows.

    A bitmap of fixed size (``BITMAP_BITS``, at most 8 MB, whatever the number of ids) is
    broadcast. True for every row whose id is in ``ids``; with very many ids for others too.
    """
    slot = lambda: F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS))
    marks = ids.groupBy(F.bitmap_bucket_number(slot()).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot())).alias("_bits"))
    at = F.bitmap_bit_position(slot())
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    held = rows.withColumn("_bucket", F.bitmap_bucket_number(slot())).join(F.broadcast(marks), "_bucket", "left").withColumn("_at", at)
    bit = byte.bitwiseAND(F.expr("shiftleft(1, cast(_at % 8 as int))")) != 0
    return held.select(*rows.columns, F.coalesce(bit & F.col("doc_id").isNotNull(), F.lit(False)).alias(name))


def likely_rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``doc_id`` is not in ``ids (doc_id)``, so that a join moves few texts in vain."""
    return marked_rows(rows, ids, "_likely").where("_likely").drop("_likely")


def presence_bits(keys: DataFrame, bits: int) -> np.ndarray:
    """``bits`` bits (a power of two), whatever the number of rows: those of ``keys (key)``, for :func:`read_bits`."""
    slot = F.col("key").bitwiseAND(F.lit(bits - 1))
    marks = keys.groupBy(F.shiftright(slot, 15).alias("block")).agg(F.bitmap_construct_agg(slot.bitwiseAND(F.lit(32767))).alias("bits"))
    out = np.zeros((max(1, bits >> 15), 4096), np.uint8)
    for row in marks.toLocalIterator():
        out[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def read_bits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which unsigned keys may be among those of :func:`presence_bits`; those that are always are."""
    slot = (keys & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def text_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` as long, ``text`` with null as empty, and the named columns; others are left behind."""
    bound_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *columns
    )


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 8192) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``keys``: the last group of a table's rows waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, len(batch), rows):
            held.append(batch.slice(at, rows))
            table = pa.Table.from_batches(held)
            columns = [table.column(k).to_numpy() for k in keys]
            other = np.flatnonzero(np.logical_or.reduce([c != c[-1] for c in columns]))
            full = int(other[-1]) + 1 if len(other) else 0
            if full:
                yield table.slice(0, full)
            held = table.slice(full).to_batches()
    if held:
        yield pa.Table.from_batches(held)
