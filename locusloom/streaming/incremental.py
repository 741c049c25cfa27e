"""Results that streams keep up to date by rewriting only what new rows touch.

A :class:`VersionedTable` holds partial aggregates in hash buckets of their group. Each run reads
the stream's new rows, merges them with the buckets they fall in, writes these under a new
version and then commits a list of which version has each bucket, at most ``buckets`` rows.
Buckets that nothing falls in are neither read nor written. A run that breaks off leaves no
list; the next run of the same number goes on with what its stream had written and replaces
the rest. Merging must not care how often a row comes (minima and maxima), so a file that is
delivered twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

from locusloom.operators.cohort import LOCUS
from locusloom.operators.runlog import resolve_stage_state

BUCKETS = 64
MARKS = ("start", "finish", "error")


def _exists(spark: SparkSession, place: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


class VersionedTable:
    """Partial aggregates per group in ``folder``, in buckets by the hash of ``group``.

    ``merge`` takes rows of ``schema`` (old and new ones) to one row per key, by an aggregation whose
    keys contain the group; ``summary``, if given, takes merged rows to what :meth:`current` reads.
    """

    def __init__(
        self, spark: SparkSession, folder: str, group: Sequence[str], schema: T.StructType,
        merge: Callable[[DataFrame], DataFrame], summary: Callable[[DataFrame], DataFrame] | None = None, buckets: int = BUCKETS,
    ):
        self.spark, self.folder, self.group, self.schema = spark, folder.rstrip("/"), list(group), schema
        self.merge, self.summary, self.buckets = merge, summary, buckets

    def version(self) -> int:
        """Number of the last committed version, -1 before the first."""
        found = -1
        while _exists(self.spark, f"{self.folder}/list-{found + 1}/_SUCCESS"):
            found += 1
        return found

    def places(self, version: int | None = None) -> dict[int, int]:
        """Version that has each bucket, at most ``buckets`` entries."""
        version = self.version() if version is None else version
        if version < 0:
            return {}
        rows = self.spark.read.schema("bucket int, version int").parquet(f"{self.folder}/list-{version}").collect()
        return {r["bucket"]: r["version"] for r in rows}

    def _read(self, kind: str, places: dict[int, int], schema: StructType) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.folder}/{kind}-{v}/bucket={b}" for b, v in sorted(places.items())))

    def advance(self, stream: DataFrame) -> int:
        """Run the stream over what is there now, merge its rows and commit; the number of touched buckets."""
        number = self.version() + 1
        fresh = f"{self.folder}/new/run={number}"
        query = (
            stream.select(*self.schema.fieldNames(), F.lit(number).alias("run")).writeStream.format("parquet").outputMode("append")
            .partitionBy("run").option("checkpointLocation", f"{self.folder}/stream").trigger(availableNow=True).start(f"{self.folder}/new")
        )
        query.awaitTermination()
        if not _exists(self.spark, fresh):
            return 0
        # Spark's own hash, so that each task of the merge holds one bucket.
        rows = self.spark.read.schema(self.schema).parquet(fresh)
        touched = [r["bucket"] for r in rows.select(F.pmod(F.hash(*self.group), F.lit(self.buckets)).alias("bucket")).distinct().collect()]
        if not touched:
            return 0
        places = self.places(number - 1)
        old = self._read("rows", {b: places[b] for b in touched if b in places}, self.schema)
        both = old.unionByName(rows).repartition(self.buckets, *self.group)
        bucket = F.pmod(F.hash(*self.group), F.lit(self.buckets)).alias("bucket")
        merged = self.merge(both).select(*self.schema.fieldNames(), bucket)
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/rows-{number}")
        if self.summary:
            written = self._read("rows", {b: number for b in touched}, self.schema).repartition(self.buckets, *self.group)
            self.summary(written).withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/summary-{number}")
        places |= {b: number for b in touched}
        listed = self.spark.createDataFrame(sorted(places.items()), "bucket int, version int")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/list-{number}")
        return len(touched)

    def current(self, version: int | None = None) -> DataFrame:
        """The summary (or merged rows) of a version, the last one by default."""
        empty = self.spark.createDataFrame([], self.schema)
        if self.summary:
            return self._read("summary", self.places(version), self.summary(empty).schema)
        return self._read("rows", self.places(version), self.schema)

    def vacuum(self) -> None:
        """Remove buckets that the last version has replaced, and new rows that it has merged."""
        last, conf = self.version(), self.spark._jsc.hadoopConfiguration()
        held = self.places(last)
        for v in range(last + 1):
            gone = [f"{self.folder}/new/run={v}"]
            gone += [f"{self.folder}/{k}-{v}/bucket={b}" for k in ("rows", "summary") for b, at in held.items() if at > v]
            for place in gone:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
                path.getFileSystem(conf).delete(path, True)


_TYPES = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType()}


def _schema(**fields: str | T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind] if isinstance(kind, str) else kind) for name, kind in fields.items()])


CARRIERS = _schema(chrom="string", pos="long", ref="string", alt="string", unit="string", first_order="long", af="double")


def cohort_counts(spark: SparkSession, folder: str, buckets: int = BUCKETS) -> VersionedTable:
    """Cohort counts of loci, kept up to date as calls arrive.

    A locus and unit (sample or file) is one row: the fraction of its first record, as in
    ``cohort.cohort_loci`` with an order. Only loci in touched buckets are counted anew.
    """

    def merge(rows: DataFrame) -> DataFrame:
        first = F.min(F.struct("first_order", "af")).alias("first")
        return rows.groupBy(*LOCUS, "unit").agg(first).select(*LOCUS, "unit", "first.*")

    def summary(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*LOCUS).agg(F.count(F.lit(1)).alias("cohort_count"), F.greatest(F.lit(0.0), F.max("af")).alias("max_af"))

    return VersionedTable(spark, folder, LOCUS, CARRIERS, merge, summary, buckets)


def arriving_carriers(calls: DataFrame, unit: str, order: str, af: str = "af") -> DataFrame:
    """Stream of calls as rows for :func:`cohort_counts`; an undefined fraction is null."""
    known = F.when(~F.isnan(af), F.col(af)).cast("double")
    return calls.select(*LOCUS, F.col(unit).alias("unit"), F.col(order).cast("long").alias("first_order"), known.alias("af"))


def common_loci(counts: DataFrame, min_samples: int = 4, min_vaf: float = 0.05) -> DataFrame:
    return counts.select(*LOCUS, "cohort_count", "max_af").where((F.col("cohort_count") >= min_samples) & (F.col("max_af") >= min_vaf))


_MARK = _schema(event_order="long", ts="timestamp", message="string", estimate="double")
STATUS = _schema(stage="string", **dict.fromkeys(MARKS, _MARK), any_order="long")


def stage_status(spark: SparkSession, folder: str, buckets: int = 8) -> VersionedTable:
    """Latest start, finish and error of each stage, kept up to date as events arrive; see :func:`stage_table`."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("stage").agg(*(F.max(k).alias(k) for k in MARKS), F.max("any_order").alias("any_order"))

    return VersionedTable(spark, folder, ["stage"], STATUS, merge, buckets=buckets)


def arriving_marks(events: DataFrame, message: Column) -> DataFrame:
    """Stream of ``(stage, type, ts, event_order, estimate_seconds)`` events as rows for :func:`stage_status`."""
    order = F.col("event_order").cast("long")
    mark = F.struct(order.alias("event_order"), F.col("ts").cast("timestamp").alias("ts"), message.cast("string").alias("message"), F.col("estimate_seconds").cast("double").alias("estimate"))
    return events.select("stage", *(F.when(F.col("type") == k, mark).alias(k) for k in MARKS), order.alias("any_order"))


def stage_table(status: DataFrame) -> DataFrame:
    """Status per stage from the rows of :func:`stage_status`.

    As ``runlog.stage_state``, with ``last_error``: the message of the latest error, until a start
    or finish clears it.
    """
    flat = status.select(
        "stage", *(F.col(f"{k}.event_order").alias(f"{k}_order") for k in MARKS), *(F.col(f"{k}.ts").alias(f"{k}_ts") for k in MARKS),
        F.greatest(*(F.col(f"{k}.estimate") for k in MARKS)).alias("_estimate"), F.col("error.message").alias("_message"),
    )
    return resolve_stage_state(flat, F.col("_estimate"), F.col("_message"))


STARTS_PER_GROUP = 8
_SEEN = "start_us binary, start_order binary, limit_ms binary, mark_us binary, mark_order binary"


def overdue_starts(marks: DataFrame, longest: str, delay: str = "10 minutes") -> DataFrame:
    """Stream of starts with no mark of their stage within their limit, by a state per stage and time range.

    ``marks (stage, type, ts, event_order, limit_ms)``; any later start, finish or error closes a
    start. A start is kept until the watermark, ``delay`` behind the latest mark, has passed
    ``longest``, the largest limit there is, after it; then it comes out if nothing met it. So
    alerts appear while the stream runs, and state is bounded by ``longest`` and ``delay``. Marks
    without stage or time, or later than ``delay``, are left out.

    A group has the starts of ``STARTS_PER_GROUP`` times ``longest`` of one stage and the marks that may
    meet them: those of its range and, as a second row, those up to ``longest`` after it. Only a start's
    next mark is looked at, so the work grows with the marks, not with the pairs of marks near each other.
    """
    spark = marks.sparkSession
    reach = spark.range(1).select(F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"interval {longest}"))).first()[0]
    width = STARTS_PER_GROUP * reach * 1000
    at = F.unix_micros("ts")
    timed = marks.where(F.col("type").isin(*MARKS) & F.col("ts").isNotNull() & F.col("stage").isNotNull()).withWatermark("ts", delay)
    bins = F.array_distinct(F.array(F.floor((at - reach * 1000) / F.lit(width)), F.floor(at / F.lit(width))))
    rows = timed.select(
        "stage", "ts", at.alias("us"), (F.col("type") == "start").alias("starts"), F.col("event_order").cast("long").alias("event_order"),
        F.col("limit_ms").cast("long").alias("limit_ms"), F.explode(bins).alias("bin"),
    )
    found = rows.groupBy("stage", "bin").applyInPandasWithState(
        _unmet(reach, width), "stage string, start_us long, limit_ms long", _SEEN, "append", "EventTimeTimeout"
    )
    return found.select(
        "stage", F.timestamp_micros("start_us").alias("start_ts"), (F.col("limit_ms") / 1000).alias("threshold_seconds"),
        F.timestamp_millis(F.unix_millis(F.timestamp_micros("start_us")) + F.col("limit_ms")).alias("alert_ts"),
    )


NO_LIMIT = np.iinfo(np.int64).min


def _unmet(reach: int, width: int):
    """Starts of a group that nothing met, once the watermark is ``reach`` milliseconds after them.

    State: starts that no mark has met so far, and marks not yet behind the watermark, which starts still to come may meet.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [np.frombuffer(b, np.int64) for b in state.get] if state.exists else [np.empty(0, np.int64)] * 5
        starts, seen = [held[:3]], [held[3:]]
        for batch in batches:
            us = batch["us"].to_numpy(np.int64)
            order, known = batch["event_order"], batch["event_order"].notna().to_numpy()
            number = order.fillna(0).to_numpy(np.int64)
            # A mark of the same time meets a start by a larger number; without numbers neither meets the other.
            seen.append([us, np.where(known, number, np.iinfo(np.int64).min)])
            own = batch["starts"].to_numpy(bool) & (us // width == key[1])
            limit = batch["limit_ms"].astype("Int64").fillna(NO_LIMIT).to_numpy(np.int64)
            starts.append([us[own], np.where(known, number, np.iinfo(np.int64).max)[own], limit[own]])
        at, number, limit = (np.concatenate(c) for c in zip(*starts))
        mark, order = (np.concatenate(c) for c in zip(*seen))
        sort = np.lexsort((order, mark))
        mark, order = mark[sort], order[sort]
        # How many marks are at or before each start, by time and number: marks go before starts of the same place.
        both = np.lexsort((np.repeat([0, 1], [len(mark), len(at)]), np.concatenate([order, number]), np.concatenate([mark, at])))
        upto = np.empty(len(both), np.int64)
        upto[both] = np.cumsum(both < len(mark))
        following = upto[len(mark) :]
        after = np.append(mark, np.iinfo(np.int64).max)[following]
        met = (limit != NO_LIMIT) & (following < len(mark)) & (after <= at + reach * 1000) & (after // 1000 <= at // 1000 + limit)
        at, number, limit = at[~met], number[~met], limit[~met]
        now = state.getCurrentWatermarkMs()
        over = -(-at // 1000) + reach <= now
        if over.any():
            told = pd.Series(limit[over]).astype("Int64")
            yield pd.DataFrame({"stage": key[0], "start_us": at[over], "limit_ms": told.mask(told == NO_LIMIT)})
        at, number, limit = at[~over], number[~over], limit[~over]
        ahead = mark > now * 1000
        mark, order = mark[ahead], order[ahead]
        if not len(at) and not len(mark):
            if state.exists:
                state.remove()
            return
        state.update(tuple(np.ascontiguousarray(c).tobytes() for c in (at, number, limit, mark, order)))
        # Without starts the marks wait until they are behind the watermark.
        state.setTimeoutTimestamp(max(1, now, -(-int(at.min()) // 1000) + reach - 1 if len(at) else int(mark.max()) // 1000 + 1))

    return run
