"""Streams over the run's event table and over arriving variant files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.operators.ordered import ordered_scan
from locusloom.operators.runlog import resolve_stage_state, stage_state_aggregates
from locusloom.session import cut_lineage

ALERT_SCHEMA = "stage string, start_ts timestamp, threshold_seconds double, alert_ts timestamp"


def current_stage_state(events: DataFrame, order: str, estimate: str | None = None) -> DataFrame:
    """Status per stage, updated by every event; state is one row per stage."""
    parts = stage_state_aggregates(order)
    if estimate:
        parts.append(F.max(estimate).alias("_estimate"))
    return resolve_stage_state(events.groupBy("stage").agg(*parts), F.col("_estimate") if estimate else None)


def event_windows(events: DataFrame, width: str = "1 hour", delay: str = "10 minutes", kind: str = "type") -> DataFrame:
    """Events per kind in tumbling windows; rows later than the delay are dropped."""
    counted = events.withWatermark("ts", delay).groupBy(F.window("ts", width), kind).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), kind, "n")


class OverdueAlerts:
    """Alerts over a stream of marks, for :func:`append_stream`.

    The stream appends the marks to a table, one micro-batch at a time and exactly once; nothing
    is grouped in it. Then the next mark of every new start is found by ``ordered_scan``, which
    splits a stage with many marks over tasks. A small table beside the checkpoint carries the
    open start of each stage, the latest time and the names of the files that are done. It is
    written after the alerts of its run, which replace those of a run that broke off.
    """

    schema = ALERT_SCHEMA

    def __init__(self, marks: DataFrame, delay: str):
        self.marks, self.delay = marks, delay

    def append(self, table: str, checkpoint: str) -> None:
        spark = self.marks.sparkSession
        append_stream(self.marks, f"{checkpoint}/marks", f"{checkpoint}/stream")
        run = 0
        while _exists(spark, f"{checkpoint}/state-{run}/_SUCCESS"):
            run += 1
        order = self.marks.schema["event_order"].dataType.simpleString()
        state_schema = f"kind string, value string, ts timestamp, event_order {order}, limit_ms long"
        state = spark.createDataFrame([], state_schema)
        if run:
            state = spark.read.schema(state_schema).parquet(f"{checkpoint}/state-{run - 1}")
        fresh, files = spark.createDataFrame([], self.marks.schema), []
        if _exists(spark, f"{checkpoint}/marks"):
            done = {r["value"] for r in state.where("kind = 'file'").collect()}
            files = [f for f in spark.read.schema(self.marks.schema).parquet(f"{checkpoint}/marks").inputFiles() if f not in done]
            fresh = spark.read.schema(self.marks.schema).parquet(*files) if files else fresh
        if run and not files:
            return
        alerts, after = self._advance(fresh, state)
        alerts.write.mode("overwrite").parquet(f"{table}/run={run}")
        names = spark.createDataFrame([("file", f) for f in files], "kind string, value string").unionByName(
            state.where("kind = 'file'"), allowMissingColumns=True
        )
        after.unionByName(names, allowMissingColumns=True).coalesce(1).write.mode("overwrite").parquet(f"{checkpoint}/state-{run}")

    def _advance(self, fresh: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Alerts of a run and the open starts and latest time after it."""
        back = F.expr(f"interval {self.delay}")
        before = state.where("kind = 'time'").agg(F.max("ts")).select(F.unix_micros("max(ts)")).first()[0]
        newest = fresh.agg(F.max("ts")).select(F.unix_micros("max(ts)")).first()[0]
        if before is not None:
            fresh = fresh.where(F.col("ts") > F.timestamp_micros(F.lit(before)) - back)
        newest = max((t for t in (before, newest) if t is not None), default=None)
        carried = state.where("kind = 'open'").select(F.col("value").alias("stage"), F.lit("start").alias("type"), "ts", "event_order", "limit_ms")
        # A join drops a null stage, so the key is never null.
        rows = cut_lineage(
            fresh.unionByName(carried)
            .withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("stage")), F.lit("")))
            .withColumn("place", F.struct("ts", "event_order"))
        )
        mark = F.struct("place", "type", "limit_ms", "stage")
        scanned = ordered_scan(rows, ["key"], "place", maxes={"mark": mark})
        started = F.unix_millis("m.place.ts") + F.col("m.limit_ms")
        followed = scanned.select("ts", F.col("mark_before").alias("m")).where("m.type = 'start'")
        last = rows.groupBy("key").agg(F.max(mark).alias("m")).where("m.type = 'start'")
        passed = F.unix_millis(F.timestamp_micros(F.lit(newest).cast("long")) - back) > started
        over = followed.where(F.unix_millis("ts") > started).select("m").unionByName(last.where(passed).select("m"))
        alerts = over.select(
            "m.stage",
            F.timestamp_millis(F.unix_millis("m.place.ts")).alias("start_ts"),
            (F.col("m.limit_ms") / 1000).alias("threshold_seconds"),
            F.timestamp_millis(started).alias("alert_ts"),
        )
        opened = last.where(~passed).select(
            F.lit("open").alias("kind"), F.col("m.stage").alias("value"), "m.place.ts", "m.place.event_order", "m.limit_ms"
        )
        time = state.sparkSession.range(1).select(F.lit("time").alias("kind"), F.timestamp_micros(F.lit(newest).cast("long")).alias("ts"))
        return alerts, opened.unionByName(time, allowMissingColumns=True)


def _exists(spark: SparkSession, place: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def overdue_alerts(events: DataFrame, delay: str = "10 minutes") -> OverdueAlerts:
    """Alert once per stage start that runs over max(2 x estimate, 1800 s) of event time.

    Input columns: ``stage, type, ts, event_order, estimate_seconds``. The marks that one
    :func:`append_stream` finds are handled in time order, however they are cut into files; what
    comes later than ``delay`` behind the latest mark of earlier runs is dropped. Marks without
    a time are left out. The source's ``maxFilesPerTrigger`` bounds a micro-batch.
    """
    limit = F.greatest(F.col("estimate_seconds").cast("double") * 2.0, F.lit(1800.0)) * 1000
    marks = events.filter(F.col("type").isin("start", "finish", "error") & F.col("ts").isNotNull())
    return OverdueAlerts(marks.select("stage", "type", "ts", "event_order", limit.cast("long").alias("limit_ms")), delay)


def append_stream(df: DataFrame | OverdueAlerts, table: str, checkpoint: str) -> None:
    """Run a stream over what is there now and append its rows to a Parquet folder, exactly once.

    Alerts get a folder ``run=...`` per run.
    """
    if isinstance(df, OverdueAlerts):
        return df.append(table, checkpoint)
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(table)
    )
    query.awaitTermination()


def state_table(df: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Run a complete-mode stream over what is there now; for results of a bounded number of keys."""
    query = (
        df.writeStream.format("memory")
        .queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return df.sparkSession.table(name)


def arriving_records(spark: SparkSession, folder: str, glob: str = "*.vcf") -> DataFrame:
    """Stream of VCF lines ``(value, file_path)`` of files as they land in a folder."""
    lines = spark.readStream.option("pathGlobFilter", glob).text(folder)
    return lines.select("value", F.col("_metadata.file_path").alias("file_path"))


def collect_carriers(records: DataFrame, table: str, checkpoint: str, af: Column) -> DataFrame:
    """Append typed calls of new files and return the table of all calls so far.

    The stream keeps no state: each file is parsed once, and ``cohort_loci`` over the
    table gives the cohort counts as of now.
    """
    calls = records.select("sample_id", "chrom", "pos", "ref", "alt", af.alias("af"))
    append_stream(calls, table, checkpoint)
    return records.sparkSession.read.schema(calls.schema).parquet(table)
