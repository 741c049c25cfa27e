"""Registered queries that run the streams over the driver tables until all input is read."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from locusloom.operators import cohort
from locusloom.plans.queries import plain_time, query, rounded
from locusloom.plans.views import VIEWS
from locusloom.session import shared_folder
from locusloom.streaming import incremental, runs


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _stream(spark, sf, table, **options):
    schema = spark.read.parquet(f"{sf}/{table}.parquet").schema
    return spark.readStream.schema(schema).options(pathGlobFilter=f"{table}.parquet", **options).parquet(sf)


def _stage_events(spark, sf, **options):
    # The watermark needs a time stamp with a time zone.
    events = _stream(spark, sf, "events", **options)
    return spark.sql(VIEWS["fx_stage_events"], events=events).withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_stage_status(spark, sf):
    rows = runs.current_stage_state(_stage_events(spark, sf), "event_id", "estimate_seconds")
    name = f"stage_state_{uuid.uuid4().hex}"
    table = runs.state_table(rows, name, _folder(spark, "state"))
    table = plain_time(table, "last_start_ts", "last_end_ts", "last_error_ts")
    return rounded(table, "last_duration", "last_estimate_error", digits=3)


@query
def stream_event_windows(spark, sf):
    target = _folder(spark, "windows")
    windows = runs.event_windows(_stage_events(spark, sf), "1 hour", "10 minutes")
    runs.append_stream(windows, target, target + "-checkpoint")
    return plain_time(spark.read.schema(windows.schema).parquet(target), "window_start", "window_end")


@query
def stream_overdue_alerts(spark, sf):
    target = _folder(spark, "alerts")
    events = _stage_events(spark, sf, maxFilesPerTrigger=8).withColumnRenamed("event_id", "event_order")
    alerts = runs.overdue_alerts(events)
    runs.append_stream(alerts, target, target + "-checkpoint")
    found = spark.read.schema(alerts.schema).parquet(target).drop("run")
    return plain_time(found, "start_ts", "alert_ts")


@query
def stream_cohort_counts(spark, sf):
    target = _folder(spark, "carriers")
    records = spark.sql(VIEWS["fx_variants"], lineitem=_stream(spark, sf, "lineitem"))
    calls = runs.collect_carriers(records, target, target + "-checkpoint", F.col("af"))
    return rounded(cohort.cohort_loci(calls), "max_af")


def _arrivals(df, name, column):
    """Folder that rows land in as two deliveries, by the parity of a column; yields it after each."""
    folder = _folder(df.sparkSession, name)
    for odd in (0, 1):
        df.where(F.pmod(F.xxhash64(column), F.lit(2)) == odd).write.mode("append").parquet(folder)
        yield df.sparkSession.readStream.schema(df.schema).parquet(folder)


@query
def stream_cohort_versions(spark, sf):
    """Calls of half the samples, then of the others: loci counted anew only in the buckets that the second half touches."""
    calls = spark.sql(VIEWS["fx_variants"], lineitem=spark.read.parquet(f"{sf}/lineitem.parquet"))
    counts = incremental.cohort_counts(spark, _folder(spark, "cohort"))
    for arrived in _arrivals(calls, "calls", "sample_id"):
        counts.advance(incremental.arriving_carriers(arrived, "sample_id", "rec_order"))
    return rounded(incremental.common_loci(counts.current()), "max_af")


@query
def stream_stage_errors(spark, sf):
    """Stage status with the message of the latest error, after two deliveries of events."""
    events = spark.sql(VIEWS["fx_stage_events"], events=spark.read.parquet(f"{sf}/events.parquet")).withColumnRenamed("event_id", "event_order")
    status = incremental.stage_status(spark, _folder(spark, "status"))
    message = F.concat(F.lit("failed at "), F.col("event_order").cast("string"))
    for arrived in _arrivals(events, "events", "event_order"):
        status.advance(incremental.arriving_marks(arrived, message))
    table = incremental.stage_table(status.current()).select("stage", "last_status", "last_start_ts", "last_end_ts", "last_error", "last_error_ts")
    return plain_time(table, "last_start_ts", "last_end_ts", "last_error_ts")


@query
def stream_unmet_starts(spark, sf):
    """Starts that no mark of their stage met within the limit of half an hour, by a state per stage and time range."""
    target = _folder(spark, "unmet")
    limit = (F.greatest(F.col("estimate_seconds") * 2, F.lit(1800.0)) * 1000).cast("long").alias("limit_ms")
    marks = _stage_events(spark, sf).select("stage", "type", "ts", F.col("event_id").alias("event_order"), limit)
    alerts = incremental.overdue_starts(marks, "30 minutes")
    runs.append_stream(alerts, target, target + "-checkpoint")
    return plain_time(spark.read.schema(alerts.schema).parquet(target), "start_ts", "alert_ts")
