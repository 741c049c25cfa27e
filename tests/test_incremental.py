"""Streams that rewrite only what new rows touch, in several arrivals and after a broken run."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from locusloom.operators import cohort, runlog
from locusloom.streaming import incremental

T0 = dt.datetime(2026, 1, 1)
CALLS = "chrom string, pos long, ref string, alt string, sample_id string, line long, af double"


def minute(m):
    return T0 + dt.timedelta(minutes=m)


def land(frame, folder):
    frame.coalesce(1).write.mode("append").parquet(folder)


def loci(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture
def calls(spark):
    def make(rows):
        return spark.createDataFrame(rows, CALLS)

    return make


def test_cohort_counts_over_arrivals(spark, calls, tmp_path):
    folder, nan = str(tmp_path / "in"), float("nan")
    counts = incremental.cohort_counts(spark, str(tmp_path / "counts"), buckets=16)
    seen = []

    def arrive(rows):
        land(calls(rows), folder)
        seen.extend(rows)
        stream = spark.readStream.schema(CALLS).parquet(folder)
        touched = counts.advance(incremental.arriving_carriers(stream, "sample_id", "line"))
        batch = cohort.cohort_loci(calls(seen), 2, 0.05, order="line").select(*cohort.LOCUS, "cohort_count", "max_af")
        assert loci(incremental.common_loci(counts.current(), 2, 0.05)) == loci(batch)
        return touched

    first = [("chr1", p, "A", "C", s, 10 * p, 0.1 + p / 100) for p in range(40) for s in ("A", "B")]
    first += [("chr1", 3, "A", "C", "A", 5, 0.9), ("chr1", 3, "A", "C", "A", 900, 0.95), ("chr2", 1, "A", "C", "A", 1, nan), ("chr2", 1, "A", "C", "B", 1, None)]
    assert arrive(first) > 10
    before = counts.places()
    second = [("chr1", 3, "A", "C", "C", 1, 0.99), ("chr1", 3, "A", "C", "A", 1, 0.02)]
    assert arrive(second) == 1  # one locus, one bucket
    after = counts.places()
    changed = [b for b in after if after[b] != before[b]]  # all others keep their version
    assert len(changed) == 1 and set(after.values()) == {0, 1}
    assert sorted(os.listdir(tmp_path / "counts" / "rows-1"))[-1] == f"bucket={changed[0]}"
    arrive(second)  # the same calls delivered again
    found = loci(counts.current())
    land(calls([]), folder)
    assert counts.advance(incremental.arriving_carriers(spark.readStream.schema(CALLS).parquet(folder), "sample_id", "line")) == 0
    counts.vacuum()
    assert loci(counts.current()) == found


def test_untouched_buckets_are_not_read(spark, calls, tmp_path):
    folder = str(tmp_path / "in")
    counts = incremental.cohort_counts(spark, str(tmp_path / "c"), buckets=8)
    stream = lambda: incremental.arriving_carriers(spark.readStream.schema(CALLS).parquet(folder), "sample_id", "line")
    land(calls([("chr1", p, "A", "C", "A", p, 0.5) for p in range(60)]), folder)
    counts.advance(stream())
    row = calls([("chr1", 7, "A", "C", "B", 7, 0.5)])
    own = row.select(F.pmod(F.hash(*cohort.LOCUS), F.lit(8))).first()[0]
    for place in (tmp_path / "c" / "rows-0").glob("bucket=*/*.parquet"):
        if place.parent.name != f"bucket={own}":
            place.write_bytes(b"not Parquet")  # reading it would fail
    land(row, folder)
    assert counts.advance(stream()) == 1
    assert counts.current().where("cohort_count = 2").count() == 1 and counts.current().count() == 60


def test_a_broken_run_is_done_again(spark, calls, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    counts = incremental.cohort_counts(spark, str(tmp_path / "c"), buckets=4)
    stream = lambda: incremental.arriving_carriers(spark.readStream.schema(CALLS).parquet(folder), "sample_id", "line")
    land(calls([("chr1", 1, "A", "C", "A", 1, 0.5)]), folder)
    real = counts.summary
    counts.summary = lambda rows: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        counts.advance(stream())
    assert counts.version() == -1
    counts.summary = real
    land(calls([("chr1", 1, "A", "C", "B", 1, 0.7)]), folder)
    again = incremental.cohort_counts(spark, str(tmp_path / "c"), buckets=4)
    assert again.advance(stream()) == 1 and again.version() == 0
    assert loci(again.current()) == [("chr1", 1, "A", "C", 2, 0.7)]


def test_status_keeps_and_clears_the_error_message(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "stage string, type string, ts timestamp, event_order long, estimate_seconds double, message string"
    status = incremental.stage_status(spark, str(tmp_path / "status"))
    seen = []

    def arrive(*rows):
        new = [(s, t, minute(i), len(seen) + k, 60.0, m) for k, (s, t, i, m) in enumerate(rows)]
        seen.extend(new)
        land(spark.createDataFrame(new, schema), folder)
        fresh = incremental.stage_status(spark, str(tmp_path / "status"))  # as after a restart
        fresh.advance(incremental.arriving_marks(spark.readStream.schema(schema).parquet(folder), F.col("message")))
        table = incremental.stage_table(status.current())
        batch = runlog.stage_state(spark.createDataFrame(seen, schema), "event_order", "estimate_seconds")
        key = lambda r: str(r)
        assert sorted(map(tuple, table.drop("last_error").collect()), key=key) == sorted(map(tuple, batch.collect()), key=key)
        return {r["stage"]: r["last_error"] for r in table.collect()}

    assert arrive(("a", "start", 0, None), ("a", "error", 1, "no space"), ("b", "start", 0, None), (None, "error", 0, "odd"), ("c", "scan", 1, "x")) == {
        "a": "no space", "b": None, None: "odd", "c": None,
    }
    assert arrive(("b", "error", 5, "bad index"), ("b", "error", 6, "worse"))["b"] == "worse"
    got = arrive(("a", "start", 7, None), ("b", "finish", 8, None))
    assert got["a"] is None and got["b"] is None and got[None] == "odd"
    assert arrive(("a", "error", 9, None))["a"] is None


def test_unmet_starts_come_while_the_stream_runs(spark, tmp_path):
    from locusloom.streaming import runs

    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "stage string, type string, ts timestamp, event_order long, limit_ms long"
    half = 30 * 60_000

    def arrive(*rows):
        land(spark.createDataFrame([(s, t, minute(m), i, n) for i, s, t, m, n in rows], schema), folder)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        alerts = incremental.overdue_starts(stream, "60 minutes")
        runs.append_stream(alerts, out, out + "-cp")
        return sorted((r["stage"], r["start_ts"], r["alert_ts"]) for r in spark.read.schema(alerts.schema).parquet(out).collect())

    assert arrive((1, "a", "start", 0, half), (2, "b", "start", 0, 2 * half), (3, "c", "start", 0, half), (4, "c", "finish", 30, half), (5, "b", "error", 59, half)) == []
    # 71 minutes after the start of a, whose limit of 30 minutes nothing met; b and c were met in time
    assert arrive((6, "d", "finish", 71, half), (7, None, "start", 20, half), (8, "e", "scan", 500, half)) == [("a", minute(0), minute(30))]
    # a start at the time of its own mark is not met by itself, but by a later mark of one time
    got = arrive((9, "f", "start", 100, half), (10, "f", "finish", 100, half), (11, "g", "start", 100, half))
    assert got == [("a", minute(0), minute(30))]
    assert arrive((12, "x", "finish", 400, half)) == [("a", minute(0), minute(30)), ("g", minute(100), minute(130))]


def test_unmet_starts_of_one_dense_stage(spark, tmp_path):
    """A join of all starts with all marks of a stage would look at 200 million pairs here."""
    import random
    import time

    from locusloom.streaming import runs

    rng, half = random.Random(3), 30 * 60_000
    rows = [("a", "start" if i % 2 else "error", rng.randrange(60_000) / 1000, i, half) for i in range(20_000)]
    rows += [("a", "start", m, 30_000 + n, half) for n, m in enumerate((60.5, 95, 239.5, 269.6, 299, 420, 451))]
    rows += [("a", "finish", 420, None, half), ("a", "start", 480, None, None), ("b", "finish", 700, 1, half)]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "stage string, type string, ts timestamp, event_order long, limit_ms long"
    land(spark.createDataFrame([(s, t, minute(m), i, n) for s, t, m, i, n in rows], schema), folder)
    alerts = incremental.overdue_starts(spark.readStream.schema(schema).parquet(folder), "30 minutes")
    began = time.monotonic()
    runs.append_stream(alerts, out, out + "-cp")
    assert time.monotonic() - began < 60
    got = sorted((r["start_ts"], r["alert_ts"]) for r in spark.read.schema(alerts.schema).parquet(out).collect())
    assert got == [(minute(m), None if m == 480 else minute(m + 30)) for m in (60.5, 95, 239.5, 299, 420, 480)]
