"""Run-log operators, association edge cases and streams on small inputs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from locusloom.functions.text import allele_fraction
from locusloom.operators import association, burden, checks, cohort, runlog, spectra
from locusloom.operators.ordered import ordered_scan
from locusloom.sources.genomic import vcf_records
from locusloom.streaming import runs

T0 = dt.datetime(2026, 1, 1)


def minute(m):
    return T0 + dt.timedelta(minutes=m)


def events(spark, rows):
    full = [(i, s, t, minute(m), 60.0) for i, (s, t, m) in enumerate(rows)]
    return spark.createDataFrame(full, "event_order long, stage string, type string, ts timestamp, estimate_seconds double")


def test_stage_state_follows_the_event_rules(spark):
    log = events(
        spark,
        [
            ("a", "start", 0), ("a", "error", 1), ("a", "start", 2), ("a", "scan", 3), ("a", "finish", 7),
            ("b", "start", 0), ("b", "finish", 1), ("b", "error", 2),
            ("c", "start", 0), ("c", "finish", 1), ("c", "start", 5),
            ("d", "scan", 4),
            ("e", "finish", 4),
        ],
    )
    got = {r["stage"]: r for r in runlog.stage_state(log, "event_order", "estimate_seconds").collect()}
    a, b, c, d, e = (got[k] for k in "abcde")
    assert (a["last_status"], a["last_duration"], a["last_estimate_error"], a["last_error_ts"]) == ("finished", 300.0, 240.0, None)
    assert (b["last_status"], b["last_duration"], b["last_error_ts"]) == ("error", 60.0, minute(2))
    assert (c["last_status"], c["last_end_ts"], c["last_duration"]) == ("running", None, None)
    assert d["last_status"] == "idle"
    assert (e["last_status"], e["last_duration"], e["last_end_ts"]) == ("finished", None, minute(4))


def test_anomalies(spark):
    rows = [("s1", "finished", None), ("s2", "running", minute(0)), ("s3", "finished", None), ("s4", "running", minute(50)), ("s5", None, None)]
    stages = spark.createDataFrame([(*r, 900) for r in rows], "stage string, last_status string, last_start_ts timestamp, estimate_seconds long")
    got = {r["stage"]: r for r in runlog.stage_anomalies(stages, F.lit(minute(60)).cast("timestamp")).collect()}
    assert [s for s, r in got.items() if r["out_of_order_finished"]] == ["s3"]
    assert [s for s, r in got.items() if r["multiple_running"]] == ["s4"]
    assert [s for s, r in got.items() if r["overdue"]] == ["s2"]
    assert {r["status"]: r["n"] for r in runlog.status_counts(stages).collect()} == {"finished": 2, "running": 2, "idle": 1}


def test_timeline_infers_the_indexing_step(spark):
    lines = [
        "CMD: gatk AddOrReplaceReadGroups",
        "[Mon Jan 05 10:00:00 UTC 2026] AddOrReplaceReadGroups --INPUT x",
        "[Mon Jan 05 10:05:00 UTC 2026] picard.AddOrReplaceReadGroups done. Elapsed time: 5.00 minutes.",
        "CMD: samtools index x.bam",
        "CMD: gatk SplitNCigarReads",
        "10:07 INFO SplitNCigarReads - Start Date/Time: January 5, 2026, 10:07:30 AM UTC",
        "[January 5, 2026, 10:17:30 AM UTC] org.SplitNCigarReads done. Elapsed time: 10.00 minutes.",
        "CMD: gatk HaplotypeCaller",
        "INFO ProgressMeter - chr1:1,000 2.5 3",
    ]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(lines)], "sample_id string, line_no long, line string")
    got = {r["step"]: r for r in runlog.step_timeline(df).collect()}
    index = got["samtools index"]
    assert index["start_inferred"] and index["end_inferred"] and index["done"] and index["minutes"] == pytest.approx(2.5)
    assert got["AddOrReplaceReadGroups"]["minutes"] == 5.0 and got["SplitNCigarReads"]["done"]
    assert not got["HaplotypeCaller"]["done"]
    assert runlog.last_commands(df).first()["last_step"] == "HaplotypeCaller"
    assert runlog.last_progress(df).first()["position"] == 1000
    assert runlog.tail_lines(df, 2).count() == 2


def test_duration_stats_of_a_single_value(spark):
    details = spark.createDataFrame([("a", 10.0), ("b", 0.05), ("c", 1.0), ("c", 4.0), ("d", 0.0)], "step string, elapsed_minutes double")
    got = {r["step"]: (r["min_minutes"], r["expected_minutes"], r["max_minutes"]) for r in runlog.duration_stats(details).collect()}
    assert got["a"] == (8.0, 10.0, 13.0) and got["c"] == (1.0, 2.5, 4.0) and "d" not in got
    assert got["b"][0] == 0.1


def test_manifest_numbers_in_case_insensitive_order(spark):
    files = spark.createDataFrame([("01", "m/b.tsv"), ("01", "m/A.tsv.gz"), ("01", "m/b.tsv"), ("02", "c")], "stage string, path string")
    got = {r["source"]: r["target"] for r in runlog.report_manifest(files).collect()}
    assert got == {"m/A.tsv.gz": "for_report/01_1_A.tsv.tsv.gz", "m/b.tsv": "for_report/01_2_b.tsv", "c": "for_report/02_1_c"}


def test_spearman_edges(spark):
    rows = [("a", 1.0, 10.0, 5.0, None), ("b", 2.0, 9.0, 5.0, 1.0), ("c", 3.0, 7.0, 5.0, 2.0), ("d", 4.0, 1.0, 5.0, None), ("e", None, None, 5.0, None)]
    wide = spark.createDataFrame(rows, "sample_id string, x double, y double, flat double, few double")
    got = {(r["metric_x"], r["metric_y"]): r for r in association.spearman_tests(association.spearman_pairs(wide)).collect()}
    # constant and rarely filled metrics give no pair
    assert list(got) == [("x", "y")]
    assert (got[("x", "y")]["spearman_rho"], got[("x", "y")]["p_value"], got[("x", "y")]["n_samples"]) == (-1.0, 0.0, 4)
    pairs = association.spearman_pairs(wide)
    matrix = {r["metric"]: r for r in association.correlation_matrix(pairs, ["x", "y", "flat"]).collect()}
    assert matrix["x"]["x"] == 1.0 and matrix["y"]["x"] == -1.0 and matrix["flat"]["x"] is None


def test_condition_summary_keeps_the_missing_condition(spark):
    wide = spark.createDataFrame([("a", "c", 1.0), ("b", None, 3.0), ("d", "c", None)], "sample_id string, condition string, m double")
    got = {r["condition"]: (r["sample_count"], r["m"]) for r in association.condition_summary(wide, ["m"]).collect()}
    assert got == {"c": (2, 1.0), None: (1, 3.0)}


def test_metadata_numbers_are_no_metrics(spark):
    meta = spark.createDataFrame([("S1.bam", 1, "x", 0), ("S1", 2, "y", 1)], "sample_id string, run_id int, condition string, line long")
    first = association.first_metadata(meta, "line")
    assert first.first().asDict() == {"sample_id": "S1", "condition": "x", "run_id": "1"}
    assert association.numeric_columns(first) == []
    empty = spark.createDataFrame([("a", None, 1)], "sample_id string, m double, k int")
    assert association.numeric_metrics(empty) == ["k"]


def test_driver_hits_and_enrichment(spark):
    long = spark.createDataFrame(
        [("g1", "A", "S1", 2), ("g2", "B", "S1", 1), ("g3", "C", "S2", 4)], "gene_id string, gene_name string, sample_id string, n long"
    )
    drivers = spark.createDataFrame([("A",), ("Z",)], "gene_name string")
    got = {r["sample_id"]: (r["driver_hits"], r["driver_genes"]) for r in burden.driver_hits(long, drivers).collect()}
    assert got == {"S1": (2, 1), "S2": (0, 0)}
    none = {r["sample_id"]: r["driver_hits"] for r in burden.driver_hits(long, drivers.limit(0)).collect()}
    assert none == {"S1": 0, "S2": 0}
    genes = spark.createDataFrame([(g,) for g in "ABCDEFGH"], "gene string")
    sets = spark.createDataFrame([("T", "A"), ("T", "B"), ("U", "H"), ("U", "other")], "term string, gene string")
    hits = spark.createDataFrame([("A",), ("B",), ("other",)], "gene string")
    got = {r["term"]: r for r in burden.pathway_enrichment(hits, sets, genes).collect()}
    assert got["T"]["p_value"] == pytest.approx(1 / 28) and got["T"]["fdr_bh"] == pytest.approx(2 / 28)
    assert (got["U"]["set_size"], got["U"]["overlap"], got["U"]["p_value"]) == (1, 0, 1.0)


def test_burden_uses_distinct_first_alleles(spark):
    loci = spark.createDataFrame([("c", 1, "A", "C"), ("c", 1, "A", "C,G"), ("c", 2, "A", "T")], "chrom string, pos long, ref string, alt string")
    genes = spark.createDataFrame([("c", 1, 1, "+", "g1", "A"), ("c", 1, 5, "+", "g2", "B"), ("c", 9, 9, "+", "g3", "C")], "chrom string, start long, end long, strand string, gene_id string, gene_name string")
    from locusloom.operators.intervals import annotate_variants

    table = annotate_variants(loci, genes, 4)
    calls = spark.createDataFrame([("c", 1, "A", "C,T", "S1"), ("c", 1, "A", "C", "S1"), ("c", 2, "A", "G", "S1"), ("c", 2, "A", "T", "S2")], "chrom string, pos long, ref string, alt string, sample_id string")
    long = burden.burden_long(calls, table)
    assert {(r["gene_id"], r["sample_id"], r["n"]) for r in long.collect()} == {("g1", "S1", 1), ("g2", "S1", 1), ("g2", "S2", 1)}
    wide = {r["gene_id"]: (r["S1"], r["S2"], r["S3"]) for r in burden.burden_wide(long, table, ["S1", "S2", "S3"]).collect()}
    assert wide == {"g1": (1, 0, 0), "g2": (1, 1, 0)}
    back = burden.wide_to_long(burden.burden_wide(long, table, ["S1", "S2", "S3"]))
    assert back.select(long.columns).exceptAll(long).isEmpty() and back.count() == 3
    with pytest.raises(ValueError):
        burden.burden_wide(long, table, [str(i) for i in range(10_001)])


def test_spectra_of_multibase_alleles(spark):
    calls = spark.createDataFrame(
        [("S", "A", "C"), ("S", "A", "C,T"), ("S", "AC", "GT"), ("S", "A", "*"), ("T", "A", "AT")], "sample_id string, ref string, alt string"
    )
    got = {r["sample_id"]: (r["variant_count"], r["snv_count"], r["indel_count"]) for r in spectra.mutation_burden(calls).collect()}
    assert got == {"S": (4, 3, 1), "T": (1, 0, 1)}
    wide = {r["sample_id"]: r["A>C"] for r in spectra.spectrum_wide(calls).collect()}
    assert wide == {"S": 2, "T": 0}
    totals = {r["sample_id"]: (r["signature_total"], r["signature_channels_nonzero"]) for r in spectra.spectrum_totals(calls).collect()}
    assert totals == {"S": (3, 2), "T": (0, 0)}


def test_alignment_checks(spark):
    meta = spark.createDataFrame([("A",), ("B",)], "sample_id string")
    matrix = spark.createDataFrame([("B",), ("C",)], "sample_id string")
    both = {(r["sample_id"], r["problem"]) for r in checks.misaligned_samples(meta, matrix).collect()}
    assert both == {("A", "not in matrix"), ("C", "not in metadata")}
    assert checks.misaligned_samples(meta, matrix, strict=False).count() == 1


def test_carriers_stream_picks_up_new_files(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "calls")
    os.makedirs(folder)

    def land(sample, af):
        text = f"##h\nchr1\t5\t.\tA\tC\t.\t.\t.\tGT:AF\t0/1:{af}\n"
        (folder / f"{sample}.filtered.vcf").write_text(text)

    def counts():
        records = vcf_records(runs.arriving_records(spark, str(folder)), 8)
        calls = runs.collect_carriers(records, table, table + "-cp", allele_fraction(F.col("format"), F.col("sample")))
        return [(r["cohort_count"], r["max_af"]) for r in cohort.cohort_loci(calls, 2, 0.05).collect()]

    land("A", 0.2)
    assert counts() == []
    land("B", 0.4)
    assert counts() == [(2, 0.4)]
    land("C", 0.1)
    assert counts() == [(3, 0.4)]


def test_alerts_and_late_rows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "alerts")
    schema = events(spark, [("a", "start", 0)]).schema

    def feed(rows):
        events(spark, rows).coalesce(1).write.mode("append").parquet(source)

    def stream():
        return spark.readStream.schema(schema).parquet(source)

    def alerts():
        runs.append_stream(runs.overdue_alerts(stream()), out, out + "-cp")
        return sorted((r["stage"], r["start_ts"], r["alert_ts"]) for r in spark.read.parquet(out).collect())

    feed([("a", "start", 0), ("b", "start", 0), ("b", "finish", 20), ("c", "start", 0), ("c", "error", 31)])
    # c failed after its limit of 30 minutes; a has no later event and time has not passed yet
    assert alerts() == [("c", minute(0), minute(30))]
    feed([("d", "start", 90)])
    assert ("a", minute(0), minute(30)) in alerts()
    windows, target = runs.event_windows(stream(), "1 hour", "10 minutes"), str(tmp_path / "w")
    runs.append_stream(windows, target, target + "-cp")
    feed([("e", "start", 5), ("e", "start", 200)])  # the first is later than the watermark allows
    runs.append_stream(windows, target, target + "-cp")
    got = {(r["window_start"], r["type"]): r["n"] for r in spark.read.parquet(target).collect()}
    assert got[(minute(0), "start")] == 3 and got[(minute(60), "start")] == 1


def test_alerts_of_a_hot_stage_in_many_files(spark, tmp_path, monkeypatch):
    source, out = str(tmp_path / "in"), str(tmp_path / "alerts")
    rows = [("hot", ("start", "finish", "error")[i % 3], i * (1 + i % 40)) for i in range(600)] + [(None, "start", 0), ("late", "start", 23955)]
    log = events(spark, rows)
    log.repartition(6).write.parquet(source)
    scans = []
    monkeypatch.setattr(runs, "ordered_scan", lambda *a, **k: scans.append(k) or ordered_scan(*a, **k))

    def alerts():
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
        runs.append_stream(runs.overdue_alerts(stream), out, out + "-cp")
        return sorted((r["stage"] or "", r["start_ts"]) for r in spark.read.parquet(out).collect())

    by_time = sorted((m, i, t) for i, (s, t, m) in enumerate(rows) if s == "hot")
    last = max(m for _, _, m in rows)
    follows = [m for m, _, _ in by_time[1:]] + [last - 10]
    want = [("hot", minute(m)) for (m, _, t), after in zip(by_time, follows) if t == "start" and after > m + 30] + [("", minute(0))]
    assert alerts() == sorted(want) and len(scans) == 1
    assert alerts() == sorted(want)  # nothing new
    # A finish before the open start of its stage doesn't close it.
    more = spark.createDataFrame([(700, "late", "finish", minute(last - 8), 60.0), (701, "x", "finish", minute(last + 60), 60.0)], log.schema)
    more.write.mode("append").parquet(source)
    assert alerts() == sorted([*want, ("late", minute(23955))])
