"""Registered queries: each runs library operators over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.functions.text import (
    BURDEN_SUFFIXES,
    INTEGRATION_SUFFIXES,
    allele_fraction,
    barcode_core,
    file_name,
    mean_sd_text,
    minutes_text,
    natural_sort_text,
    normalize_sample_id,
    signed_minutes_text,
    strict_variant_class,
    variant_key,
)
from locusloom.operators import association, burden, cells, checks, cohort, folds, intervals, metadata, runlog, scoring, spectra
from locusloom.operators.ordered import average_rank, bh_adjust, group_median, ordered_scan
from locusloom.plans import files
from locusloom.plans.views import view
from locusloom.session import cut_lineage
from locusloom.sources import genomic
from locusloom.sources.lines import read_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Columns of wide tables are fixed so that their schema does not depend on the data.
SAMPLES = [f"S{i:02d}" for i in range(12)]
BIN = 256
METRICS = [
    "gene_burden_total",
    "burdened_gene_count",
    "mutation_variant_count",
    "mutation_snv_count",
    "mutation_indel_count",
    "signature_total",
    "cluster_variant_rows",
    "cluster_alt_sum_total",
    "cluster_depth_sum_total",
    "cluster_mean_vaf",
    "starsolo_detected_cells",
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    # Adding zero turns a rounded -0.0 into 0.0.
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# ---- shared inputs -------------------------------------------------------------------


def variants(spark, sf):
    return view(spark, sf, "fx_variants")


def genes(spark, sf):
    return view(spark, sf, "fx_genes").withColumnsRenamed({"g_start": "start", "g_end": "end"})


def common_loci(spark, sf):
    return cohort.cohort_loci(variants(spark, sf), order="rec_order")


def annotated(spark, sf):
    return intervals.annotate_variants(common_loci(spark, sf), genes(spark, sf), BIN)


def long_burden(spark, sf):
    return burden.burden_long(variants(spark, sf), annotated(spark, sf))


def sites(spark, sf, calls):
    """Distinct sites; calls are dealt by locus first, as few of them repeat within a task that reads them."""
    return view(spark, sf, "fx_sites", {"fx_variants": calls.repartition("chrom", "pos", "ref", "alt")})


def lookup(spark, sf):
    return cells.cluster_lookup(view(spark, sf, "fx_cluster_map"))


def cell_counts(spark, sf):
    return cells.cell_allele_counts(view(spark, sf, "fx_observed"), sites(spark, sf, variants(spark, sf)))


def cluster_sums(spark, sf):
    return cells.cluster_allele_sums(cell_counts(spark, sf), lookup(spark, sf))


# ---- cohort, annotation, burden ------------------------------------------------------


@query
def cohort_common_variants(spark, sf):
    calls = variants(spark, sf)
    loci = cohort.cohort_loci(calls, order="rec_order", with_first=True)
    first = cohort.first_records(calls, loci, ["cell"], "sample_id", "rec_order")
    return rounded(first, "max_af")


def full_cohort_records(spark, sf):
    calls = variants(spark, sf).select(
        "*",
        F.lit(".").alias("id"),
        F.lit("50").alias("qual"),
        F.lit("PASS").alias("filter"),
        F.when(F.col("cell") % 3 == 0, ".").otherwise(F.concat(F.lit("CELL="), F.col("cell").cast("string"))).alias("info"),
    )
    loci = cohort.cohort_loci(calls, order="rec_order", with_first=True)
    full = cohort.first_records(calls, loci, ["id", "qual", "filter", "info"], "sample_id", "rec_order")
    return cohort.cohort_records(full)


@query
def cohort_records(spark, sf):
    return full_cohort_records(spark, sf).drop("first_unit", "first_order")


@query
def variant_to_gene(spark, sf):
    return annotated(spark, sf)


@query
def gene_burden_long(spark, sf):
    return long_burden(spark, sf)


@query
def gene_burden_wide(spark, sf):
    table = cut_lineage(annotated(spark, sf))
    return burden.burden_wide(burden.burden_long(variants(spark, sf), table), table, SAMPLES)


@query
def gene_burden_totals(spark, sf):
    return burden.burden_totals(long_burden(spark, sf))


@query
def top_burdened_genes(spark, sf):
    return burden.top_genes(long_burden(spark, sf), 20)


@query
def hard_filter_tags(spark, sf):
    values = {"QD": F.col("qd"), "FS": F.col("fs"), "MQ": F.col("mq"), "SOR": F.col("sor")}
    tagged = cohort.hard_filter(variants(spark, sf), values)
    return tagged.select("sample_id", "chrom", "pos", "ref", "alt", "rec_order", "filter")


@query
def hard_filter_pass(spark, sf):
    values = {"QD": F.col("qd"), "FS": F.col("fs"), "MQ": F.col("mq"), "SOR": F.col("sor")}
    kept = cohort.passing(cohort.hard_filter(variants(spark, sf), values))
    return kept.groupBy("sample_id").agg(F.count(F.lit(1)).alias("passing"))


def vcf_folder(spark, sf):
    """Folder of the VCF files, which are made once per application."""
    rows = view(spark, sf, "fx_vcf_lines")
    named = rows.select(F.col("file_path").alias("name"), F.col("rec_order").alias("line_order"), "value")
    return files.made(spark, sf, "vcf", named)


def vcf_lines(spark, sf):
    return read_lines(spark, vcf_folder(spark, sf), recursive=True)


@query
def vcf_scan(spark, sf):
    records = genomic.vcf_records(vcf_lines(spark, sf), 8)
    quality = genomic.info_numbers(["QD", "FS"])
    return records.select(
        "sample_id",
        "chrom",
        "pos",
        "alt",
        variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt")).alias("key"),
        quality["QD"].alias("qd"),
        quality["FS"].alias("fs"),
        F.round(allele_fraction(F.col("format"), F.col("sample")), 6).alias("af"),
    )


@query
def records_per_file(spark, sf):
    counts = spectra.records_per_file(genomic.vcf_records(vcf_lines(spark, sf)))
    return counts.withColumn("file_path", F.concat(F.lit("vcf/"), file_name(F.col("file_path"))))


@query
def gtf_scan(spark, sf):
    return intervals.gene_intervals(genomic.gtf_features(view(spark, sf, "fx_gtf_lines")))


@query
def mutation_burden(spark, sf):
    return spectra.mutation_burden(variants(spark, sf))


@query
def substitution_spectrum_long(spark, sf):
    return spectra.spectrum_long(variants(spark, sf))


@query
def substitution_spectrum(spark, sf):
    return spectra.spectrum_wide(variants(spark, sf))


@query
def spectrum_totals(spark, sf):
    return spectra.spectrum_totals(variants(spark, sf))


@query
def strict_variant_classes(spark, sf):
    kind = strict_variant_class(F.col("ref"), F.col("alt"))
    return variants(spark, sf).groupBy("sample_id", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query
def driver_hits(spark, sf):
    drivers = view(spark, sf, "part").filter("p_retailprice < 950 and p_size < 10").select("p_brand")
    return burden.driver_hits(long_burden(spark, sf), drivers)


@query
def pathway_ora(spark, sf):
    known = genes(spark, sf).select(F.col("gene_id").alias("gene"))
    totals = long_burden(spark, sf).groupBy(F.col("gene_id").alias("gene")).agg(F.sum("n").alias("total"))
    hits = totals.filter("total >= 60").select("gene")
    return rounded(burden.pathway_enrichment(hits, view(spark, sf, "fx_gene_sets"), known), "p_value", "fdr_bh")


@query
def allele_fractions(spark, sf):
    af = F.round(allele_fraction(F.col("fmt"), F.col("smp")), 6)
    return view(spark, sf, "fx_format_strings").select("l_orderkey", "l_linenumber", "smp", af.alias("af"))


# ---- names and files -----------------------------------------------------------------


@query
def sample_id_normalize(spark, sf):
    name = file_name(F.col("path"))
    return view(spark, sf, "fx_files").select(
        "path",
        normalize_sample_id(name, BURDEN_SUFFIXES).alias("burden_id"),
        normalize_sample_id(name, INTEGRATION_SUFFIXES).alias("integration_id"),
    )


@query
def best_vcf_per_sample(spark, sf):
    return cohort.best_file_per_sample(view(spark, sf, "fx_files"))


@query
def best_burden_vcf(spark, sf):
    return cohort.best_burden_file(view(spark, sf, "fx_files"))


@query
def metadata_fastq_check(spark, sf):
    reads = metadata.reads_per_sample(metadata.read_files(view(spark, sf, "fx_files")))
    return metadata.read_flags(view(spark, sf, "fx_samples"), reads)


@query
def input_overview(spark, sf):
    reads = metadata.reads_per_sample(metadata.read_files(view(spark, sf, "fx_files")))
    return metadata.input_overview(metadata.read_flags(view(spark, sf, "fx_samples"), reads))


@query
def samples_without_third_read(spark, sf):
    third = metadata.read_files(view(spark, sf, "fx_files")).filter("read = 'R3'").select("sample_id").distinct()
    return checks.samples_without_files(view(spark, sf, "fx_samples"), third)


@query
def read_path(spark, sf):
    return metadata.read_path(metadata.read_files(view(spark, sf, "fx_files")))


@query
def natural_sort(spark, sf):
    names = view(spark, sf, "part").select(F.concat_ws("_", "p_name", F.col("p_partkey").cast("string")).alias("name"))
    keyed = cut_lineage(names.distinct().withColumn("_key", natural_sort_text(F.col("name"))))
    ranked = ordered_scan(keyed, [], "_key", {"_k": F.lit(1)})
    return ranked.select("name", (F.col("_k_before") + 1).cast("long").alias("position"))


# ---- cells and reads -----------------------------------------------------------------


@query
def cell_allele_counts(spark, sf):
    return cell_counts(spark, sf)


@query
def cell_cluster_lookup(spark, sf):
    return lookup(spark, sf)


@query
def cluster_allele_sums(spark, sf):
    return cluster_sums(spark, sf)


@query
def cluster_metrics(spark, sf):
    samples = variants(spark, sf).select("sample_id")
    return rounded(cells.cluster_metrics(cluster_sums(spark, sf), samples), "cluster_mean_vaf")


@query
def matrix_cluster_sums(spark, sf):
    """Counts as sparse matrices: positions from value lists, then back through the index joins."""
    given = {"fx_variants": cut_lineage(variants(spark, sf))}
    given |= {"fx_cells": cut_lineage(view(spark, sf, "fx_cells", given)), "fx_sites": cut_lineage(sites(spark, sf, given["fx_variants"]))}
    counts = cut_lineage(cells.cell_allele_counts(view(spark, sf, "fx_observed", given), given["fx_sites"]))
    loci = given["fx_sites"].withColumn("_key", F.concat_ws(":", "chrom", "pos", "ref", "alt"))
    listed = cut_lineage(ordered_scan(loci, [], "_key", {"_k": F.lit(1)}).withColumn("idx", F.col("_k_before") + 1))
    seen = given["fx_cells"].select("sample_id", "barcode")
    numbered = ordered_scan(seen, ["sample_id"], "barcode", {"_k": F.lit(1)})
    barcodes = cut_lineage(numbered.withColumn("idx", F.col("_k_before") + 1))
    at = counts.join(listed.select("chrom", "pos", "ref", "alt", F.col("idx").alias("row_idx")), ["chrom", "pos", "ref", "alt"])
    at = cut_lineage(at.join(barcodes.select("sample_id", "barcode", F.col("idx").alias("col_idx")), ["sample_id", "barcode"]))
    ad = at.filter("ad > 0").withColumn("value", F.col("ad"))
    dp = at.filter("dp > 0").withColumn("value", F.col("dp"))
    # The site list is shared by all samples, so it is looked up by the row index alone.
    aligned = cells.align_matrices(ad, dp)
    per_sample = seen.select("sample_id").distinct()
    named = cells.matrix_cells(
        aligned,
        listed.select("idx", "chrom", "pos", "ref", "alt").join(
            aligned.select("sample_id", F.col("row_idx").alias("idx")).distinct(), "idx"
        ),
        barcodes.join(per_sample, "sample_id", "left_semi"),
    )
    return cells.cluster_allele_sums(named, cells.cluster_lookup(view(spark, sf, "fx_cluster_map", given)), min_alt=2)


@query
def barcode_cores(spark, sf):
    return view(spark, sf, "fx_all_clusters").select("cell_id", barcode_core(F.col("cell_id")).alias("barcode"))


@query
def sample_contains(spark, sf):
    rows = view(spark, sf, "fx_all_clusters")
    return rows.filter(cells.sample_matches(F.col("sample"), "S0", "contains")).groupBy("sample").agg(F.count(F.lit(1)).alias("cells"))


def merged_reads(spark, sf):
    reads = view(spark, sf, "fx_reads").withColumns(
        {"header": F.concat(F.lit("@r"), F.col("record_idx").cast("string"), F.lit("/"), F.col("read")), "plus": F.lit("+")}
    )
    return cells.merge_barcode_reads(reads.filter("read = 'R2'"), reads.filter("read = 'R3'"))


@query
def fastq_merge_r2_r3(spark, sf):
    return merged_reads(spark, sf)


@query
def cb_umi_split(spark, sf):
    return cells.split_cb_umi(merged_reads(spark, sf)).select("sample_id", "record_idx", "cb", "umi")


@query
def whitelist_barcodes(spark, sf):
    split = cells.split_cb_umi(merged_reads(spark, sf)).select("sample_id", "record_idx", "cb")
    known = view(spark, sf, "fx_reads").filter("read = 'R2' and sample_id < 'S08'").select("seq")
    return cells.whitelisted(split, known)


# ---- integration and association -----------------------------------------------------


def integrated(spark, sf):
    """All summaries from one scan of the calls, which are written once, as are their distinct cells."""
    calls = cut_lineage(variants(spark, sf))
    given = {"fx_variants": calls}
    given["fx_cells"] = cut_lineage(view(spark, sf, "fx_cells", given))
    loci = cohort.cohort_loci(calls, order="rec_order")
    long = burden.burden_long(calls, intervals.annotate_variants(loci, genes(spark, sf), BIN))
    counts = cells.cell_allele_counts(view(spark, sf, "fx_observed", given), sites(spark, sf, calls))
    sums = cells.cluster_allele_sums(counts, cells.cluster_lookup(view(spark, sf, "fx_cluster_map", given)))
    samples = view(spark, sf, "fx_samples")
    detected = given["fx_cells"].select(
        "sample_id", F.concat(F.lit("solo/"), "sample_id", F.lit("/Gene/filtered/barcodes.tsv")).alias("file_path"), "cell"
    )
    return association.integrate_samples(
        burden.burden_totals(long),
        association.regroup_mutation_burden(spectra.mutation_burden(calls)),
        spectra.spectrum_totals(calls),
        cells.cluster_metrics(sums),
        cells.first_file_cells(detected),
        association.first_metadata(samples),
    )


@query
def sample_integration(spark, sf):
    wide = integrated(spark, sf)
    # Absent for samples without clusters, so shown as floating point.
    counts = {c: F.col(c).cast("double") for c in ("cluster_variant_rows", "cluster_count")}
    return rounded(wide.withColumns(counts), "cluster_mean_vaf")


@query
def condition_summary(spark, sf):
    return rounded(association.condition_summary(integrated(spark, sf), METRICS), *METRICS)


@query
def spearman_pairs(spark, sf):
    return rounded(association.spearman_pairs(integrated(spark, sf), METRICS).drop("pair_order"), "spearman_rho")


@query
def spearman_tests(spark, sf):
    tested = association.spearman_tests(association.spearman_pairs(integrated(spark, sf), METRICS))
    return rounded(tested.drop("pair_order", "spearman_rho"), "p_value", "fdr_bh", digits=5)


@query
def correlation_matrix(spark, sf):
    pairs = association.spearman_pairs(integrated(spark, sf), METRICS)
    return rounded(association.correlation_matrix(pairs, METRICS), *METRICS)


@query
def top_associations(spark, sf):
    pairs = rounded(association.spearman_pairs(integrated(spark, sf), METRICS).drop("pair_order"), "spearman_rho", digits=9)
    return rounded(association.top_associations(pairs, 10), "spearman_rho")


@query
def spearman_with_gaps(spark, sf):
    """Customer measures of which two are missing for many customers."""
    orders = view(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    spent = orders.agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.max("o_totalprice"), 2).alias("largest"))
    wide = view(spark, sf, "customer").join(spent, "c_custkey", "left").select(
        F.col("c_custkey").alias("sample_id"),
        "c_acctbal",
        F.col("c_nationkey").cast("double").alias("nation"),
        "n_orders",
        F.when(F.col("c_custkey") % 3 != 0, F.col("largest")).alias("largest"),
    )
    pairs = association.spearman_pairs(wide, ["c_acctbal", "nation", "n_orders", "largest"])
    return rounded(pairs.drop("pair_order"), "spearman_rho")


@query
def bh_fdr(spark, sf):
    return rounded(bh_adjust(view(spark, sf, "fx_pvalues"), "p"), "fdr_bh")


@query
def average_ranks(spark, sf):
    return average_rank(view(spark, sf, "events").select("event_id", "event_type", "value"), ["event_type"], "value")


@query
def group_medians(spark, sf):
    return group_median(view(spark, sf, "events"), ["event_type"], "value")


# ---- classification, folds, permutation ----------------------------------------------


@query
def roc_auc(spark, sf):
    return rounded(scoring.roc_auc(view(spark, sf, "fx_scores"), ["grp"], "y", "score"), "roc_auc")


@query
def classification_metrics(spark, sf):
    scores = view(spark, sf, "fx_scores")
    metrics = scoring.classification_metrics(scores, [], "y", "pred", "score")
    return rounded(metrics, "accuracy", "balanced_accuracy", "f1_positive", "roc_auc")


@query
def confusion_matrix(spark, sf):
    return scoring.confusion_matrix(view(spark, sf, "fx_scores"), "y", "pred", ("low", "high"), "documents")


@query
def group_predictions(spark, sf):
    rows = scoring.group_predictions(view(spark, sf, "fx_scores"), ["grp"], "y", "prob", "score", "title")
    return rounded(rows, "mean_prob_positive", "mean_decision_score")


def customer_folds(spark, sf):
    people = view(spark, sf, "fx_customers")
    table = folds.stratified_folds(people, "sample_id", "label", folds=5, repeats=3)
    return table.join(people.select("sample_id", "gsm"), "sample_id")


@query
def stratified_folds(spark, sf):
    return folds.stratified_folds(view(spark, sf, "fx_customers"), "sample_id", "label", folds=5, repeats=3)


@query
def logo_folds(spark, sf):
    return folds.logo_folds(view(spark, sf, "fx_customers"), "gsm")


@query
def fold_group_overlap(spark, sf):
    return rounded(folds.fold_group_overlap(customer_folds(spark, sf), "gsm"), "test_group_overlap_rate")


@query
def fold_summary(spark, sf):
    table = folds.fold_group_overlap(customer_folds(spark, sf), "gsm").withColumn("share", F.col("n_test") / 7)
    summary = folds.fold_summary(table, ["share"])
    return rounded(summary, *[c for c in summary.columns if c != "n_folds"])


@query
def group_label_check(spark, sf):
    return checks.mixed_label_groups(view(spark, sf, "fx_customers"), "gsm", "label")


@query
def class_size_check(spark, sf):
    return checks.class_sizes(view(spark, sf, "fx_customers"), "label")


def labelings(spark, sf):
    samples = folds.binary_label(view(spark, sf, "fx_samples"), "condition", "disease")
    return samples, folds.group_labelings(samples, "gsm", "y")[0]


@query
def group_labelings(spark, sf):
    table = labelings(spark, sf)[1]
    return table.select("permutation_id", F.array_join("positive_groups", ";").alias("positive_groups"), "is_observed_labeling")


@query
def relabeled_samples(spark, sf):
    samples, table = labelings(spark, sf)
    return folds.relabel_samples(samples, table, "sample_id", "gsm")


@query
def permuted_labels(spark, sf):
    people = folds.binary_label(view(spark, sf, "fx_customers"), "label", "BUILDING")
    return folds.permuted_labels(people, "sample_id", "y", permutations=5)


@query
def permutation_pvalue(spark, sf):
    scores = view(spark, sf, "events").select(F.round(F.col("value") % 1, 2).alias("a"), F.round((F.col("value") * 3) % 1, 2).alias("b"))
    observed = view(spark, sf, "events").filter("event_id = 17").select(
        F.round(F.col("value") % 1, 2).alias("a"), F.round((F.col("value") * 3) % 1, 2).alias("b")
    )
    known = [(m, observed.select(m).scalar()) for m in ("a", "b")]
    exact = scoring.permutation_pvalues(scores, known, ["a", "b"], exact=True).withColumn("method", F.lit("exact"))
    drawn = scoring.permutation_pvalues(scores, known, ["a", "b"], exact=False).withColumn("method", F.lit("random"))
    return rounded(exact.unionByName(drawn), "p_value")


@query
def display_text(spark, sf):
    e = view(spark, sf, "events")
    return e.select(
        "event_id",
        mean_sd_text(F.col("value") / 8, F.when(F.col("event_id") % 2 == 0, F.col("value") / 16)).alias("mean_sd"),
        minutes_text(F.col("value")).alias("minutes"),
        signed_minutes_text(F.col("value") - 50).alias("signed_minutes"),
    )


# ---- run log -------------------------------------------------------------------------


def stage_events(spark, sf):
    return view(spark, sf, "fx_stage_events").withColumn("ts", F.col("ts").cast("timestamp"))


def plain_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def stage_rows(spark, sf):
    return runlog.stage_state(stage_events(spark, sf), "event_id", "estimate_seconds")


@query
def stage_status(spark, sf):
    rows = plain_time(stage_rows(spark, sf), "last_start_ts", "last_end_ts", "last_error_ts")
    return rounded(rows, "last_duration", "last_estimate_error", digits=3)


@query
def stage_durations(spark, sf):
    rows = plain_time(runlog.stage_durations(stage_events(spark, sf), "event_id", "estimate_seconds"), "start_ts", "end_ts")
    return rounded(rows, "duration", "estimate_error", digits=3)


@query
def stage_anomalies(spark, sf):
    events = stage_events(spark, sf)
    estimates = events.groupBy("stage").agg(F.max("estimate_seconds").alias("estimate_seconds"))
    now = events.agg(F.max("ts")).scalar()
    return runlog.stage_anomalies(stage_rows(spark, sf).join(estimates, "stage"), now)


@query
def status_counts(spark, sf):
    return runlog.status_counts(stage_rows(spark, sf))


@query
def changed_stages(spark, sf):
    notes = view(spark, sf, "events").filter("event_type = 'signup'").groupBy(
        F.concat(F.lit("stage_"), F.lpad((F.col("user_id") % 17 + 1).cast("string"), 2, "0")).alias("stage")
    ).agg(F.concat(F.lit("changed by "), F.min("event_id").cast("string")).alias("change_note"))
    rows = runlog.annotate_changes(stage_rows(spark, sf), notes)
    return rows.select("stage", "last_status", "changed", "change_note")


@query
def latest_events(spark, sf):
    rows = runlog.latest_first(stage_events(spark, sf), "stage_05", 25, tie="event_id")
    return plain_time(rows, "ts").select("stage", "type", "ts", "event_id")


@query
def log_done_steps(spark, sf):
    return rounded(runlog.done_steps(view(spark, sf, "fx_log_lines")), "elapsed_minutes")


def all_reports(spark, sf):
    lines = view(spark, sf, "fx_log_lines").filter(runlog.is_done(F.col("line")))
    return lines.select("sample_id", runlog.step_of(F.col("line")).alias("step"), runlog.elapsed_minutes(F.col("line")).alias("elapsed_minutes"))


@query
def log_step_stats(spark, sf):
    return rounded(runlog.duration_stats(all_reports(spark, sf)), "min_minutes", "expected_minutes", "max_minutes")


def input_sizes(spark, sf):
    return view(spark, sf, "fx_log_lines").groupBy("sample_id").agg((F.count(F.lit(1)) / 100).alias("input_gb"))


@query
def size_duration_model(spark, sf):
    model = runlog.step_size_model(all_reports(spark, sf), input_sizes(spark, sf))
    return rounded(model, "min_per_gb", "expected_per_gb", "max_per_gb")


@query
def sample_duration_model(spark, sf):
    spans = all_reports(spark, sf).groupBy("sample_id").agg(F.round(F.sum("elapsed_minutes"), 3).alias("minutes"))
    model = runlog.sample_size_model(spans, input_sizes(spark, sf))
    return rounded(model, "min_per_gb", "expected_per_gb", "max_per_gb")


@query
def last_log_commands(spark, sf):
    return runlog.last_commands(view(spark, sf, "fx_log_lines"))


@query
def last_log_progress(spark, sf):
    return runlog.last_progress(view(spark, sf, "fx_log_lines"))


def contigs(spark, sf):
    lengths = variants(spark, sf).groupBy("chrom").agg(F.max("pos").alias("length"))
    return runlog.contig_offsets(lengths.withColumnRenamed("chrom", "contig"), "contig")


@query
def contig_offsets(spark, sf):
    return contigs(spark, sf)


@query
def log_progress_fraction(spark, sf):
    progress = runlog.last_progress(view(spark, sf, "fx_log_lines"))
    return rounded(runlog.progress_fraction(progress, contigs(spark, sf)), "fraction")


@query
def log_tails(spark, sf):
    lines = view(spark, sf, "fx_log_lines")
    return runlog.tail_lines(lines, 6, runlog.is_done(F.col("line")))


def listed_files(spark, sf):
    pages = view(spark, sf, "pages")
    ending = F.element_at(F.array(*[F.lit(e) for e in (".tsv", ".PNG", ".md", ".tsv.gz", ".csv", ".json")]), (F.col("page_id") % 6 + 1).cast("int"))
    return pages.select(
        F.concat(F.lit("stage_"), (F.col("page_id") % 4).cast("string")).alias("stage"),
        F.concat(F.lit("out/File_"), F.col("page_id").cast("string"), ending).alias("path"),
        F.length("html").cast("long").alias("size_bytes"),
    )


@query
def file_summary(spark, sf):
    return runlog.file_summary(listed_files(spark, sf))


@query
def report_manifest(spark, sf):
    return runlog.report_manifest(listed_files(spark, sf))
