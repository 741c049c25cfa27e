"""Per-cell allele counts, sparse matrices, clusters and barcode reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusloom.functions.text import barcode_core, fixed_text
from locusloom.session import cut_lineage

LOCUS = ["chrom", "pos", "ref", "alt"]
TASKS = 2


def cell_allele_counts(observed: DataFrame, sites: DataFrame) -> DataFrame:
    """AD and DP per cell and site from observed bases ``(sample_id, barcode, chrom, pos, base)``.

    Barcodes are reduced to their bare form. Bases are counted per cell and position before
    sites are attached, so deep positions reach the join as at most a handful of rows per cell.
    Rows are dealt by cell and position before they are counted: few repeat within a task that
    reads them, and such a task would hold a count for nearly every row of its part of the file.
    The number of tasks is given, ``TASKS`` per shuffle partition: where Spark merges partitions by
    their packed bytes, the counts that one task makes of them may be fifty times as large.
    """
    tasks = TASKS * int(observed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bare = observed.withColumn("barcode", barcode_core(F.col("barcode"))).repartition(tasks, "sample_id", "barcode", "chrom", "pos")
    counted = bare.groupBy("sample_id", "barcode", "chrom", "pos", "base").agg(F.count(F.lit(1)).alias("_n"))
    known = sites.select(*LOCUS).distinct().repartition(tasks, "chrom", "pos")
    placed = counted.repartition(tasks, "chrom", "pos").join(known, ["chrom", "pos"])
    base = F.col("base")
    return placed.groupBy("sample_id", "barcode", *LOCUS).agg(
        F.coalesce(F.sum(F.when(base == F.col("alt"), F.col("_n"))), F.lit(0)).alias("ad"),
        F.coalesce(F.sum(F.when(base.isin(F.col("ref"), F.col("alt")), F.col("_n"))), F.lit(0)).alias("dp"),
    )


def sample_matches(value: Column, sample: str, mode: str = "equals") -> Column:
    """Does a map row belong to ``sample``? ``contains`` also accepts longer names."""
    if mode not in ("equals", "contains"):
        raise ValueError(f"unknown sample mode {mode!r}")
    return value == F.lit(sample) if mode == "equals" else F.contains(value, F.lit(sample))


def cluster_lookup(cell_map: DataFrame, order: str | None = None) -> DataFrame:
    """``(sample_id, barcode, cluster)`` with one row per barcode; the last row of the map wins."""
    keyed = cell_map.withColumn("barcode", barcode_core(F.col("cell_id")))
    last = F.max_by("cluster", order) if order else F.max("cluster")
    return keyed.groupBy(F.col("sample").alias("sample_id"), "barcode").agg(last.alias("cluster"))


def cluster_allele_sums(cells: DataFrame, clusters: DataFrame, min_alt: int = 3) -> DataFrame:
    """Σ AD and Σ DP per variant and cluster with VAF; unmapped cells are dropped.

    Both sides carry bare barcodes, as ``cell_allele_counts``, ``matrix_cells`` and
    ``cluster_lookup`` make them. The clusters are written once, so that the join is planned from
    their size: while they can be broadcast, the counts, far more, stay where they are.
    """
    known = cut_lineage(clusters.select("sample_id", "barcode", "cluster"))
    sums = (
        cells.join(known, ["sample_id", "barcode"])
        .groupBy("sample_id", *LOCUS, "cluster")
        .agg(F.sum("ad").alias("alt_sum"), F.sum("dp").alias("depth_sum"))
    )
    vaf = F.when(F.col("depth_sum") > 0, F.col("alt_sum") / F.col("depth_sum")).otherwise(0.0)
    return sums.filter(F.col("alt_sum") >= min_alt).withColumn("vaf", F.bround(vaf, 6))


def cluster_sums_text(sums: DataFrame) -> DataFrame:
    """The cluster table as written to disk, VAF with six places."""
    return sums.withColumn("vaf", fixed_text(F.col("vaf"), 6))


def cluster_metrics(sums: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Rows, allele and depth totals, pooled VAF and clusters per sample.

    ``samples`` adds samples whose cluster table was empty, with zeros.
    """
    per = sums.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("cluster_variant_rows"),
        F.sum("alt_sum").cast("double").alias("cluster_alt_sum_total"),
        F.sum("depth_sum").cast("double").alias("cluster_depth_sum_total"),
        F.avg("vaf").alias("_mean"),
        F.count_distinct("cluster").alias("cluster_count"),
    )
    pooled = F.when(
        F.col("cluster_depth_sum_total") > 0, F.col("cluster_alt_sum_total") / F.col("cluster_depth_sum_total")
    ).otherwise(F.col("_mean"))
    per = per.select(
        "sample_id",
        "cluster_variant_rows",
        "cluster_alt_sum_total",
        "cluster_depth_sum_total",
        pooled.alias("cluster_mean_vaf"),
        "cluster_count",
    )
    if samples is None:
        return per
    return samples.select("sample_id").distinct().join(per, "sample_id", "left").na.fill(0)


def align_matrices(ad: DataFrame, dp: DataFrame) -> DataFrame:
    """AD and DP of one or more sparse matrices side by side; absent cells are zero."""
    at = ["sample_id", "row_idx", "col_idx"]
    left = ad.select(*at, F.col("value").alias("ad"))
    right = dp.select(*at, F.col("value").alias("dp"))
    return left.join(right, at, "full_outer").select(
        *at, F.coalesce("ad", F.lit(0)).cast("long").alias("ad"), F.coalesce("dp", F.lit(0)).cast("long").alias("dp")
    )


def matrix_shape_violations(ad_shape: DataFrame, dp_shape: DataFrame, variants: DataFrame) -> DataFrame:
    """Samples whose AD and DP shapes differ, or whose rows do not match the variant list."""
    listed = variants.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_variants"))
    a = ad_shape.select("sample_id", F.col("n_rows").alias("ad_rows"), F.col("n_cols").alias("ad_cols"))
    d = dp_shape.select("sample_id", F.col("n_rows").alias("dp_rows"), F.col("n_cols").alias("dp_cols"))
    both = a.join(d, "sample_id", "full_outer").join(listed, "sample_id", "full_outer")
    same = (
        F.col("ad_rows").eqNullSafe(F.col("dp_rows"))
        & F.col("ad_cols").eqNullSafe(F.col("dp_cols"))
        & F.col("ad_rows").eqNullSafe(F.col("n_variants"))
    )
    return both.filter(~same)


def matrix_cells(aligned: DataFrame, variants: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Replace matrix positions by variant and bare barcode; both lists carry ``idx`` from 1."""
    named = aligned.join(
        variants.select("sample_id", F.col("idx").alias("row_idx"), *LOCUS), ["sample_id", "row_idx"]
    )
    bare = barcode_core(F.col("barcode")).alias("barcode")
    named = named.join(barcodes.select("sample_id", F.col("idx").alias("col_idx"), bare), ["sample_id", "col_idx"])
    return named.select("sample_id", "barcode", *LOCUS, "ad", "dp")


def split_cb_umi(
    reads: DataFrame, seq: str = "seq", cb_start: int = 1, cb_len: int = 16, umi_start: int = 17, umi_len: int = 10
) -> DataFrame:
    """Cell barcode and UMI parts of a barcode read."""
    return reads.withColumn("cb", F.substring(seq, cb_start, cb_len)).withColumn(
        "umi", F.substring(seq, umi_start, umi_len)
    )


def whitelisted(reads: DataFrame, whitelist: DataFrame, barcode: str = "cb") -> DataFrame:
    """Reads whose barcode is on the list, by exact match."""
    return reads.join(whitelist.select(F.col(whitelist.columns[0]).alias(barcode)).distinct(), barcode, "left_semi")


def merge_barcode_reads(r2: DataFrame, r3: DataFrame) -> DataFrame:
    """R2 and R3 records of the same index as one read; header of R2.

    A missing partner or an empty field stops the query.
    """
    at = ["sample_id", "record_idx"]
    fields = ["header", "seq", "plus", "qual"]
    a = r2.select(*at, *[F.col(f).alias(f"{f}2") for f in fields])
    b = r3.select(*at, *[F.col(f).alias(f"{f}3") for f in fields])
    both = a.join(b, at, "full_outer")
    unpaired = F.col("header2").isNull() | F.col("header3").isNull()
    empty = F.lit(False)
    for f in ("seq", "plus", "qual"):
        for side in "23":
            empty = empty | (F.coalesce(F.trim(f"{f}{side}"), F.lit("")) == "")
    seq = (
        F.when(unpaired, F.raise_error(F.lit("R2 and R3 differ in length")).cast("string"))
        .when(empty, F.raise_error(F.lit("malformed R2 or R3 record")).cast("string"))
        .otherwise(F.concat(F.trim("seq2"), F.trim("seq3")))
    )
    return both.select(
        *at,
        F.col("header2").alias("header"),
        seq.alias("seq"),
        F.col("plus2").alias("plus"),
        F.concat(F.trim("qual2"), F.trim("qual3")).alias("qual"),
    )


def first_file_cells(lines: DataFrame) -> DataFrame:
    """Detected cells per sample: lines of its first barcode file ``(sample_id, file_path)``."""
    counted = lines.groupBy("sample_id", "file_path").agg(F.count(F.lit(1)).alias("starsolo_detected_cells"))
    packed = F.when(F.endswith("file_path", F.lit(".gz")), 1).otherwise(0).alias("_packed")
    first = counted.groupBy("sample_id").agg(
        F.min(F.struct(packed, "file_path", "starsolo_detected_cells")).alias("_f")
    )
    return first.select("sample_id", "_f.starsolo_detected_cells")
