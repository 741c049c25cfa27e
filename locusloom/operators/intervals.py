"""Position-in-interval join and gene annotation of variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusloom.session import cut_lineage

LOCUS = ["chrom", "pos", "ref", "alt"]


def median_length(intervals: DataFrame, start: str = "start", end: str = "end") -> int:
    """Typical interval length, used as the bin width (one small job on the interval table)."""
    length = F.percentile_approx(F.col(end) - F.col(start) + 1, 0.5)
    return max(1, int(intervals.agg(length).first()[0] or 1))


def bin_widths(width: int) -> list[int]:
    """Widths of the levels of bins, each eight times the one below, up to more than any length."""
    widths = [width]
    while widths[-1] < 1 << 60:
        widths.append(8 * widths[-1])
    return widths


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    group: str = "chrom",
    pos: str = "pos",
    start: str = "start",
    end: str = "end",
    bin_size: int | None = None,
    salts: int = 1,
) -> DataFrame:
    """Rows of ``points`` whose position lies in ``[start, end]`` of an interval of the same group.

    Bins come in levels, each eight times as wide as the one below; ``bin_size`` is the lowest
    width. An interval is listed on the lowest level whose bins are as long as itself, so in two
    bins at most, however long it is. A point asks its one bin on every level that there is, so
    the join is an equality on (group, level, bin) with the range as a residual, and a pair can
    match only once. Intervals without a start or end, or with the end before the start, hold
    nothing. Spark broadcasts the intervals when their size allows. Where it cannot and positions
    repeat heavily, ``salts`` spreads each bin over several tasks.
    """
    widths = bin_widths(bin_size or median_length(intervals, start, end))
    table = F.array(*map(F.lit, widths))
    length = F.col(end) - F.col(start) + 1
    right = intervals.filter(F.col(start) <= F.col(end)).withColumn("_level", F.size(F.filter(table, lambda w: w < length)))
    levels = sorted(r["_level"] for r in right.select("_level").distinct().collect()) or [0]  # at most one per width
    width = F.get(table, F.col("_level"))
    bins = F.sequence(F.floor(F.col(start) / width).cast("long"), F.floor(F.col(end) / width).cast("long"))
    right = right.withColumn("_bin", F.explode(bins))
    asked = F.array(*(F.struct(F.lit(n).alias("_level"), F.floor(F.col(pos) / F.lit(widths[n])).cast("long").alias("_bin")) for n in levels))
    left = points.select("*", F.inline(asked))
    keys = [group, "_level", "_bin"]
    if salts > 1:
        spread = F.xxhash64(*[F.col(c) for c in points.columns])
        left = left.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys.append("_salt")
    return left.join(right, keys).filter(F.col(pos).between(F.col(start), F.col(end))).drop("_level", "_bin", "_salt")


def merge_spans(genes: DataFrame) -> DataFrame:
    """Join overlapping intervals of one gene, so that a position meets a gene at most once."""
    gene = ["chrom", "gene_id", "gene_name", "strand"]
    ordered = Window.partitionBy(*gene).orderBy("start", "end")
    reach = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opened = genes.withColumn("_new", F.when(F.col("start") <= reach, 0).otherwise(1))
    numbered = opened.withColumn("_span", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*gene, "_span").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_span")


def annotate_variants(loci: DataFrame, genes: DataFrame, bin_size: int | None = None) -> DataFrame:
    """Long variant-to-gene table of distinct loci; loci outside every gene are dropped.

    Distinct loci bound the rows per bin by the bin's positions, so no bin can be hot,
    and merged spans make a second de-duplication unnecessary. The spans are written once, so
    that the join is planned from their size.
    """
    spans = cut_lineage(merge_spans(genes.select("chrom", "start", "end", "strand", "gene_id", "gene_name")))
    joined = interval_join(loci.select(*LOCUS), spans, bin_size=bin_size)
    return joined.select(
        "chrom", "pos", "ref", F.substring_index("alt", ",", 1).alias("alt"), "gene_id", "gene_name", "strand"
    )


def gene_intervals(features: DataFrame) -> DataFrame:
    """Gene intervals of a GTF feature table.

    Gene rows are used where the file has any. Only a file with none falls back to
    transcript bounds, with the strand of the first transcript. Ordered by chromosome,
    start and end.
    """
    usable = features.filter(F.col("gene_id") != "")
    has_genes = usable.select(F.coalesce(F.max(F.col("feature") == "gene"), F.lit(False))).scalar()
    rows = usable.filter(
        (F.col("feature") == "gene") | ((F.col("feature") == "transcript") & ~has_genes)
    )
    genes = rows.filter(F.col("feature") == "gene").select(
        "chrom", "start", "end", "strand", "gene_id", "gene_name"
    )
    bounds = (
        rows.filter(F.col("feature") == "transcript")
        .groupBy("chrom", "gene_id", "gene_name")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.min_by("strand", "line_order").alias("strand"),
        )
        .select("chrom", "start", "end", "strand", "gene_id", "gene_name")
    )
    return genes.unionByName(bounds).orderBy("chrom", "start", "end", "gene_id")
