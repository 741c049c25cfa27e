"""VCF, GTF, FASTA index and gene-set readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.functions.text import (
    INTEGRATION_SUFFIXES,
    allele_fraction,
    file_name,
    info_value,
    normalize_sample_id,
)
from locusloom.operators.checks import require_rows
from locusloom.operators.intervals import gene_intervals
from locusloom.session import cut_lineage
from locusloom.sources.blockgzip import read_block_lines
from locusloom.sources.lines import number_lines, read_lines

# The columns of a VCF record and of a GTF row, in file order.
VCF_COLUMNS = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format", "sample"]
GTF_COLUMNS = ["chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attributes"]


def vcf_records(lines: DataFrame, min_columns: int = 5, suffixes: Sequence[str] = INTEGRATION_SUFFIXES) -> DataFrame:
    """Records of VCF lines ``(value, file_path)``; headers and short rows are dropped.

    Columns beyond the row's end are NULL. The sample id comes from the file name.
    """
    # The text before the last needed tab is shorter than the row exactly when that tab exists.
    long_enough = F.length(F.substring_index("value", "\t", min_columns - 1)) < F.length("value")
    body = lines.filter(~F.startswith("value", F.lit("#")) & long_enough).withColumn("_p", F.split("value", "\t"))
    fields = [F.get("_p", F.lit(i)).alias(c) for i, c in enumerate(VCF_COLUMNS)]
    fields[1] = F.get("_p", F.lit(1)).cast("long").alias("pos")
    kept = [c for c in lines.columns if c not in ("value", "_block")]
    return body.select(
        normalize_sample_id(file_name(F.col("file_path")), suffixes).alias("sample_id"), *fields, *kept
    )


def read_vcf(
    spark: SparkSession,
    paths: str | Sequence[str],
    min_columns: int = 5,
    suffixes: Sequence[str] = INTEGRATION_SUFFIXES,
    missing_af: float = 1.0,
    block_gzip: bool = False,
) -> DataFrame:
    """VCF records with the allele fraction of the sample column.

    With ``block_gzip`` the paths are ``.gz`` files or folders of them, and several tasks share a
    large block-gzip file; without, a packed file is one task's.
    """
    lines = read_block_lines(spark, paths) if block_gzip else read_lines(spark, paths)
    records = vcf_records(lines, min_columns, suffixes)
    return records.withColumn("af", allele_fraction(F.col("format"), F.col("sample"), missing_af))


def vcf_header_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_order, value)`` of the lines of one file that start with ``#``."""
    return read_lines(spark, path).filter(F.startswith("value", F.lit("#"))).select("line_order", "value")


def vcf_header(spark: SparkSession, first_path: str) -> list[str]:
    """Header lines of one file as a list, for the writer; a header is small by the format."""
    return [r["value"] for r in vcf_header_lines(spark, first_path).orderBy("line_order").collect()]


def info_numbers(keys: Sequence[str], info: str = "info") -> Mapping[str, Column]:
    """Numeric INFO annotations by name, NULL where absent or unreadable."""
    return {k: info_value(F.col(info), k).try_cast("double") for k in keys}


def _attribute(key: str) -> Column:
    """Last value of a GTF attribute, quotes removed."""
    items = F.transform(F.split("attributes", ";"), lambda item: F.trim(item))
    hits = F.filter(items, lambda item: F.startswith(item, F.lit(key + " ")))
    value = F.trim(F.substring(F.get(hits, F.size(hits) - 1), len(key) + 2, 2**31 - 1))
    return F.regexp_replace(value, '^"+|"+$', "")


def gtf_features(lines: DataFrame) -> DataFrame:
    """GTF rows with ``gene_id`` and ``gene_name`` (the id where no name is given)."""
    body = lines.filter(~F.startswith("value", F.lit("#"))).withColumn("_p", F.split("value", "\t"))
    body = body.filter(F.size("_p") >= len(GTF_COLUMNS))
    rows = body.select(*[F.get("_p", F.lit(i)).alias(c) for i, c in enumerate(GTF_COLUMNS)], "line_order")
    named = rows.withColumn("gene_id", _attribute("gene_id")).withColumn("gene_name", _attribute("gene_name"))
    return named.filter(F.coalesce("gene_id", F.lit("")) != "").select(
        "chrom",
        "source",
        "feature",
        F.col("start").cast("long").alias("start"),
        F.col("end").cast("long").alias("end"),
        "strand",
        "gene_id",
        F.coalesce("gene_name", "gene_id").alias("gene_name"),
        "line_order",
    )


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    return gtf_features(read_lines(spark, path))


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """Gene intervals of a GTF, written once: far smaller than the file, so joins see their real size."""
    return cut_lineage(require_rows(gene_intervals(read_gtf(spark, path)), f"no gene intervals in {path}"))


def read_gene_sets(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(term, description, gene)`` of GMT files."""
    parts = F.split("value", "\t")
    rows = read_lines(spark, paths).select(parts.alias("_p")).filter(F.size("_p") >= 3)
    genes = F.slice("_p", F.lit(3), F.size("_p"))
    return rows.select(
        F.get("_p", F.lit(0)).alias("term"), F.get("_p", F.lit(1)).alias("description"), F.explode(genes).alias("gene")
    ).filter(F.trim("gene") != "")


def read_gene_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed names, one per line."""
    return read_lines(spark, path).select(F.trim("value").alias("gene_name")).filter("gene_name != ''").distinct()


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """Contigs and lengths of a FASTA index, with their line numbers."""
    lines = number_lines(read_lines(spark, path)).withColumn("_p", F.split("value", "\t")).filter(F.size("_p") >= 2)
    return lines.select(
        F.get("_p", F.lit(0)).alias("contig"), F.get("_p", F.lit(1)).cast("long").alias("length"), "line_no"
    )
