"""Sinks: TSV, gzip TSV, CSV, VCF text, matrices and the report manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: column line of an eight-column VCF.
VCF_COLUMN_LINE = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"


def write_tsv(df: DataFrame, path: str, mode: str = "error") -> None:
    """TSV with a header; packed when the path ends in ``.gz``."""
    packed = "gzip" if path.endswith(".gz") else "none"
    writer = df.write.mode(mode).option("sep", "\t").option("header", "true").option("emptyValue", "")
    writer.option("compression", packed).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", "true").option("emptyValue", "").csv(path)


def write_matrix(matrix: DataFrame, path: str, label: str = "metric", mode: str = "error") -> None:
    """Square matrix with its row labels in the first column."""
    others = [c for c in matrix.columns if c != label]
    write_tsv(matrix.select(label, *others), path, mode)


def vcf_lines(records: DataFrame, header: Sequence[str]) -> DataFrame:
    """Header and record lines in file order (chromosome text, position, first seen)."""
    spark = records.sparkSession
    top = [h.rstrip("\n") for h in header if not h.startswith("#CHROM")] + [VCF_COLUMN_LINE]
    head = spark.createDataFrame(
        [(0, "", i, "", 0, t) for i, t in enumerate(top)],
        "part int, chrom string, pos long, first_unit string, first_order long, value string",
    )
    fields = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info"]
    body = records.select(
        F.lit(1).alias("part"),
        "chrom",
        F.col("pos").cast("long").alias("pos"),
        F.col("first_unit").cast("string").alias("first_unit"),
        F.col("first_order").cast("long").alias("first_order"),
        F.concat_ws("\t", *[F.coalesce(F.col(f).cast("string"), F.lit(".")) for f in fields]).alias("value"),
    )
    return head.unionByName(body).orderBy("part", "chrom", "pos", "first_unit", "first_order").select("value")


def write_vcf(records: DataFrame, header: Sequence[str], path: str, mode: str = "error") -> None:
    """Range-partitioned text; part files in name order form one sorted VCF."""
    packed = "gzip" if path.endswith(".gz") else "none"
    vcf_lines(records, header).write.mode(mode).option("compression", packed).text(path)


def fastq_lines(reads: DataFrame) -> DataFrame:
    """Four-line records of merged reads, in record order."""
    record = F.concat_ws("\n", "header", "seq", "plus", "qual")
    return reads.orderBy("sample_id", "record_idx").select(record.alias("value"))


def write_fastq(reads: DataFrame, path: str, mode: str = "error") -> None:
    fastq_lines(reads).write.mode(mode).option("compression", "gzip").text(path)


def write_manifest(manifest: DataFrame, path: str, mode: str = "error") -> None:
    write_tsv(manifest.orderBy("stage", "source"), path, mode)
