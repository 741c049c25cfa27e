"""Mutation burden and substitution spectra per sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.functions.text import first_alt, substitution_channel, variant_class

# The twelve one-base substitutions.
CHANNELS = ["A>C", "A>G", "A>T", "C>A", "C>G", "C>T", "G>A", "G>C", "G>T", "T>A", "T>C", "T>G"]


def _classified(variants: DataFrame) -> DataFrame:
    alt = first_alt(F.col("alt"))
    snv = variant_class(F.col("ref"), alt) == "snv"
    return variants.select(
        "sample_id", snv.alias("snv"), F.when(snv, substitution_channel(F.col("ref"), alt)).alias("channel")
    )


def mutation_burden(variants: DataFrame) -> DataFrame:
    """Variants, SNVs and the rest per sample; repeated rows count."""
    return (
        _classified(variants)
        .groupBy("sample_id")
        .agg(F.count(F.lit(1)).alias("variant_count"), F.count_if("snv").alias("snv_count"))
        .withColumn("indel_count", F.col("variant_count") - F.col("snv_count"))
    )


def spectrum_long(variants: DataFrame) -> DataFrame:
    return (
        _classified(variants).filter("snv").groupBy("sample_id", "channel").agg(F.count(F.lit(1)).alias("n"))
    )


def spectrum_wide(variants: DataFrame) -> DataFrame:
    """One column per substitution, zero where a sample has none."""
    cells = [F.count_if(F.col("channel") == c).alias(c) for c in CHANNELS]
    return _classified(variants).groupBy("sample_id").agg(*cells)


def spectrum_totals(variants: DataFrame) -> DataFrame:
    """Substitutions and number of distinct channels per sample."""
    per_channel = _classified(variants).groupBy("sample_id", "channel").agg(F.count(F.lit(1)).alias("n"))
    return per_channel.groupBy("sample_id").agg(
        F.coalesce(F.sum(F.when(F.col("channel").isNotNull(), F.col("n"))), F.lit(0)).alias("signature_total"),
        F.count("channel").alias("signature_channels_nonzero"),
    )


def records_per_file(records: DataFrame, file: str = "file_path") -> DataFrame:
    return records.groupBy(file).agg(F.count(F.lit(1)).alias("records"))
