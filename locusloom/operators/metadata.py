"""Sample sheet against read files: discovery, presence flags, overview, path choice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.functions.text import file_name
from locusloom.operators.checks import require_empty, samples_without_files

# Fixed value: name pattern of read files.
READ_FILE = r"(?i)^(.+?)_(R[123])(_\d+)?\.f(ast)?q(\.gz)?$"
# Read-file endings from best to worst.
READ_ENDINGS = [".fastq.gz", ".fq.gz", ".fastq", ".fq"]


def read_files(listing: DataFrame, path: str = "path") -> DataFrame:
    """``(path, sample_id, read)`` of the files whose name is a read file's."""
    name = file_name(F.col(path))
    return listing.select(
        F.col(path).alias("path"),
        F.regexp_extract(name, READ_FILE, 1).alias("sample_id"),
        F.upper(F.regexp_extract(name, READ_FILE, 2)).alias("read"),
    ).filter("sample_id != ''")


def reads_per_sample(files: DataFrame) -> DataFrame:
    """Set of reads per sample; at most three names per set."""
    return files.groupBy("sample_id").agg(F.array_sort(F.collect_set("read")).alias("reads"))


def clean_metadata(metadata: DataFrame, reads: DataFrame) -> DataFrame:
    """Sample sheet without blank ids; a sample without read files fails the whole run."""
    require_empty(samples_without_files(metadata, reads), "samples in metadata without FASTQ")
    return metadata.filter(F.trim("sample_id") != "")


def read_flags(metadata: DataFrame, reads: DataFrame) -> DataFrame:
    """Sample sheet ids with ``has_R1`` to ``has_R3``."""
    ids = metadata.select(F.trim("sample_id").alias("sample_id")).filter("sample_id != ''")
    joined = ids.join(reads, "sample_id", "left")
    flags = [F.coalesce(F.array_contains("reads", r), F.lit(False)).alias(f"has_{r}") for r in ("R1", "R2", "R3")]
    return joined.select("sample_id", *flags)


def input_overview(flags: DataFrame) -> DataFrame:
    """``metric, value`` rows: samples, and samples with a third read."""
    totals = flags.agg(
        F.count(F.lit(1)).alias("n_samples"), F.count_if("has_R3").alias("n_samples_with_R3")
    )
    return totals.unpivot([], ["n_samples", "n_samples_with_R3"], "metric", "value")


def read_path(files: DataFrame) -> DataFrame:
    """One path per sample and read: the best ending, then the first path."""
    rank = F.coalesce(*[F.when(F.endswith("path", F.lit(e)), F.lit(i)) for i, e in enumerate(READ_ENDINGS)])
    ranked = files.withColumn("_rank", rank).filter("_rank is not null")
    best = ranked.groupBy("sample_id", "read").agg(F.min(F.struct("_rank", "path")).alias("_b"))
    return best.select("sample_id", "read", "_b.path")
