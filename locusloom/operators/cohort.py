"""Cohort-common loci, hard filters and choice of one file per sample."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusloom.functions.text import BURDEN_SUFFIXES, INTEGRATION_SUFFIXES, cohort_info, file_name, normalize_sample_id

LOCUS = ["chrom", "pos", "ref", "alt"]

# Rule name, INFO annotation, comparison and limit of the default hard filters.
HARD_FILTERS = [
    ("LowQD", "QD", "<", 2.0),
    ("HighFS", "FS", ">", 30.0),
    ("LowMQ", "MQ", "<", 40.0),
    ("HighSOR", "SOR", ">", 3.0),
]

# File-name endings from best to worst.
SUMMARY_PATTERNS = [
    ".filtered.vcf",
    ".filtered.vcf.gz",
    ".filtered.annotated.vcf",
    ".filtered.annotated.vcf.gz",
    ".raw.vcf",
    ".raw.vcf.gz",
    ".vcf",
    ".vcf.gz",
]
BURDEN_PATTERNS = [".filtered.vcf.gz", ".filtered.vcf"]


def carriers(variants: DataFrame, unit: str = "sample_id", order: str | None = None) -> DataFrame:
    """One row per locus and sample (or file): the fraction of its first record.

    ``order`` is a number that grows along a file; without it the highest fraction counts.
    Repeats inside a map task are combined before the shuffle.
    """
    known = F.when(~F.isnan("af"), F.col("af"))
    af = F.min_by(known, order) if order else F.max(known)
    columns = [af.alias("af")]
    if order:
        columns.append(F.min(order).alias("first_order"))
    return variants.groupBy(*LOCUS, unit).agg(*columns)


def cohort_loci(
    variants: DataFrame,
    min_samples: int = 4,
    min_vaf: float = 0.05,
    unit: str = "sample_id",
    order: str | None = None,
    with_first: bool = False,
) -> DataFrame:
    """Loci seen in at least ``min_samples`` units with a highest fraction of ``min_vaf`` or more.

    The key uses the whole ALT text. The first shuffle is on (locus, unit), so a locus
    present everywhere is counted from one row per unit. ``with_first`` adds where the
    locus was seen first: the first unit and the order of its first record there.
    """
    columns = [F.count(F.lit(1)).alias("cohort_count"), F.greatest(F.lit(0.0), F.max("af")).alias("max_af")]
    if with_first:
        columns.append(F.min(F.struct(F.col(unit).alias("first_unit"), "first_order")).alias("_first"))
    loci = (
        carriers(variants, unit, order)
        .groupBy(*LOCUS)
        .agg(*columns)
        .filter((F.col("cohort_count") >= min_samples) & (F.col("max_af") >= min_vaf))
    )
    return loci.select(*LOCUS, "cohort_count", "max_af", "_first.*") if with_first else loci


def first_records(variants: DataFrame, loci: DataFrame, fields: Sequence[str], unit: str, order: str) -> DataFrame:
    """Add the fields of the first record of each locus (``loci`` made ``with_first``).

    Records are looked up by their place, so nothing but the loci is sorted or grouped.
    """
    placed = variants.select(*LOCUS, F.col(unit).alias("first_unit"), F.col(order).alias("first_order"), *fields)
    return loci.join(placed, [*LOCUS, "first_unit", "first_order"]).dropDuplicates(LOCUS)


def cohort_records(loci: DataFrame) -> DataFrame:
    """Eight-column records of the cohort file, with INFO extended and in output order."""
    return loci.select(
        "chrom",
        "pos",
        "id",
        "ref",
        "alt",
        "qual",
        "filter",
        cohort_info(F.col("info"), F.col("cohort_count"), F.col("max_af")).alias("info"),
        "first_unit",
        "first_order",
    ).orderBy("chrom", "pos", "first_unit", "first_order")


def failed_rules(
    values: Mapping[str, Column], rules: Sequence[tuple[str, str, str, float]] = HARD_FILTERS
) -> Column:
    """Names of the rules a record breaks. A missing annotation breaks no rule."""
    tests = {"<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}
    names = [F.when(tests[op](values[key], F.lit(limit)), F.lit(name)) for name, key, op, limit in rules]
    return F.array_compact(F.array(*names))


def hard_filter(
    variants: DataFrame,
    values: Mapping[str, Column],
    rules: Sequence[tuple[str, str, str, float]] = HARD_FILTERS,
) -> DataFrame:
    """Set ``filter`` to PASS or to the ``;``-joined names of the broken rules."""
    names = failed_rules(values, rules)
    return variants.withColumn("filter", F.when(F.size(names) == 0, "PASS").otherwise(F.array_join(names, ";")))


def passing(variants: DataFrame) -> DataFrame:
    return variants.filter(F.col("filter") == "PASS")


def pattern_rank(path: Column, patterns: Sequence[str]) -> Column:
    """Position of the first ending that fits, NULL when none does."""
    return F.coalesce(*[F.when(F.endswith(path, F.lit(p)), F.lit(i)) for i, p in enumerate(patterns)])


def best_file_per_sample(
    files: DataFrame,
    path: str = "path",
    patterns: Sequence[str] = SUMMARY_PATTERNS,
    suffixes: Sequence[str] = INTEGRATION_SUFFIXES,
) -> DataFrame:
    """One file per sample: the best ending, then the first path."""
    ranked = files.select(
        normalize_sample_id(file_name(F.col(path)), suffixes).alias("sample_id"),
        F.col(path).alias("path"),
        pattern_rank(F.col(path), patterns).alias("rank"),
    ).filter(F.col("rank").isNotNull())
    best = ranked.groupBy("sample_id").agg(F.min(F.struct("rank", "path")).alias("_b"))
    return best.select("sample_id", "_b.path", "_b.rank")


def best_burden_file(files: DataFrame, path: str = "path") -> DataFrame:
    """As ``best_file_per_sample`` with the two endings the burden step accepts."""
    return best_file_per_sample(files, path, BURDEN_PATTERNS, BURDEN_SUFFIXES)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack per-file or per-analysis results; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
