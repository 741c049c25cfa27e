"""Input checks. A check is a DataFrame of violations; ``require_empty`` turns rows into an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class InputError(ValueError):
    """Inputs that the reference pipeline would reject."""


def require_columns(df: DataFrame, required: Sequence[str], table: str) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise InputError(f"{table} misses columns: {', '.join(missing)}")
    return df


def require_empty(violations: DataFrame, message: str, shown: int = 20) -> None:
    """Raise with the number of violations and the first ``shown``; the whole table stays the caller's."""
    rows = violations.limit(shown + 1).collect()
    if rows:
        listed = ", ".join("/".join(str(v) for v in r) for r in rows[:shown])
        more = f" and others, {violations.count()} in all" if len(rows) > shown else ""
        raise InputError(f"{message}: {listed}{more}")


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise InputError(message)
    return df


def samples_without_files(metadata: DataFrame, reads: DataFrame) -> DataFrame:
    """Non-blank sample ids of the metadata that have no read file."""
    ids = metadata.select(F.trim("sample_id").alias("sample_id")).filter("sample_id != ''")
    return ids.join(reads, "sample_id", "left_anti")


def misaligned_samples(metadata: DataFrame, matrix_samples: DataFrame, strict: bool = True) -> DataFrame:
    """Metadata samples absent from the matrix; with ``strict`` also the other way round."""
    ids = metadata.select("sample_id").distinct()
    columns = matrix_samples.select("sample_id").distinct()
    absent = ids.join(columns, "sample_id", "left_anti").withColumn("problem", F.lit("not in matrix"))
    if not strict:
        return absent
    extra = columns.join(ids, "sample_id", "left_anti").withColumn("problem", F.lit("not in metadata"))
    return absent.unionByName(extra)


def mixed_label_groups(samples: DataFrame, group: str, label: str) -> DataFrame:
    """Groups with more than one label; two extremes decide it, so nothing is collected."""
    return (
        samples.groupBy(group)
        .agg(F.min(label).alias("first_label"), F.max(label).alias("last_label"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("first_label") != F.col("last_label"))
    )


def class_sizes(samples: DataFrame, label: str) -> DataFrame:
    return samples.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def classes_below(samples: DataFrame, label: str, folds: int) -> DataFrame:
    """Classes too small to put one member in every fold."""
    return class_sizes(samples, label).filter(F.col("n") < folds)


def counted(df: DataFrame, name: str, **extra) -> tuple[DataFrame, Observation]:
    """Attach a row counter (and further aggregates) that fills in while ``df`` is written."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in extra.items()]), seen


def require_counts(seen: Observation, message: str) -> dict:
    """Counters of a finished write; an empty result aborts the step."""
    values = dict(seen.get)
    if not values.get("rows"):
        raise InputError(message)
    return values
