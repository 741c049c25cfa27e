"""Text lines with their file, and with stable line numbers where a format needs them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusloom.session import cut_lineage


def read_lines(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False, glob: str | None = None) -> DataFrame:
    """``(value, file_path, line_order)`` of plain or gzip text files.

    ``line_order`` grows along a file: a file's splits are read in offset order and
    lines of a split in turn. It has gaps; use ``number_lines`` for exact numbers.
    """
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(list(paths) if not isinstance(paths, str) else paths).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("line_order"),
    )


def number_lines(lines: DataFrame, name: str = "line_no") -> DataFrame:
    """Add the number of each line in its file, from 0.

    Each split contributes one row (its first order and its line count); the numbers of
    a split start at the lines of the splits before it. The lines themselves are neither
    sorted nor, while that table is small enough to be broadcast, moved: it is written
    first (one counting pass), so that Spark plans the join from its size.
    A split without its counts would mean that the files changed meanwhile, and stops the query.
    """
    splits = lines.groupBy("file_path", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("line_order").alias("_first")
    )
    earlier = Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut_lineage(splits.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"))
    placed = lines.join(starts, ["file_path", "_block"], "left")
    number = F.col("line_order") - F.col("_first") + F.col("_before")
    checked = F.when(F.col("_first").isNotNull(), number).otherwise(
        F.raise_error(F.lit("files changed while lines were numbered")).cast("long")
    )
    return placed.withColumn(name, checked).drop("_first", "_before")


def without_order(lines: DataFrame) -> DataFrame:
    return lines.drop("_block", "line_order")


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """``(path, size_bytes)`` of all files below a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select("path", F.col("length").alias("size_bytes"))
