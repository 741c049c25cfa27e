"""Prefix sums, ranks, medians and hashed order over groups of any size.

A window over a whole group runs in one task. Here the order column is first cut into
ranges; windows run inside a (group, range), one row per (group, range) carries the
totals across ranges, and both parts are added. The cuts are a sample of the distinct
values over all groups (one per hash class), so each range holds about the same number
of distinct values, whichever groups they belong to, and a value repeated many times is
one cut at most. The number of ranges follows the session's shuffle partitions.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusloom.session import cut_lineage

STEP = 64


def _range_count(spark: SparkSession) -> int:
    """Four ranges per shuffle partition, in whole steps."""
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return STEP * max(1, -(-wanted // STEP))


def with_range(df: DataFrame, order: str) -> DataFrame:
    """Add ``_range``: the number of sampled cuts below the row's order value.

    With more than one step of cuts, every 64th is looked at first, then the 64 after it.
    """
    ranges = _range_count(df.sparkSession)
    value = F.col(order)
    picked = df.groupBy(F.pmod(F.xxhash64(value), F.lit(ranges)).alias("_class")).agg(
        F.min_by(value, F.xxhash64(value, F.lit(7))).alias("_cut")
    )
    # One row with at most ``ranges`` values, and every 64th of them.
    cuts = picked.agg(F.array_sort(F.collect_list("_cut")).alias("fine"))
    coarse = F.filter("fine", lambda c, i: i % STEP == STEP - 1).alias("coarse")
    placed = df.withColumn("_cuts", cuts.select(F.struct("fine", coarse)).scalar())

    def below(array):
        return F.size(F.filter(array, lambda c: c < value))

    if ranges <= STEP:
        return placed.withColumn("_range", below("_cuts.fine")).drop("_cuts")
    block = below("_cuts.coarse")
    fine = F.slice("_cuts.fine", F.col("_block") * STEP + 1, F.lit(STEP))
    placed = placed.withColumn("_block", block).withColumn("_range", F.col("_block") * STEP + below(fine))
    return placed.drop("_cuts", "_block")


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Mapping[str, Column] | None = None,
    maxes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """For every row, ``<name>_before`` over the rows of its group with a smaller order.

    ``sums`` also give ``<name>_all``, the group total. The order column is expected
    to be unique inside a group; rows without an order are dropped.
    """
    sums, maxes = dict(sums or {}), dict(maxes or {})
    keys = list(keys)
    placed = with_range(df.filter(F.col(order).isNotNull()), order)
    totals = placed.groupBy(*keys, "_range").agg(
        *[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()],
        *[F.max(c).alias(f"_m_{n}") for n, c in maxes.items()],
    )
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_s_{n}").over(group).alias(f"{n}_all") for n in sums],
        *[F.max(f"_m_{n}").over(earlier).alias(f"_o_{n}") for n in maxes],
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select(
        "*",
        *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_l_{n}") for n, c in sums.items()],
        *[F.max(c).over(inside).alias(f"_l_{n}") for n, c in maxes.items()],
    )
    joined = local.join(offsets, [*keys, "_range"])
    return joined.select(
        *df.columns,
        "_range",
        *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(f"{n}_before") for n in sums],
        *[F.col(f"{n}_all") for n in sums],
        *[F.greatest(F.col(f"_l_{n}"), F.col(f"_o_{n}")).alias(f"{n}_before") for n in maxes],
    )


def value_totals(df: DataFrame, keys: Sequence[str], value: str, sums: Mapping[str, Column]) -> DataFrame:
    """One row per distinct value of a group with its sums, ``_before`` and ``_all`` totals.

    Equal values are combined before anything is ordered, so ties cost one row. The distinct
    values are written once: their cuts, totals and windows are three readings.
    """
    distinct = cut_lineage(
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(*[c.alias(n) for n, c in sums.items()])
    )
    return ordered_scan(distinct, keys, value, {n: F.col(n) for n in sums})


def average_rank(df: DataFrame, keys: Sequence[str], value: str, name: str = "rank") -> DataFrame:
    """Rank of each row inside its group; ties share the mean of their ranks."""
    totals = value_totals(df, keys, value, {"_n": F.count(F.lit(1))})
    ranks = totals.select(*keys, value, (F.col("_n_before") + (F.col("_n") + 1) / 2).alias(name))
    return df.join(ranks, [*keys, value])


def group_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Exact median per group with count, minimum and maximum, from counts of distinct values."""
    totals = value_totals(df, keys, value, {"_n": F.count(F.lit(1))})
    upto, n = F.col("_n_before") + F.col("_n"), F.col("_n_all")
    low = F.min(F.when(upto >= F.floor((n + 1) / 2), F.col(value)))
    high = F.min(F.when(upto >= F.floor(n / 2) + 1, F.col(value)))
    return totals.groupBy(*keys).agg(
        F.sum("_n").alias("n"),
        F.min(value).alias("min"),
        ((low + high) / 2).alias(name),
        F.max(value).alias("max"),
    )


def bh_adjust(df: DataFrame, p: str, keys: Sequence[str] = (), name: str = "fdr_bh") -> DataFrame:
    """Benjamini-Hochberg adjusted p-values over all rows (or per key); NULL stays NULL.

    The adjusted value depends only on the distinct p and how many rows lie at or
    below it, so rows are joined back at the end.
    """
    keys = list(keys)
    totals = value_totals(df, keys, p, {"_n": F.count(F.lit(1))})
    raw = cut_lineage(totals).withColumn("_raw", F.col(p) * F.col("_n_all") / (F.col("_n_before") + F.col("_n")))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    later = group.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    tails = raw.groupBy(*keys, "_range").agg(F.min("_raw").alias("_low"))
    tails = tails.select(*keys, "_range", F.min("_low").over(later).alias("_later"))
    inside = (
        Window.partitionBy(*keys, "_range").orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    adjusted = (
        raw.withColumn("_here", F.min("_raw").over(inside))
        .join(tails, [*keys, "_range"])
        .select(*keys, p, F.least(F.lit(1.0), F.col("_here"), F.col("_later")).alias(name))
    )
    return df.join(adjusted, [*keys, p], "left").select(*df.columns, name)


def digest_rank(df: DataFrame, keys: Sequence[str], digest: str, name: str = "rank") -> DataFrame:
    """Number rows 1.. per group in the order of a hex digest.

    Digests are uniform, so their first characters cut a group into even parts, at least
    four per shuffle partition.
    """
    width = max(2, math.ceil(math.log(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 16)))
    placed = df.withColumn("_slot", F.substring(digest, 1, width))
    counts = placed.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_slot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_o"))
    inside = Window.partitionBy(*keys, "_slot").orderBy(digest)
    return (
        placed.withColumn("_r", F.row_number().over(inside))
        .join(offsets, [*keys, "_slot"])
        .select(*df.columns, (F.col("_r") + F.col("_o")).cast("long").alias(name))
    )
