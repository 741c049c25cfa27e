"""Fold tables, group overlap, group labelings and label permutations."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.operators.checks import InputError
from locusloom.operators.ordered import digest_rank, ordered_scan
from locusloom.session import cut_lineage


def _digest(*parts) -> F.Column:
    return F.md5(F.concat_ws("|", *parts))


def stratified_folds(
    samples: DataFrame, id_col: str, label: str, folds: int = 5, repeats: int = 30, seed: int = 42
) -> DataFrame:
    """Fold of every sample in every repeat; classes are spread evenly over the folds.

    Samples of a class are ordered by a seeded digest, so the table is the same on every run.
    """
    repeated = samples.select(id_col, label).withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    repeated = repeated.withColumn(
        "_digest", _digest(F.lit(str(seed)), F.col("repeat").cast("string"), F.col(id_col).cast("string"))
    )
    ranked = digest_rank(repeated, ["repeat", label], "_digest", "_rank")
    return ranked.select("repeat", ((F.col("_rank") - 1) % folds).cast("int").alias("fold"), id_col, label)


def logo_folds(samples: DataFrame, group: str) -> DataFrame:
    """One fold per group, numbered from 1 in group order, with its train and test sizes."""
    sizes = samples.groupBy(group).agg(F.count(F.lit(1)).alias("n_test"))
    numbered = ordered_scan(sizes, [], group, {"_k": F.lit(1), "_rows": F.col("n_test")})
    return numbered.select(
        (F.col("_k_before") + 1).cast("int").alias("fold"),
        F.col(group).alias("heldout_group"),
        (F.col("_rows_all") - F.col("n_test")).alias("n_train"),
        "n_test",
    )


def fold_group_overlap(folds: DataFrame, group: str) -> DataFrame:
    """Test rows per fold and how many of them have their group in the training part too.

    A group is seen in training exactly when its rows of a repeat span several folds.
    """
    spans = folds.groupBy("repeat", group).agg(F.min("fold").alias("_lo"), F.max("fold").alias("_hi"))
    counts = folds.groupBy("repeat", "fold", group).agg(F.count(F.lit(1)).alias("_n"))
    seen = F.when(F.col("_lo") != F.col("_hi"), F.col("_n")).otherwise(0)
    return (
        counts.join(spans, ["repeat", group])
        .groupBy("repeat", "fold")
        .agg(F.sum("_n").alias("n_test"), F.sum(seen).alias("test_observations_with_group_seen_in_train"))
        .withColumn("test_group_overlap_rate", F.col("test_observations_with_group_seen_in_train") / F.col("n_test"))
    )


def fold_summary(metrics: DataFrame, columns: list[str], sample_sd: bool = True) -> DataFrame:
    """Means and deviations over the folds, with mean and median overlap where present."""
    deviation = F.stddev_samp if sample_sd else F.stddev_pop
    parts = [F.count(F.lit(1)).alias("n_folds")]
    for c in columns:
        parts += [F.avg(c).alias(f"{c}_mean"), deviation(c).alias(f"{c}_sd")]
    if "test_group_overlap_rate" in metrics.columns:
        parts += [
            F.avg("test_group_overlap_rate").alias("test_group_overlap_rate_mean"),
            F.median("test_group_overlap_rate").alias("test_group_overlap_rate_median"),
        ]
    return metrics.agg(*parts)


def binary_label(samples: DataFrame, label: str, positive: str, name: str = "y") -> DataFrame:
    return samples.withColumn(name, (F.col(label) == F.lit(positive)).cast("int"))


def negative_label(samples: DataFrame, label: str, positive: str) -> str:
    """The other label; ``negative`` when there is none, an error when there are several."""
    others = samples.filter(F.col(label) != positive).agg(F.min(label), F.max(label)).first()
    if others[0] != others[1]:
        raise InputError(f"more than two labels in {label}: {others[0]}, {others[1]}")
    return others[0] if others[0] is not None else "negative"


def group_labelings(
    samples: DataFrame,
    group: str,
    y: str,
    max_exact: int = 10_000,
    n_random: int = 1_000,
    seed: int = 42,
) -> tuple[DataFrame, bool]:
    """Sets of groups that are called positive, the class balance kept.

    All combinations when there are at most ``max_exact``; else ``n_random`` distinct
    draws with the observed set among them. Returns the table and whether it is complete.
    """
    spark = samples.sparkSession
    per_group = samples.groupBy(group).agg(F.max(y).alias("_y"))
    size = per_group.agg(F.count(F.lit(1)).alias("g"), F.sum("_y").alias("k")).first()
    g, k = int(size["g"]), int(size["k"])
    total = math.comb(g, k)
    observed = per_group.filter("_y = 1").agg(F.array_sort(F.collect_list(group)).alias("positive_groups"))
    if total <= max_exact:
        # At most max_exact sets, so the list of groups is short as well.
        names = [r[0] for r in per_group.select(group).orderBy(group).collect()]
        sets = [(i, list(c)) for i, c in enumerate(combinations(names, k), start=1)]
        table = spark.createDataFrame(sets, "permutation_id long, positive_groups array<string>")
    else:
        wanted = min(n_random, total)
        # Fewer sets are wanted than there are, so drawing on ends; a round adds only new draws.
        drawn, first, draws = observed, 1, wanted
        while True:
            more = _random_labelings(per_group, group, k, first, draws, seed)
            drawn = cut_lineage(drawn.unionByName(more).distinct())
            if drawn.count() >= wanted:
                break
            first, draws = draws + 1, 2 * draws
        later = F.when(F.col("positive_groups") == observed.scalar(), 0).otherwise(1)
        chosen = drawn.orderBy(later, F.md5(F.array_join("positive_groups", ";"))).limit(wanted)
        text = chosen.withColumn("_text", F.array_join("positive_groups", ";"))
        numbered = ordered_scan(text, [], "_text", {"_k": F.lit(1)})
        table = numbered.select((F.col("_k_before") + 1).cast("long").alias("permutation_id"), "positive_groups")
    marked = table.withColumn("is_observed_labeling", F.col("positive_groups") == observed.scalar())
    return marked, total <= max_exact


def _random_labelings(per_group: DataFrame, group: str, k: int, first: int, last: int, seed: int) -> DataFrame:
    many = per_group.select(group).withColumn("_draw", F.explode(F.sequence(F.lit(first), F.lit(last))))
    many = many.withColumn("_digest", _digest(F.lit(str(seed)), F.col("_draw").cast("string"), F.col(group)))
    ranked = digest_rank(many, ["_draw"], "_digest", "_rank")
    return (
        ranked.filter(F.col("_rank") <= k)
        .groupBy("_draw")
        .agg(F.array_sort(F.collect_list(group)).alias("positive_groups"))
        .drop("_draw")
    )


def relabel_samples(samples: DataFrame, labelings: DataFrame, sample: str, group: str) -> DataFrame:
    """Positive samples of every labeling, by joining on the group; all others are negative."""
    positive = labelings.select("permutation_id", F.explode("positive_groups").alias(group))
    return samples.select(sample, group).join(positive, group).select("permutation_id", sample, group)


def permuted_labels(samples: DataFrame, sample: str, y: str, permutations: int = 100, seed: int = 42) -> DataFrame:
    """Seeded shuffles of a binary label: in each, as many positives as observed, at random."""
    positives = samples.select(F.sum(y)).scalar()
    many = samples.select(sample).withColumn(
        "permutation_id", F.explode(F.sequence(F.lit(1), F.lit(permutations)))
    )
    many = many.withColumn(
        "_digest", _digest(F.lit(f"perm{seed}"), F.col("permutation_id").cast("string"), F.col(sample).cast("string"))
    )
    ranked = digest_rank(many, ["permutation_id"], "_digest", "_rank")
    return ranked.select("permutation_id", sample, (F.col("_rank") <= positives).cast("int").alias(y))
