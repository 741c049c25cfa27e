"""Summaries of classifier validation and the report table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.functions.text import fixed_text, mean_sd_text
from locusloom.operators import folds as fold_tables
from locusloom.operators import resampling as rs
from locusloom.operators import scoring
from locusloom.operators.cohort import union_all

# Wording of the validation summary.
RUN_LEVEL = {
    "analysis": "Run-level repeated stratified CV",
    "grouping_used": "none",
    "evaluation_unit": "run/sample row",
    "interpretation": "Optimistic run-level separability comparator; paired group observations can appear in both train and test.",
}
POOLED = {
    "analysis": "Group-aware leave-one-group-out validation",
    "evaluation_unit": "run/sample rows pooled across held-out group folds",
    "design": "Leave one group out; all rows from held-out group are test only",
    "interpretation": "Leakage-controlled grouped validation at run level; held-out group rows are never in training.",
}
AGGREGATED = {
    "analysis": "Group-aware leave-one-group-out validation",
    "evaluation_unit": "independent group, rows aggregated by mean probability",
    "design": "Leave one group out; group prediction aggregates held-out rows",
    "interpretation": "Primary independence-aware validation; independent unit is the metadata group.",
}
PERMUTED = {
    "evaluation_unit": "independent group",
    "design": "Class-balanced group label permutations; observed labeling included",
    "interpretation": "Permutation is performed at metadata-group level, so paired rows keep the same permuted label.",
}
PERMUTATION_METRICS = ["group_balanced_accuracy", "group_roc_auc", "run_balanced_accuracy"]


def cv_fold_metrics(predictions: DataFrame, n_samples: int) -> DataFrame:
    """Sizes, overlap and classification metrics per fold of run-level CV.

    The listed ids of a fold grow with the cohort, whose ids the driver holds as well.
    """
    listed = predictions.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_test"),
        F.array_sort(F.collect_list(F.struct("sample_id", "group"))).alias("_s"),
        F.count_if("paired_group_seen_in_train").alias("test_observations_with_group_seen_in_train"),
        F.avg(F.col("paired_group_seen_in_train").cast("double")).alias("test_group_overlap_rate"),
    )
    shape = listed.select(
        "fold",
        (F.lit(n_samples) - F.col("n_test")).alias("n_train"),
        "n_test",
        F.array_join("_s.sample_id", ";").alias("test_samples"),
        F.array_join("_s.group", ";").alias("test_groups"),
        "test_observations_with_group_seen_in_train",
        "test_group_overlap_rate",
    )
    scored = scoring.classification_metrics(predictions, ["fold"], "true_label", "predicted_label", "decision_score")
    return shape.join(scored.drop("n"), "fold")


def _constants(df: DataFrame, values: dict[str, str]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def cv_summary(fold_metrics: DataFrame, n_folds: int, repeats: int, n_runs: int, n_groups: int) -> DataFrame:
    """One row: means and sample deviations over the folds, mean and median overlap."""
    row = fold_tables.fold_summary(fold_metrics, ["accuracy", "balanced_accuracy", "roc_auc"])
    row = row.withColumns({"n_runs": F.lit(n_runs).cast("long"), "n_groups": F.lit(n_groups).cast("long")})
    return _constants(row, {**RUN_LEVEL, "design": f"{n_folds}-fold x {repeats} repeats"})


def group_rollup(predictions: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    return scoring.group_predictions(
        predictions, [*extra_keys, "heldout_group"], "true_label", "prob_positive", "decision_score", "group_title"
    )


def group_report(predictions: DataFrame, labels: tuple[str, str]) -> DataFrame:
    """Group-wise predictions with the listed runs."""
    lists = scoring.group_run_lists(predictions, ["heldout_group"], "sample_id", "predicted_condition", "prob_positive")

    def name(column):
        return F.when(F.col(column) == 1, labels[1]).otherwise(labels[0])

    rolled = group_rollup(predictions).withColumns(
        {"true_condition": name("true_label"), "predicted_condition": name("predicted_label")}
    )
    return rolled.join(lists, "heldout_group")


def _single_summary(metrics: DataFrame, predictions: DataFrame, grouping: str, wording: dict[str, str]) -> DataFrame:
    sizes = predictions.agg(
        F.count(F.lit(1)).alias("n_runs"), F.count_distinct("heldout_group").alias("n_groups")
    )
    row = metrics.select(
        *[F.col(m).alias(f"{m}_mean") for m in ("accuracy", "balanced_accuracy", "roc_auc")],
        *[F.lit(None).cast("double").alias(f"{m}_sd") for m in ("accuracy", "balanced_accuracy", "roc_auc")],
        F.lit(0.0).alias("test_group_overlap_rate_mean"),
        F.lit(0.0).alias("test_group_overlap_rate_median"),
        sizes.select("n_runs").scalar().alias("n_runs"),
        sizes.select("n_groups").scalar().alias("n_groups"),
    )
    return _constants(row.withColumn("n_folds", F.col("n_groups")), {**wording, "grouping_used": grouping})


def grouped_summary(predictions: DataFrame, grouping: str) -> DataFrame:
    """Run-pooled and group-aggregated rows of leave-one-group-out validation."""
    pooled = scoring.classification_metrics(predictions, [], "true_label", "predicted_label", "decision_score")
    rolled = group_rollup(predictions)
    grouped = scoring.classification_metrics(rolled, [], "true_label", "predicted_label", "mean_decision_score")
    return union_all(
        [
            _single_summary(pooled, predictions, grouping, POOLED),
            _single_summary(grouped, predictions, grouping, AGGREGATED),
        ]
    )


def grouped_confusion(predictions: DataFrame, labels: tuple[str, str]) -> DataFrame:
    """Confusion matrices of both evaluation levels."""
    rolled = group_rollup(predictions)
    return union_all(
        [
            scoring.confusion_matrix(predictions, "true_label", "predicted_label", labels, "grouped_logo_run_pooled"),
            scoring.confusion_matrix(rolled, "true_label", "predicted_label", labels, "grouped_logo_group_aggregated"),
        ]
    )


def permutation_scores(predictions: DataFrame, labelings: DataFrame) -> DataFrame:
    """Run and group metrics of every labeling; ``labeling`` counts from 0 in labeling order."""
    run = scoring.classification_metrics(predictions, ["labeling"], "true_label", "predicted_label", "decision_score")
    rolled = group_rollup(predictions, ("labeling",))
    grouped = scoring.classification_metrics(rolled, ["labeling"], "true_label", "predicted_label", "mean_decision_score")
    names = ["accuracy", "balanced_accuracy", "roc_auc"]
    both = run.select("labeling", *[F.col(m).alias(f"run_{m}") for m in names]).join(
        grouped.select("labeling", *[F.col(m).alias(f"group_{m}") for m in names]), "labeling"
    )
    described = labelings.select(
        (F.col("permutation_id") - 1).alias("labeling"),
        "permutation_id",
        F.array_join("positive_groups", ";").alias("positive_groups"),
        "is_observed_labeling",
    )
    return described.join(both, "labeling").drop("labeling")


def permutation_summary(scores: DataFrame, exact: bool, n_positive: int, n_groups: int) -> DataFrame:
    """p-values of the observed labeling for the three reported metrics."""
    observed = scores.filter("is_observed_labeling")
    known = [(m, observed.select(m).scalar()) for m in PERMUTATION_METRICS]
    rows = scoring.permutation_pvalues(scores, known, PERMUTATION_METRICS, exact)
    wording = {
        "analysis": f"{'Exact' if exact else 'Random'} group-level permutation",
        "label_permutation_unit": "metadata group",
        "class_balance_preserved": f"{n_positive} positive groups / {n_groups - n_positive} negative groups",
    }
    return _constants(rows, wording)


def grouped_permutation(
    burden: DataFrame,
    samples: DataFrame,
    y: str,
    group: str,
    labels: tuple[str, str],
    sample: str = "sample_id",
    title: str | None = None,
    max_exact: int = 10_000,
    n_random: int = 1_000,
    seed: int = 42,
    max_fit_samples: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Scores of all labelings and the p-value table. All samples are fitted on, or at most ``max_fit_samples``; all are predicted."""
    table, exact = fold_tables.group_labelings(samples, group, y, max_exact, n_random, seed)
    # Bounded: at most max_exact or n_random labelings of the groups.
    sets = [r[0] for r in table.orderBy("permutation_id").select("positive_groups").collect()]
    predictions = rs.written(rs.logo_predictions(burden, samples, y, group, labels, sample, title, sets, max_fit_samples=max_fit_samples))
    scores = rs.written(permutation_scores(predictions, table))
    n_groups = samples.select(group).distinct().count()
    return scores, permutation_summary(scores, exact, len(sets[0]), n_groups)


def plain_cv_scores(predictions: DataFrame) -> DataFrame:
    """Mean ROC-AUC over the folds per labeling, with its population deviation."""
    auc = scoring.roc_auc(predictions, ["labeling", "fold"], "y", "decision_score")
    return auc.groupBy("labeling").agg(F.avg("roc_auc").alias("roc_auc_mean"), F.stddev_pop("roc_auc").alias("roc_auc_std"))


def plain_cv_metrics(scores: DataFrame) -> DataFrame:
    """``metric, value`` rows of the observed labeling, with the permutation p-value where there are shuffles."""
    observed = scores.filter("labeling = 0")
    first = observed.select("roc_auc_mean").scalar()
    shuffled = scores.filter("labeling > 0")
    n, ge = F.count(F.lit(1)), F.count_if(F.col("roc_auc_mean") >= first)
    p = shuffled.agg(F.when(n > 0, (ge + 1) / (n + 1)).alias("p")).scalar()
    wide = observed.select("roc_auc_mean", "roc_auc_std", p.alias("permutation_p"))
    return wide.unpivot([], ["roc_auc_mean", "roc_auc_std", "permutation_p"], "metric", "value")


def report_table(summaries: DataFrame, permutation: DataFrame, group: str) -> DataFrame:
    """The validation table as printed, one row per analysis."""

    def pair(metric):
        return mean_sd_text(F.col(f"{metric}_mean"), F.col(f"{metric}_sd"))

    rows = summaries.select(
        F.col("analysis").alias("Analysis"),
        F.col("grouping_used").alias("Grouping"),
        F.col("evaluation_unit").alias("Evaluation unit"),
        F.col("design").alias("Design"),
        F.col("n_runs").alias("n runs"),
        F.col("n_groups").alias("n groups"),
        pair("accuracy").alias("Accuracy"),
        pair("balanced_accuracy").alias("Balanced accuracy"),
        pair("roc_auc").alias("ROC-AUC"),
        fixed_text(F.col("test_group_overlap_rate_mean"), 3).alias("Group overlap in train/test"),
        F.col("interpretation").alias("Interpretation"),
    )

    def observed(metric):
        hit = F.col("metric") == metric
        value, p = F.max(F.when(hit, F.col("observed_value"))), F.max(F.when(hit, F.col("p_value")))
        return F.concat(F.lit("observed "), fixed_text(value, 3), F.lit("; p="), fixed_text(p, 3))

    totals = summaries.agg(F.max("n_runs").alias("n_runs"), F.max("n_groups").alias("n_groups"))
    extra = permutation.agg(
        F.max("analysis").alias("Analysis"),
        observed("group_balanced_accuracy").alias("Balanced accuracy"),
        observed("group_roc_auc").alias("ROC-AUC"),
    ).select(
        "Analysis",
        F.lit(group).alias("Grouping"),
        F.lit(PERMUTED["evaluation_unit"]).alias("Evaluation unit"),
        F.lit(PERMUTED["design"]).alias("Design"),
        totals.select("n_runs").scalar().alias("n runs"),
        totals.select("n_groups").scalar().alias("n groups"),
        F.lit("").alias("Accuracy"),
        "Balanced accuracy",
        "ROC-AUC",
        F.lit("0.000").alias("Group overlap in train/test"),
        F.lit(PERMUTED["interpretation"]).alias("Interpretation"),
    )
    return union_all([rows, extra])
