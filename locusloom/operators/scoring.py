"""Classification metrics, prediction roll-ups and permutation p-values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusloom.functions.text import fixed_text
from locusloom.operators.ordered import value_totals


def roc_auc(df: DataFrame, keys: Sequence[str], truth: str, score: str, name: str = "roc_auc") -> DataFrame:
    """Area under the ROC curve per key, ties counted half; NULL with one class only.

    Scores are first counted per distinct value; no row of the input is ranked.
    """
    keys = list(keys)
    y = F.col(truth).cast("long")
    totals = value_totals(df, keys, score, {"_pos": F.sum(y), "_neg": F.sum(1 - y)})
    wins = F.sum(F.col("_pos").cast("double") * (F.col("_neg_before") + F.col("_neg") / 2))
    sides = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return totals.groupBy(*keys).agg(wins.alias("_w"), sides.alias("_s")).select(
        *keys, F.when(F.col("_s") > 0, F.col("_w") / F.col("_s")).alias(name)
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom)


def label_metrics(df: DataFrame, keys: Sequence[str], truth: str, pred: str) -> DataFrame:
    """Accuracy, balanced accuracy and F1 per key from the four cell counts."""
    t, p = F.col(truth).cast("int"), F.col(pred).cast("int")
    cells = df.groupBy(*keys).agg(
        F.count_if((t == 1) & (p == 1)).alias("tp"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    recall_1, recall_0 = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    balanced = F.when(recall_1.isNull(), recall_0).when(recall_0.isNull(), recall_1).otherwise((recall_1 + recall_0) / 2)
    one_truth, one_pred = ((tp + fn) == 0) | ((tn + fp) == 0), ((tp + fp) == 0) | ((tn + fn) == 0)
    f1 = (
        F.when(one_truth & one_pred, F.when(fp + fn == 0, 1.0).otherwise(0.0))
        .when(2 * tp + fp + fn == 0, 0.0)
        .otherwise(2 * tp / (2 * tp + fp + fn))
    )
    return cells.select(
        *keys,
        n.alias("n"),
        _ratio(tp + tn, n).alias("accuracy"),
        balanced.alias("balanced_accuracy"),
        f1.alias("f1_positive"),
    )


def classification_metrics(df: DataFrame, keys: Sequence[str], truth: str, pred: str, score: str) -> DataFrame:
    """Label metrics with the area under the ROC curve of the score."""
    keys = list(keys)
    labels, auc = label_metrics(df, keys, truth, pred), roc_auc(df, keys, truth, score)
    if keys:
        return labels.join(auc, keys)
    return labels.withColumn("roc_auc", auc.scalar())


def confusion_matrix(
    df: DataFrame, truth: str, pred: str, labels: tuple[str, str] = ("negative", "positive"), analysis: str = "all"
) -> DataFrame:
    """Two rows (true class) by two columns (predicted class), zeros included."""
    t, p = F.col(truth).cast("int"), F.col(pred).cast("int")
    cells = df.agg(*[F.count_if((t == a) & (p == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    rows = [
        F.struct(
            F.lit(analysis).alias("analysis"),
            F.lit(labels[a]).alias("true_condition"),
            F.col(f"c{a}0").alias(f"pred_{labels[0]}"),
            F.col(f"c{a}1").alias(f"pred_{labels[1]}"),
        )
        for a in (0, 1)
    ]
    return cells.select(F.inline(F.array(*rows)))


def predicted_class(prob: Column) -> Column:
    return (prob >= 0.5).cast("int")


def group_predictions(
    df: DataFrame,
    keys: Sequence[str],
    truth: str,
    prob: str,
    score: str,
    title: str | None = None,
) -> DataFrame:
    """Mean probability and score per group, the class they give, and whether it is right."""
    extra = [F.array_join(F.array_sort(F.collect_set(title)), ";").alias("group_title")] if title else []
    means = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.max(truth).cast("int").alias("true_label"),
        F.avg(prob).alias("mean_prob_positive"),
        F.avg(score).alias("mean_decision_score"),
        *extra,
    )
    label = predicted_class(F.col("mean_prob_positive"))
    return means.withColumn("predicted_label", label).withColumn("correct", F.col("true_label") == label)


def group_run_lists(df: DataFrame, keys: Sequence[str], run: str, condition: str, prob: str) -> DataFrame:
    """``;``-joined run ids, predicted conditions and probabilities per group, in run order.

    For report tables of held-out groups; a list is as long as its group.
    """
    runs = F.array_sort(F.collect_list(F.struct(run, condition, prob)))

    def listed(part):
        return F.array_join(F.transform("_runs", part), ";")

    return df.groupBy(*keys).agg(runs.alias("_runs")).select(
        *keys,
        listed(lambda r: r[run]).alias("run_ids"),
        listed(lambda r: r[condition]).alias("run_predicted_conditions"),
        listed(lambda r: fixed_text(r[prob], 6)).alias("run_prob_positive"),
    )


def permutation_pvalues(
    scores: DataFrame, observed: Sequence[tuple[str, Column]], metrics: Sequence[str], exact: bool
) -> DataFrame:
    """Share of labelings whose metric reaches the observed value, one row per metric.

    ``scores`` has one row per labeling, the observed one included. ``observed`` gives
    the observed value per metric as a column (a literal or a scalar subquery).
    """
    known = dict(observed)
    counts = scores.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(m) >= known[m]).alias(f"_ge_{m}") for m in metrics],
        *[F.max(known[m]).alias(f"_ob_{m}") for m in metrics],
    )
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"_ob_{m}").alias("observed_value"),
            F.col("_n").alias("n_labelings_including_observed"),
            F.col(f"_ge_{m}").alias("n_labelings_ge_observed"),
        )
        for m in metrics
    ]
    n, ge = F.col("n_labelings_including_observed"), F.col("n_labelings_ge_observed")
    p = ge / n if exact else (ge + 1) / (n + 1)
    return counts.select(F.inline(F.array(*rows))).withColumn("p_value", p)
