"""Registered queries of classifier validation on the gene burden table."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusloom.operators import folds, resampling, validation
from locusloom.operators.cohort import union_all
from locusloom.plans.queries import long_burden, query, rounded
from locusloom.plans.views import view
from locusloom.session import cut_lineage

LABELS = ("control", "disease")


def _inputs(spark, sf):
    samples = folds.binary_label(view(spark, sf, "fx_samples"), "condition", LABELS[1])
    return cut_lineage(long_burden(spark, sf)), samples


def _logo(spark, sf):
    table, samples = _inputs(spark, sf)
    return resampling.written(resampling.logo_predictions(table, samples, "y", "gsm", LABELS))


def _cv(spark, sf, repeats=3):
    table, samples = _inputs(spark, sf)
    return resampling.written(
        resampling.repeated_cv(table, samples, "y", "gsm", LABELS, n_folds=2, repeats=repeats)
    )


@query
def logo_validation(spark, sf):
    return rounded(_logo(spark, sf), "prob_positive", "decision_score").drop("labeling")


@query
def logo_group_report(spark, sf):
    return rounded(validation.group_report(_logo(spark, sf), LABELS), "mean_prob_positive", "mean_decision_score")


@query
def logo_confusion(spark, sf):
    return validation.grouped_confusion(_logo(spark, sf), LABELS)


@query
def repeated_cv(spark, sf):
    return rounded(_cv(spark, sf), "prob_positive", "decision_score")


@query
def repeated_cv_fold_metrics(spark, sf):
    n = view(spark, sf, "fx_samples").count()
    return validation.cv_fold_metrics(_cv(spark, sf), n)


@query
def grouped_permutation(spark, sf):
    table, samples = _inputs(spark, sf)
    return validation.grouped_permutation(table, samples, "y", "gsm", LABELS)[0]


@query
def grouped_permutation_summary(spark, sf):
    table, samples = _inputs(spark, sf)
    return validation.grouped_permutation(table, samples, "y", "gsm", LABELS)[1]


@query
def run_permutation(spark, sf):
    table, samples = _inputs(spark, sf)
    predictions = resampling.plain_cv(table, samples, "y", "gsm", n_folds=2, repeats=3, permutations=20)
    return validation.plain_cv_scores(resampling.written(predictions))


@query
def plain_cv_metrics(spark, sf):
    table, samples = _inputs(spark, sf)
    predictions = resampling.plain_cv(table, samples, "y", "gsm", n_folds=2, repeats=3, permutations=20)
    scores = cut_lineage(validation.plain_cv_scores(resampling.written(predictions)))
    return validation.plain_cv_metrics(scores)


@query
def validation_report(spark, sf):
    table, samples = _inputs(spark, sf)
    n_runs, n_groups = samples.count(), samples.select("gsm").distinct().count()
    cv = resampling.written(resampling.repeated_cv(table, samples, "y", "gsm", LABELS, n_folds=2, repeats=3))
    run = validation.cv_summary(validation.cv_fold_metrics(cv, n_runs), 2, 3, n_runs, n_groups)
    logo = resampling.written(resampling.logo_predictions(table, samples, "y", "gsm", LABELS))
    summaries = cut_lineage(union_all([run, validation.grouped_summary(logo, "gsm")]))
    permuted = validation.grouped_permutation(table, samples, "y", "gsm", LABELS)[1]
    return validation.report_table(summaries, permuted, "gsm").select("*", F.lit("burden").alias("Features"))
