"""Classifier validation against a direct fit in gene space, and the resampling tables."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusloom.operators import folds, large_cohort, resampling, scoring, validation
from locusloom.operators.checks import InputError

LABELS = ("control", "disease")


def newton(x, y, weight, penalise_intercept):
    """Plain Newton on the weights of the genes and the intercept."""
    design = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.ones(design.shape[1])
    if not penalise_intercept:
        penalty[-1] = 0.0
    beta = np.zeros(design.shape[1])

    def loss(b):
        f = design @ b
        return 0.5 * np.sum(penalty * b * b) + np.sum(weight * (np.logaddexp(0, f) - y * f))

    for _ in range(300):
        p = 1 / (1 + np.exp(-design @ beta))
        grad = penalty * beta + design.T @ (weight * (p - y))
        hess = np.diag(penalty) + design.T @ ((weight * p * (1 - p))[:, None] * design)
        step, t = np.linalg.solve(hess + 1e-13 * np.eye(len(beta)), grad), 1.0
        while loss(beta - t * step) > loss(beta) and t > 1e-10:
            t /= 2
        beta = beta - t * step
        if np.max(np.abs(t * step)) < 1e-12:
            break
    return beta


def direct(x, y, mask, scaled):
    train = x[mask]
    if scaled:
        keep = np.ptp(train, axis=0) > 0
        mean, sd = train[:, keep].mean(axis=0), train[:, keep].std(axis=0)
        z = (x[:, keep] - mean) / sd
        n = mask.sum()
        weight = np.where(y[mask] == 1, n / (2 * y[mask].sum()), n / (2 * (n - y[mask].sum())))
    else:
        z, weight = x, np.ones(mask.sum())
    beta = newton(z[mask], y[mask], weight, scaled)
    return z @ beta[:-1] + beta[-1]


@pytest.fixture(scope="module")
def cohort(spark):
    rng = np.random.default_rng(4)
    ids = [f"S{i:02d}" for i in range(12)]
    groups = [f"g{i // 2}" for i in range(12)]
    y = np.array([(i // 2) % 2 for i in range(12)])
    x = rng.poisson(0.8, size=(12, 40)).astype(float)
    x[:, :6] += 2 * y[:, None]
    x[:, 7] = 3.0  # constant gene
    samples = spark.createDataFrame(
        [(s, int(v), g, f"title {g}") for s, v, g in zip(ids, y, groups)], "sample_id string, y int, gsm string, title string"
    )
    cells = [(f"G{g}", f"N{g}", ids[i], int(x[i, g])) for i in range(12) for g in range(40) if x[i, g]]
    cells += [("G1", "N1", "unknown", 5)]
    burden = spark.createDataFrame(cells, "gene_id string, gene_name string, sample_id string, n long")
    return ids, groups, y, x, samples, burden


def test_leave_one_group_out_equals_direct_fit(spark, cohort):
    ids, groups, y, x, samples, burden = cohort
    rows = resampling.logo_predictions(burden, samples, "y", "gsm", LABELS, title="title").collect()
    assert sorted(r["sample_id"] for r in rows) == ids
    for r in rows:
        i = ids.index(r["sample_id"])
        mask = np.array([g != groups[i] for g in groups])
        want = direct(x, y, mask, True)[i]
        assert r["decision_score"] == pytest.approx(want, abs=1e-6)
        assert r["prob_positive"] == pytest.approx(1 / (1 + math.exp(-want)), abs=1e-6)
        assert r["correct"] == ((want > 0) == bool(y[i])) and r["heldout_group"] == groups[i]


def test_repeated_cv_equals_direct_fit(spark, cohort):
    ids, groups, y, x, samples, burden = cohort
    rows = resampling.repeated_cv(burden, samples, "y", "gsm", LABELS, n_folds=3, repeats=2).collect()
    assert len(rows) == 24
    for fold in range(1, 7):
        test = [ids.index(r["sample_id"]) for r in rows if r["fold"] == fold]
        mask = np.ones(12, dtype=bool)
        mask[test] = False
        assert y[test].sum() == 2 and len(test) == 4
        want = direct(x, y, mask, True)
        for r in (r for r in rows if r["fold"] == fold):
            i = ids.index(r["sample_id"])
            assert r["decision_score"] == pytest.approx(want[i], abs=1e-6)
            assert r["paired_group_seen_in_train"] == any(groups[j] == groups[i] for j in np.flatnonzero(mask))
    metrics = validation.cv_fold_metrics(
        resampling.written(resampling.repeated_cv(burden, samples, "y", "gsm", LABELS, n_folds=3, repeats=2)), 12
    ).collect()
    assert {m["n_train"] for m in metrics} == {8} and all(len(m["test_samples"].split(";")) == 4 for m in metrics)


def test_plain_model_with_permutations(spark, cohort):
    ids, _, y, x, samples, burden = cohort
    rows = resampling.plain_cv(burden, samples, "y", "gsm", n_folds=2, repeats=2, permutations=3).collect()
    assert len(rows) == 4 * 2 * 12
    for labeling in range(4):
        for fold in range(1, 5):
            part = {r["at"]: r for r in rows if r["labeling"] == labeling and r["fold"] == fold}
            label = {r["at"]: r["y"] for r in rows if r["labeling"] == labeling}
            target = np.array([label[i] for i in range(12)])
            assert target.sum() == y.sum()
            mask = np.array([i not in part for i in range(12)])
            want = direct(x, target, mask, False)
            assert all(r["decision_score"] == pytest.approx(want[i], abs=1e-5) for i, r in part.items())
    scores = validation.plain_cv_scores(spark.createDataFrame(rows, resampling.PREDICTION_SCHEMA))
    metrics = {r["metric"]: r["value"] for r in validation.plain_cv_metrics(scores).collect()}
    assert set(metrics) == {"roc_auc_mean", "roc_auc_std", "permutation_p"} and 0.25 <= metrics["permutation_p"] <= 1


def test_large_cohort_path_gives_the_same_scores(spark, cohort):
    ids, groups, y, x, samples, burden = cohort
    vectors = large_cohort.sample_vectors(burden, samples)
    held = [(i + 1, samples.filter(F.col("gsm") == g)) for i, g in enumerate(("g0", "g3"))]
    rows = large_cohort.validate(vectors, held, "y").collect()
    small = {r["sample_id"]: r["decision_score"] for r in resampling.logo_predictions(burden, samples, "y", "gsm", LABELS).collect()}
    assert sorted(r["sample_id"] for r in rows) == ["S00", "S01", "S06", "S07"]
    for r in rows:
        assert r["decision_score"] == pytest.approx(small[r["sample_id"]], abs=1e-3)


def test_grouped_permutation_counts_all_labelings(spark, cohort):
    _, _, _, _, samples, burden = cohort
    scores, summary = validation.grouped_permutation(burden, samples, "y", "gsm", LABELS)
    rows = scores.collect()
    assert len(rows) == math.comb(6, 3) and sum(r["is_observed_labeling"] for r in rows) == 1
    observed = next(r for r in rows if r["is_observed_labeling"])
    assert observed["positive_groups"] == "g1;g3;g5"
    for r in summary.collect():
        ge = sum(s[r["metric"]] >= observed[r["metric"]] for s in rows)
        assert r["n_labelings_ge_observed"] == ge and r["p_value"] == pytest.approx(ge / 20)
        assert r["class_balance_preserved"] == "3 positive groups / 3 negative groups"


def test_grouped_permutation_passes_its_fit_bound_on(spark, cohort):
    """A bound below the cohort leaves samples out of the fits, but no labeling and no prediction out of the scores."""
    _, _, _, _, samples, burden = cohort
    scores, _ = validation.grouped_permutation(burden, samples, "y", "gsm", LABELS, max_fit_samples=10)
    sets = [["g1", "g3", "g5"]]
    bounded = resampling.logo_predictions(burden, samples, "y", "gsm", LABELS, labelings=sets, max_fit_samples=10).collect()
    assert scores.count() == math.comb(6, 3)
    assert len(bounded) == len(resampling.logo_predictions(burden, samples, "y", "gsm", LABELS, labelings=sets).collect()) == 12


def test_report_has_one_row_per_analysis(spark, cohort):
    _, _, _, _, samples, burden = cohort
    cv = resampling.written(resampling.repeated_cv(burden, samples, "y", "gsm", LABELS, n_folds=3, repeats=2))
    run = validation.cv_summary(validation.cv_fold_metrics(cv, 12), 3, 2, 12, 6)
    logo = resampling.written(resampling.logo_predictions(burden, samples, "y", "gsm", LABELS))
    summaries = run.unionByName(validation.grouped_summary(logo, "gsm"), allowMissingColumns=True)
    permuted = validation.grouped_permutation(burden, samples, "y", "gsm", LABELS)[1]
    rows = validation.report_table(summaries, permuted, "gsm").collect()
    assert [r["Analysis"] for r in rows].count("Group-aware leave-one-group-out validation") == 2
    assert any("+/-" in r["Accuracy"] for r in rows) and any(r["ROC-AUC"].startswith("observed ") for r in rows)
    report = {r["heldout_group"]: r for r in validation.group_report(logo, LABELS).collect()}
    assert report["g0"]["run_ids"] == "S00;S01" and report["g1"]["true_condition"] == "disease"
    confusion = validation.grouped_confusion(logo, LABELS).collect()
    assert sum(r["pred_control"] + r["pred_disease"] for r in confusion) == 12 + 6


def test_inputs_the_reference_rejects(spark, cohort):
    _, _, _, _, samples, burden = cohort
    with pytest.raises(InputError, match="class sizes"):
        resampling.repeated_cv(burden, samples, "y", "gsm", LABELS, n_folds=7, repeats=1)
    mixed = samples.withColumn("gsm", F.lit("one"))
    with pytest.raises(InputError, match="more than one label"):
        resampling.logo_predictions(burden, mixed, "y", "gsm", LABELS)
    lonely = samples.filter("y = 0 or gsm = 'g1'")
    with pytest.raises(Exception, match="one class only"):
        resampling.logo_predictions(burden, lonely, "y", "gsm", LABELS).collect()


def test_samples_beyond_the_fitted_draw_are_predicted(spark, cohort):
    ids, groups, y, x, samples, burden = cohort
    drawn = resampling.load_cohort(samples, "sample_id", "y", "gsm", max_fit_samples=8)
    assert drawn.size == 8 and drawn.y.sum() == 4 and drawn.rest.count() == 4
    fitted = np.array([i in set(drawn.ids) for i in ids])
    rows = resampling.logo_predictions(burden, samples, "y", "gsm", LABELS, max_fit_samples=8).collect()
    assert sorted(r["sample_id"] for r in rows) == ids
    for r in rows:
        i = ids.index(r["sample_id"])
        mask = fitted & np.array([g != groups[i] for g in groups])
        assert r["decision_score"] == pytest.approx(direct(x, y, mask, True)[i], abs=1e-6)
    rows = resampling.repeated_cv(burden, samples, "y", "gsm", LABELS, n_folds=3, repeats=2, max_fit_samples=8).collect()
    assert len(rows) == 24
    for fold in range(1, 7):
        test = [ids.index(r["sample_id"]) for r in rows if r["fold"] == fold]
        mask = fitted.copy()
        mask[test] = False
        want = direct(x, y, mask, True)
        for r in (r for r in rows if r["fold"] == fold):
            i = ids.index(r["sample_id"])
            assert r["decision_score"] == pytest.approx(want[i], abs=1e-6)
            assert r["paired_group_seen_in_train"] == any(groups[j] == groups[i] for j in np.flatnonzero(mask))
    rows = resampling.plain_cv(burden, samples, "y", "gsm", n_folds=2, repeats=2, permutations=2, max_fit_samples=8).collect()
    assert len(rows) == 3 * 2 * 12 and sum(r["at"] is None for r in rows) == 3 * 2 * 4
    sets = [("g0", "g2", "g4"), ("g1", "g3", "g5")]
    rows = resampling.logo_predictions(burden, samples, "y", "gsm", LABELS, labelings=sets, max_fit_samples=8).collect()
    assert len(rows) == 24
    for r in rows:
        i, target = ids.index(r["sample_id"]), np.isin(groups, sets[r["labeling"]]).astype(int)
        mask = fitted & np.array([g != groups[i] for g in groups])
        assert r["true_label"] == target[i]
        assert r["decision_score"] == pytest.approx(direct(x, target, mask, True)[i], abs=1e-6)


def test_random_labelings(spark):
    rows = [(f"s{i}", f"g{i:02d}", int(i < 8)) for i in range(16)]
    samples = spark.createDataFrame(rows, "sample_id string, gsm string, y int")
    table, exact = folds.group_labelings(samples, "gsm", "y", max_exact=100, n_random=60)
    got = table.orderBy("permutation_id").collect()
    sets = [tuple(r["positive_groups"]) for r in got]
    assert not exact and len(set(sets)) == 60 and [r["permutation_id"] for r in got] == list(range(1, 61))
    assert sum(r["is_observed_labeling"] for r in got) == 1 and all(len(s) == 8 for s in sets)
    again = folds.group_labelings(samples, "gsm", "y", max_exact=100, n_random=60)[0].orderBy("permutation_id").collect()
    assert [tuple(r["positive_groups"]) for r in again] == sets
    table, exact = folds.group_labelings(samples.limit(6).withColumn("y", (F.col("gsm") < "g02").cast("int")), "gsm", "y")
    assert exact and sorted(tuple(r["positive_groups"]) for r in table.collect()) == sorted(
        itertools.combinations([f"g{i:02d}" for i in range(6)], 2)
    )


def test_negative_label(spark):
    def samples(*labels):
        return spark.createDataFrame([(v,) for v in labels], "condition string")

    assert folds.negative_label(samples("a", "b", "a"), "condition", "a") == "b"
    assert folds.negative_label(samples("a", "a"), "condition", "a") == "negative"
    with pytest.raises(InputError):
        folds.negative_label(samples("a", "b", "c"), "condition", "a")


def metrics(spark, rows):
    df = spark.createDataFrame(rows, "t int, p int, s double")
    return scoring.classification_metrics(df, [], "t", "p", "s").first()


def test_one_class_metrics(spark):
    m = metrics(spark, [(1, 1, 0.2), (1, 1, 0.4)])
    assert (m["accuracy"], m["balanced_accuracy"], m["f1_positive"], m["roc_auc"]) == (1.0, 1.0, 1.0, None)
    m = metrics(spark, [(1, 0, 0.2), (1, 0, 0.4)])
    assert (m["accuracy"], m["balanced_accuracy"], m["f1_positive"]) == (0.0, 0.0, 0.0)
    m = metrics(spark, [(0, 0, 0.2), (0, 1, 0.4)])
    assert (m["balanced_accuracy"], m["f1_positive"]) == (0.5, 0.0)
    m = metrics(spark, [(0, 0, 0.3), (1, 1, 0.3), (1, 0, 0.9), (0, 0, 0.1)])
    assert m["roc_auc"] == pytest.approx((0.5 + 1 + 1 + 1) / 4)
    rows = scoring.confusion_matrix(spark.createDataFrame([(1, 1)], "t int, p int"), "t", "p").collect()
    assert [(r["pred_negative"], r["pred_positive"]) for r in rows] == [(0, 0), (0, 1)]


def test_undefined_metric_never_reaches_the_observed_one(spark):
    scores = spark.createDataFrame([(0.5,), (None,), (0.7,)], "m double")
    row = scoring.permutation_pvalues(scores, [("m", F.lit(0.6))], ["m"], exact=True).first()
    assert (row["n_labelings_ge_observed"], row["p_value"]) == (1, pytest.approx(1 / 3))


@pytest.fixture(scope="module")
def large(spark):
    """More samples than fits on matrices of samples take, few genes."""
    rng = np.random.default_rng(9)
    n = resampling.DIRECT_SAMPLES + 48
    ids, groups = [f"S{i:04d}" for i in range(n)], [f"g{i % 10}" for i in range(n)]
    y = np.array([i % 10 % 2 for i in range(n)])
    x = rng.poisson(0.9, size=(n, 8)).astype(float)
    x[:, :2] += rng.poisson(0.4, size=(n, 2)) * y[:, None]
    x[:, 3] = 2.0  # constant gene
    x[:, 4] = np.array(groups) == "g3"  # constant where g3 is held out
    samples = spark.createDataFrame(list(zip(ids, y.tolist(), groups)), "sample_id string, y int, gsm string")
    cells = [(f"G{g}", f"N{g}", ids[i], int(x[i, g])) for i in range(n) for g in range(8) if x[i, g]]
    return ids, groups, y, x, samples, spark.createDataFrame(cells, "gene_id string, gene_name string, sample_id string, n long")


def test_every_sample_of_a_large_cohort_is_fitted_on_when_groups_are_left_out(spark, large, monkeypatch):
    ids, groups, y, x, samples, burden = large
    monkeypatch.setattr(resampling.cohort_fits, "BLOCK_BYTES", 8 * len(ids) * 16)
    sets = [("g0", "g2", "g4", "g6", "g9"), ("g1", "g3", "g5", "g7", "g9")]
    rows = resampling.logo_predictions(burden, samples, "y", "gsm", LABELS, labelings=sets).collect()
    assert len(rows) == 2 * len(ids)
    for s, positive in enumerate(sets):
        target = np.isin(groups, positive).astype(int)
        for number, g in enumerate(sorted(set(groups)), 1):
            want = direct(x, target, np.array(groups) != g, True)
            part = {ids.index(r["sample_id"]): r for r in rows if (r["labeling"], r["fold"]) == (s, number)}
            assert sorted(part) == [i for i, k in enumerate(groups) if k == g]
            assert all(r["true_label"] == target[i] and r["decision_score"] == pytest.approx(want[i], abs=1e-6) for i, r in part.items())
    lonely = samples.filter("y = 0 or gsm = 'g1'")
    monkeypatch.setattr(resampling, "DIRECT_SAMPLES", 0)
    with pytest.raises(Exception, match="one class only"):
        resampling.logo_predictions(burden, lonely, "y", "gsm", LABELS).collect()


def test_every_sample_of_a_large_cohort_is_fitted_on_in_repeated_folds(spark, large):
    ids, groups, y, x, samples, burden = large
    assert resampling.load_cohort(samples, "sample_id", "y", "gsm").ids == ids
    rows = resampling.repeated_cv(burden, samples, "y", "gsm", LABELS, n_folds=2, repeats=2).collect()
    assert len(rows) == 2 * len(ids)
    for fold in range(1, 5):
        part = {ids.index(r["sample_id"]): r for r in rows if r["fold"] == fold}
        mask = np.array([i not in part for i in range(len(ids))])
        want = direct(x, y, mask, True)
        assert all(r["decision_score"] == pytest.approx(want[i], abs=1e-6) for i, r in part.items())
    rows = resampling.plain_cv(burden, samples, "y", "gsm", n_folds=2, repeats=1, permutations=1).collect()
    assert len(rows) == 2 * len(ids)
    for labeling, fold in itertools.product((0, 1), (1, 2)):
        label = np.array([r["y"] for r in sorted(rows, key=lambda r: r["at"]) if r["labeling"] == labeling])
        part = {r["at"]: r for r in rows if (r["labeling"], r["fold"]) == (labeling, fold)}
        want = direct(x, label, np.array([i not in part for i in range(len(ids))]), False)
        assert label.sum() == y.sum()
        assert all(r["decision_score"] == pytest.approx(want[i], abs=1e-6) for i, r in part.items())
