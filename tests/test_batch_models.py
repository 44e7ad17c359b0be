"""Models fitted together (F1, F2, F6) against one-by-one solvers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortguard.functions.noise import gaussian_sigma
from cohortguard.operators import metrics as M
from cohortguard.operators import models as ML
from cohortguard.operators.batch_fit import fit_many, model_scores


def table(spark, n=400, d=3, seed=1, gap=1.0):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.4).astype(int)
    x = rng.standard_normal((n, d)) + gap * y[:, None] * np.linspace(1, 0, d)
    rows = [(i, int(y[i]), *map(float, x[i])) for i in range(n)]
    names = [f"f{j}" for j in range(d)]
    return spark.createDataFrame(rows, ["id", "label", *names]).repartition(5), names, x, y


def newton(x, y, w=None):
    """Plain Newton, C = 1, intercept last and unpenalised."""
    w = np.ones(len(y)) if w is None else w
    xb = np.hstack([x, np.ones((len(x), 1))])
    b, ridge = np.zeros(xb.shape[1]), np.append(np.ones(x.shape[1]), 0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-xb @ b))
        step = np.linalg.solve((xb * (w * p * (1 - p))[:, None]).T @ xb + np.diag(ridge), xb.T @ (w * (p - y)) + ridge * b)
        b = b - step
    return b


def test_models_fitted_together_equal_single_fits(spark):
    df, names, x, y = table(spark)
    halves = [F.col("id") % 2 == k for k in (0, 1)]
    weights = [F.lit(1.0), *[h.cast("double") for h in halves], F.lit(1.0)]
    masks = [[True] * 3] * 3 + [[True, False, True]]
    labels = [F.col("label")] * 2 + [1 - F.col("label")] + [F.col("label")]
    got = fit_many(df, names, labels, weights, masks)
    odd = np.arange(len(y)) % 2
    want = [newton(x, y), newton(x, y, odd == 0), newton(x, 1 - y, odd == 1)]
    assert np.allclose(got[:3], want, atol=1e-7)
    assert got[3][1] == 0 and np.allclose(got[3][[0, 2, 3]], newton(x[:, [0, 2]], y), atol=1e-7)


def test_separable_labels_null_features_and_no_rows(spark):
    rows = [(i, int(i > 20), float(1000 * (i - 20.5))) for i in range(41)] + [(99, 1, None), (100, 0, math.nan), (101, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, label int, f0 double")
    got = fit_many(df, ["f0"], [F.col("label")])
    assert np.isfinite(got).all() and got[0][0] > 0
    assert fit_many(df.limit(0), ["f0"], [F.col("label")]).tolist() == [[0.0, 0.0]]
    assert model_scores(df, ["f0"], "label", got).count() == 41


def test_scores_of_chosen_models(spark):
    df, names, x, _ = table(spark, n=50)
    coef = np.array([[1.0, 2.0, 3.0, 4.0], [0.0, 0.0, 1.0, 0.0]])
    rows = model_scores(df, names, "label", coef, [F.col("id") < 10, F.col("id") >= 10]).collect()
    assert sorted(r.model for r in rows) == [0] * 10 + [1] * 40
    want = [x[i] @ coef[0][:3] + 4 for i in range(10)] + [x[i][2] for i in range(10, 50)]
    assert np.allclose(sorted(r.score for r in rows), sorted(want))


# --- F1

def test_a_row_moves_the_gradient_by_the_clip_at_most(spark):
    df, names, _, _ = table(spark, n=60)
    wild = spark.createDataFrame([(1000, 0, 1e6, -1e6, 1e6)], df.schema)
    calm = spark.createDataFrame([(1001, 1, 0.01, 0.0, 0.0)], df.schema)
    w = [0.5, -1.0, 2.0, 0.1]
    base = ML.clipped_gradient_sum(df, names, "label", w, 0.7).first()

    def moved(more):
        got = ML.clipped_gradient_sum(df.unionByName(more), names, "label", w, 0.7).first()
        return math.dist(got[:4], base[:4])
    assert moved(wild) == pytest.approx(0.7)
    assert 0 < moved(calm) < 0.7
    holes = spark.createDataFrame([(1002, None, 1.0, 1.0, 1.0), (1003, 1, None, 1.0, 1.0), (1004, 1, math.nan, 1.0, 1.0)], df.schema)
    assert ML.clipped_gradient_sum(df.unionByName(holes), names, "label", w, 0.7).first()[:5] == base[:5]
    assert ML.clipped_gradient_sum(df.limit(0), names, "label", w, 0.7).first()[:] == (0.0,) * 4 + (0,)


def test_training_stops_where_the_gate_refuses(spark):
    df, names, _, _ = table(spark)
    run = lambda total, epochs: ML.train_with_budget(
        df.where("id % 4 > 0"), df.where("id % 4 = 0"), names, "label", total, 500_000, epochs).first()
    full, cut, none = run(2_000_000, 3), run(1_250_000, 3), run(400_000, 3)
    assert (full.epochs_completed, full.budget_maintained, full.consumed_micro) == (3, True, 1_500_000)
    assert (cut.epochs_completed, cut.budget_maintained, cut.consumed_micro) == (2, False, 1_000_000)
    assert (none.epochs_completed, none.auc, none.consumed_micro) == (0, None, 0)
    assert full.noise_sigma == gaussian_sigma(1.0, 0.5)


def test_noise_has_the_stated_scale(spark):
    df, names, _, _ = table(spark, n=4)
    args = (df, df, names, "label", 10_000_000, 1_000_000, 1)
    still = ML.train_with_budget(*args, noise=False, rate=1.0).first()
    drawn = [ML.train_with_budget(*args, rate=1.0, seed=f"s{k}").first() for k in range(6)]
    steps = np.array([np.array(r.weights) - np.array(still.weights) for r in drawn]) * 4  # sums, not means
    assert steps.std() == pytest.approx(gaussian_sigma(1.0, 1.0), rel=0.35)
    assert still.noise_sigma == 0
    again = ML.train_with_budget(*args, rate=1.0, seed="s0").first()
    assert again.weights == drawn[0].weights  # a retried job draws the same noise


def test_more_epsilon_ranks_better(spark):
    df, names, _, _ = table(spark, n=300, gap=2.0)

    def auc(eps):
        return np.mean([ML.train_with_budget(df, df, names, "label", 10 ** 9, eps, 4, seed=f"a{k}").first().auc
                        for k in range(2)])
    assert auc(20_000_000) > auc(20_000) + 0.05 and auc(20_000_000) > 0.85


# --- F2

def test_utility_curve(spark):
    df, names, _, _ = table(spark, n=500, gap=2.0)
    runs = ML.utility_curve_runs(df, names, "label", "id", (0.1, 8.0), 3).collect()
    assert len(runs) == 7 and sum(r.epsilon is None for r in runs) == 1
    by_eps = {e: np.mean([r.auc for r in runs if r.epsilon == e]) for e in (0.1, 8.0)}
    assert by_eps[8.0] >= by_eps[0.1] - 0.02
    curve = ML.privacy_utility_curve(df, names, "label", "id", (0.1, 8.0), 3).orderBy("epsilon").collect()
    assert [r.mean_auc for r in curve] == [round(by_eps[e], 4) for e in (0.1, 8.0)]
    base = next(r.auc for r in runs if r.epsilon is None)
    assert all(r.auc_retention_pct == pytest.approx(100 * r.mean_auc / base, abs=0.06) for r in curve)


def test_one_model_of_the_curve_equals_its_own_fit(spark):
    df, names, x, y = table(spark, n=200)
    split = {r.id: r.is_train for r in M.split_train_test(df, "id", 0.75, 99, stratify="label").collect()}
    train = np.array([split[i] for i in range(200)])
    z = (x - x[train].mean(axis=0)) / x[train].std(axis=0)
    b = newton(z[train], y[train])
    s = z[~train] @ b[:3] + b[3]
    pos, neg = s[y[~train] == 1], s[y[~train] == 0]
    want = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    got = ML.utility_curve_runs(df, names, "label", "id", (1.0,), 1).where("epsilon is null").first().auc
    assert got == pytest.approx(want, abs=1e-12)


# --- F6

def test_minimization_finds_what_matters(spark):
    df, names, _, _ = table(spark, n=400, d=6, gap=2.0)
    tiers = spark.createDataFrame([("f5", "Quasi-ID"), ("f0", "Direct ID"), ("other", "Direct ID")], "feature string, tier string")
    rows = ML.feature_minimization(df, names, "label", "id", tiers, 0.02).collect()
    found = {r.feature: r for r in rows}
    assert [r.importance for r in rows] == sorted(r.importance for r in rows) and len(rows) == 6
    assert found["f0"].auc_delta > found["f5"].auc_delta
    assert found["f5"].recommendation == "Remove"  # a quasi-identifier that costs nothing
    assert {r.privacy_risk_tier for r in rows} == {"Benign", "Quasi-ID", "Direct ID"}
    for r in rows:
        low = 0.02 if r.privacy_risk_tier != "Benign" else 0.01
        what = "Remove" if r.privacy_risk_tier != "Benign" else "Review"
        assert r.recommendation == (what if r.auc_delta < low else "Retain")


def test_minimization_of_many_features(spark):
    df, names, x, y = table(spark, n=200, d=47, gap=1.0)
    scores, importance = ML.drop_column_scores(df, names, "label", "id")
    assert scores.groupBy("variant").count().where("count = 200").count() == 48
    assert importance.count() == 47


def test_folds_are_stratified(spark):
    df, _, _, y = table(spark, n=203)
    counts = {(r.label, r.fold): r["count"] for r in
              M.stratified_folds(df, "id", "label", 5, 1).groupBy("label", "fold").count().collect()}
    for c in (0, 1):
        sizes = [counts[c, k] for k in range(5)]
        assert sum(sizes) == (y == c).sum() and max(sizes) - min(sizes) <= 1


def test_labels_are_drawn_once_and_not_at_every_step(spark):
    """what a drawn label costs does not grow with the steps."""
    drawn = spark.sparkContext.accumulator(0)

    def draw(i):
        drawn.add(1)
        return i * 7 % 3 // 2

    rows = spark.createDataFrame([(i, i % 10 - 4.5) for i in range(200)], "id int, a double")
    coef = fit_many(rows, ["a"], [F.udf(draw, "int")("id")])
    assert np.isfinite(coef).all() and 200 <= drawn.value <= 400  # the filter and the row; there are more steps
