"""Model-based privacy jobs (F1–F8) and their summaries.

F1 is a loop of clipped, noised gradient aggregations; the many models of F2
and F6 are fitted together (:mod:`.batch_fit`), and so are the models of all
sites (F7, F8); other fits use MLlib (distributed ``treeAggregate`` gradients).  The driver
only loops over epochs, steps or rounds and collects model vectors (d + 1
numbers) — never rows.  Scores, AUCs and summaries are
the DataFrame operators of :mod:`.metrics`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import governance as G
from . import metrics as M
from ..sources import fixtures as FX
from ..functions.noise import DEFAULT_DELTA, gaussian_noise, gaussian_sigma
from .batch_fit import fit_many, model_scores
from .budget import consume_budget
from .common import materialize
from .dp import flipped_label


def _fit_lr(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 100):
    """L2 logistic regression equivalent to C = 1 on standardized inputs."""
    n = train.count()
    lr = LogisticRegression(featuresCol="_x", labelCol=label, maxIter=max_iter,
                            regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False)
    vec = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep")
    return vec, lr.fit(vec.transform(train.withColumn(label, F.col(label).cast("double"))))


def _auc_of(vec, model, test: DataFrame, label: str) -> float | None:
    pred = model.transform(vec.transform(test)).select(
        F.col(label).cast("int").alias("y"), vector_to_array("probability")[1].alias("p"))
    r = M.roc_auc(pred, "y", "p").first()
    return None if r is None else r.auc


def _scaled(train: DataFrame, test: DataFrame, features):
    stats = M.moments(train, features)
    return M.standardize(train, features, stats), M.standardize(test, features, stats)


# --------------------------------------------------------------------------
# F1 — training charged to a privacy budget
# --------------------------------------------------------------------------

def clipped_gradient_sum(rows: DataFrame, features: Sequence[str], label: str, weights: Sequence[float],
                         clip: float) -> DataFrame:
    """One row ``g0 .. gd, n``: the sum over rows of the logistic loss gradient
    (intercept last), each row's own gradient scaled to a norm of at most
    ``clip``.  One row therefore moves the sum by at most ``clip``.

    A plain aggregation (map-side combined).  Rows with a null or NaN feature
    or a null label add nothing and do not count.
    """
    xs = [F.col(f).cast("double") for f in features] + [F.lit(1.0)]
    usable = F.col(label).isNotNull()
    for x in xs[:-1]:
        usable = usable & x.isNotNull() & ~F.isnan(x)
    eta = M.linear_score(features, weights[:-1], weights[-1])
    slope = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta)) - F.col(label).cast("double")
    norm = F.abs(slope) * F.sqrt(sum((x * x for x in xs), F.lit(0.0)))
    scaled = slope * F.when(norm > clip, F.lit(float(clip)) / norm).otherwise(F.lit(1.0))
    part = rows.where(usable).select(scaled.alias("_s"), *[x.alias(f"_x{i}") for i, x in enumerate(xs)])
    return part.agg(*[F.coalesce(F.sum(F.col("_s") * F.col(f"_x{i}")), F.lit(0.0)).alias(f"g{i}")
                      for i in range(len(xs))], F.count(F.lit(1)).alias("n"))


def train_with_budget(train: DataFrame, test: DataFrame, features, label: str, total_micro: int,
                      epsilon_per_epoch_micro: int, n_epochs: int, *, clip: float = 1.0, rate: float = 2.0,
                      delta: float = DEFAULT_DELTA, noise: bool = True, seed="dpsgd") -> DataFrame:
    """differentially private training that a budget stops.

    Epochs are budget operations: the gate (E4) decides each one before its
    gradient is read, and training ends at the first it refuses.  An epoch sums
    the clipped gradients of all training rows (:func:`clipped_gradient_sum`),
    adds Gaussian noise of the scale that ``epsilon_per_epoch_micro`` and
    ``delta`` ask for at sensitivity ``clip`` (keyed by epoch and coordinate,
    so a retried job draws the same noise) and steps by ``rate`` times the
    mean.  ``noise=False`` is the same loop without noise.

    Features are scaled by the training rows' moments, which are not
    themselves noised.  Returns one row: epochs, AUC on ``test`` (null before
    the first epoch), whether every epoch was permitted, what was consumed,
    ``noise_sigma`` and the weights.
    """
    spark = train.sparkSession
    plan = spark.createDataFrame([("train", e, int(epsilon_per_epoch_micro)) for e in range(1, n_epochs + 1)],
                                 "budget_id string, seq int, epsilon_micro long")
    gate = [r.allowed for r in consume_budget(plan, total_micro).orderBy("seq").collect()]  # one row an epoch
    epochs = gate.index(False) if False in gate else len(gate)
    tr, te = _scaled(train.select(label, *features), test.select(label, *features), features)
    tr = materialize(tr) if epochs else tr
    sigma = gaussian_sigma(clip, epsilon_per_epoch_micro / 1e6, delta) if noise else 0.0
    d = len(features) + 1
    w = [0.0] * d
    for e in range(1, epochs + 1):
        drawn = [(F.col(f"g{i}") + gaussian_noise(sigma, seed, "gradient", F.lit(e), F.lit(i)) if noise
                  else F.col(f"g{i}")).alias(f"g{i}") for i in range(d)]
        g = clipped_gradient_sum(tr, features, label, w, clip).select("n", *drawn).first()
        w = [w[i] - rate * g[f"g{i}"] / max(g.n, 1) for i in range(d)]
    auc = None
    if epochs:
        auc = M.roc_auc(model_scores(te, features, label, np.array([w])), "label", "score").first().auc
    return spark.createDataFrame(
        [(epochs, None if auc is None else round(auc, 4), all(gate), int(epochs * epsilon_per_epoch_micro),
          int(total_micro), float(sigma), [float(x) for x in w])],
        "epochs_completed int, auc double, budget_maintained boolean, consumed_micro long, total_micro long, "
        "noise_sigma double, weights array<double>")


# --------------------------------------------------------------------------
# F2 / D22 — privacy–utility curve
# --------------------------------------------------------------------------

EPSILONS = (0.1, 0.5, 1.0, 2.0, 4.0, 8.0, 10.0)


def utility_curve_runs(df: DataFrame, features, label: str, id_col: str, epsilons=EPSILONS, runs: int = 5,
                       seed: int = 99) -> DataFrame:
    """AUC on a fixed stratified test quarter of models trained on labels
    flipped by randomised response, one per ε and run; ``epsilon`` and ``run``
    are null for the model of the true labels.

    All models are fitted together (:mod:`.batch_fit`) and all their scores
    are ranked in one pass.
    """
    split = M.split_train_test(df.select(id_col, label, *features), id_col, 0.75, seed, stratify=label)
    stats = materialize(M.moments(split.where("is_train"), features))
    z = materialize(M.standardize(split, features, stats))
    grid = [(float(e), r) for e in epsilons for r in range(runs)]
    labels = [F.col(label)] + [flipped_label(label, e, f"{seed}:{r}", id_col) for e, r in grid]
    coef = fit_many(z.where("is_train"), features, labels)
    aucs = M.roc_auc(model_scores(z.where("not is_train"), features, label, coef), "label", "score", by=["model"])
    models = df.sparkSession.createDataFrame([(0, None, None)] + [(k + 1, e, r) for k, (e, r) in enumerate(grid)],
                                             "model int, epsilon double, run int")
    return models.join(aucs.select("model", "auc"), "model", "left").select("epsilon", "run", "auc")


def privacy_utility_curve(df: DataFrame, features, label: str, id_col: str, epsilons=EPSILONS, runs: int = 5,
                          seed: int = 99) -> DataFrame:
    """F2 with its D22 summary: mean and population std of the AUC per ε, and
    what share of the AUC of the true labels it keeps."""
    found = materialize(utility_curve_runs(df, features, label, id_col, epsilons, runs, seed))
    return utility_curve_summary(found.where("epsilon is not null"),
                                 found.where("epsilon is null").select("auc").scalar())


def utility_curve_summary(runs: DataFrame, baseline_auc: float | Column) -> DataFrame:
    """Mean and population std of AUC per ε; retention vs baseline
    (zero for a baseline of zero; null where an AUC is not defined)."""
    base = baseline_auc.cast("double") if isinstance(baseline_auc, Column) else F.lit(float(baseline_auc))
    return (runs.groupBy("epsilon")
            .agg(F.round(F.avg("auc"), 4).alias("mean_auc"), F.round(F.stddev_pop("auc"), 4).alias("std_auc"))
            .withColumn("baseline_auc", base)
            .withColumn("auc_retention_pct",
                        F.when(F.col("baseline_auc") > 0,
                               F.round(F.lit(100.0) * F.col("mean_auc") / F.col("baseline_auc"), 1))
                        .otherwise(F.lit(0.0))))


# --------------------------------------------------------------------------
# F6 — feature minimization
# --------------------------------------------------------------------------

def drop_column_scores(df: DataFrame, features, label: str, id_col: str, folds: int = 5,
                       seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Held-out scores of every drop-column model, and the features' importance.

    Scores: ``(variant, fold, label, score)``; variant 0 sees all features,
    variant j all but the j-th; a row is scored by the models that did not see
    its fold.  Folds are exactly stratified.  Importance: ``(feature,
    feature_pos, importance)``, the mean absolute contribution
    |β|·E|x − E x| to the log odds of one more model, fitted on all rows.
    All (folds x variants + 1) models are fitted together.
    """
    d = len(features)
    placed = M.stratified_folds(df.select(id_col, label, *features), id_col, label, folds, seed)
    z = materialize(M.standardize(placed, features))
    models = [(v, k) for v in range(d + 1) for k in range(folds)]
    masks = [[v != j + 1 for j in range(d)] for v, _ in models] + [[True] * d]
    weights = [(F.col("fold") != k).cast("double") for _, k in models] + [F.lit(1.0)]
    coef = fit_many(z, features, [F.col(label)], weights, masks)
    held = [F.col("fold") == k for _, k in models]
    scores = (model_scores(z, features, label, coef[:-1], held)
              .select(F.floor(F.col("model") / folds).cast("int").alias("variant"),
                      F.pmod("model", F.lit(folds)).alias("fold"), "label", "score"))
    spread = z.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in features])
    pairs = ", ".join(f"'{c}', {i}, {abs(float(b))!r}D * `{c}`" for i, (c, b) in enumerate(zip(features, coef[-1])))
    return scores, spread.selectExpr(f"stack({d}, {pairs}) AS (feature, feature_pos, importance)")


def feature_minimization(df: DataFrame, features, label: str, id_col: str, tiers: DataFrame, tolerance: float = 0.02,
                         folds: int = 5, seed: int = 42) -> DataFrame:
    """what each feature is worth and whether to keep it.

    Cross-validated AUC without the feature (mean over folds), its loss
    against all features, privacy tier (C4), decision (B12) and rank by
    ascending importance (E7).  ``tiers`` is ``(feature, tier)``; features it
    does not name are benign.  Rows with a null feature or label take no part.
    """
    scores, importance = drop_column_scores(df, features, label, id_col, folds, seed)
    aucs = materialize(M.roc_auc(scores, "label", "score", by=["variant", "fold"])
                       .groupBy("variant").agg(F.avg("auc").alias("auc")))
    full = aucs.where("variant = 0").select("auc").scalar()
    without = aucs.where("variant > 0").select((F.col("variant") - 1).alias("feature_pos"), F.col("auc").alias("_auc"))
    found = (G.with_privacy_tier(importance.join(without, "feature_pos"), tiers)
             .select("feature", "feature_pos", F.round("importance", 4).alias("importance"),
                     F.round("_auc", 4).alias("auc_without_feature"),
                     (F.round(full - F.col("_auc"), 4) + F.lit(0.0)).alias("auc_delta"), "privacy_risk_tier"))
    decided = found.withColumn("recommendation", G.minimization_decision("auc_delta", "privacy_risk_tier", tolerance))
    return G.rank_features(decided)


# --------------------------------------------------------------------------
# F5 / F3 — membership advantage and TSTR
# --------------------------------------------------------------------------

def mia_advantage(real: DataFrame, synth: DataFrame, features) -> DataFrame:
    """real-vs-synthetic classifier; advantage = max(0, accuracy − 0.5)
    on the training rows (reference rule) and a class-balanced variant."""
    both = (real.select(*features).withColumn("_real", F.lit(1))
            .unionByName(synth.select(*features).withColumn("_real", F.lit(0))))
    stats = M.moments(both, features)
    z = M.standardize(both, features, stats)
    vec, model = _fit_lr(z, features, "_real")
    pred = model.transform(vec.transform(z)).select("_real", F.col("prediction").cast("int").alias("p"))
    acc = pred.agg(F.avg((F.col("p") == F.col("_real")).cast("double")).alias("acc"),
                   F.avg(F.when(F.col("_real") == 1, (F.col("p") == 1).cast("double"))).alias("tpr"),
                   F.avg(F.when(F.col("_real") == 0, (F.col("p") == 0).cast("double"))).alias("tnr"))
    return acc.select(
        F.round(F.greatest(F.lit(0.0), F.col("acc") - 0.5), 4).alias("mia_advantage"),
        F.round(F.greatest(F.lit(0.0), (F.col("tpr") + F.col("tnr")) / 2 - 0.5), 4).alias("mia_advantage_balanced"))


def tstr(real: DataFrame, synth: DataFrame, features, label: str, id_col: str, seed: int = 0) -> DataFrame:
    """fidelity, three AUCs (real→real, synth→synth, each on a held-out
    part, synth→real), utility, membership advantage, composite (D8) and its
    letter grade (B11)."""
    fid = M.fidelity_score(M.marginal_fidelity(real, synth, features)).first().fidelity_score
    split = M.split_train_test(real, id_col, 0.7, seed)
    r_tr, r_te = split.where("is_train"), split.where("not is_train")

    def fit_eval(train, test):
        stats = M.moments(train, features)
        vec, model = _fit_lr(M.standardize(train, features, stats), features, label)
        a = _auc_of(vec, model, M.standardize(test, features, stats), label)
        return 0.5 if a is None else a
    auc_real = fit_eval(r_tr, r_te)
    s_split = M.split_train_test(synth, id_col, 0.7, seed)
    auc_syn = fit_eval(s_split.where("is_train"), s_split.where("not is_train"))
    auc_tstr = fit_eval(synth, r_te)
    adv = mia_advantage(r_tr, synth, features).first().mia_advantage
    spark = real.sparkSession
    base = spark.createDataFrame([(round(fid, 1), round(auc_syn, 4), round(auc_tstr, 4), round(auc_real, 4), adv)],
                                 "fidelity_score double, utility_auc_synthetic double, utility_auc_tstr double, "
                                 "utility_auc_real double, mia_advantage double")
    scored = base.select("*", *M.tstr_composite("fidelity_score", "utility_auc_tstr", "utility_auc_real", "mia_advantage"))
    return scored.withColumn("grade", G.letter_grade("overall_tstr_score", FX.TSTR_GRADES))


# --------------------------------------------------------------------------
# F7 / F8 — federated training rounds
# --------------------------------------------------------------------------

def _site_rows(df: DataFrame, features, label: str, site_col: str) -> DataFrame:
    """(site, _y, _x): the rows that sites train on; one with a null or NaN
    feature or a null label or site takes no part, whatever its site's size."""
    xs = [F.col(f).cast("double") for f in features]
    usable = F.col(label).isNotNull() & F.col(site_col).isNotNull()
    for x in xs:
        usable = usable & x.isNotNull() & ~F.isnan(x)
    return df.where(usable).select(site_col, F.col(label).cast("double").alias("_y"), F.array(*xs, F.lit(1.0)).alias("_x"))


def _dot(d: int, a: str = "_x", b: str = "w") -> Column:
    return sum((F.col(a)[i] * F.col(b)[i] for i in range(d + 1)), F.lit(0.0))


def newton_step(rows: DataFrame, state: DataFrame, d: int, site_col: str, penalty: float = 1.0) -> DataFrame:
    """One Newton step of the L2 logistic model of every site: ``state``
    (site, n, w) with ``w`` moved on (intercept last and unpenalised).

    The gradient and Hessian sums of all sites are one partially aggregated
    ``groupBy(site)``, so a site of any size spreads over every task; a task
    then solves the (d+1) x (d+1) systems of the sites it holds.  Sites, their
    number and their weights stay in tables.
    """
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-_dot(d)))
    pairs = [(i, k) for i in range(d + 1) for k in range(i, d + 1)]
    joined = rows.join(state, site_col).select(site_col, "n", "w", "_x", (p - F.col("_y")).alias("_r"), (p * (1 - p)).alias("_q"))
    sums = joined.groupBy(site_col).agg(
        F.first("n").alias("n"), F.first("w").alias("w"),
        F.array(*[F.sum(F.col("_r") * F.col("_x")[i]) for i in range(d + 1)]).alias("g"),
        F.array(*[F.sum(F.col("_q") * F.col("_x")[i] * F.col("_x")[k]) for i, k in pairs]).alias("h"))

    def solve(batches):
        ridge = np.full(d + 1, penalty)
        ridge[-1] = 0.0
        upper = tuple(np.array(pairs).T)
        for pdf in batches:
            moved = []
            for w, g, h in zip(pdf["w"], pdf["g"], pdf["h"]):
                hess = np.zeros((d + 1, d + 1))
                hess[upper] = h
                hess = hess + np.triu(hess, 1).T + np.diag(ridge + 1e-9)
                moved.append((np.asarray(w) - np.linalg.solve(hess, np.asarray(g) + ridge * w)).tolist())
            pdf["w"] = moved
            yield pdf[[site_col, "n", "w"]]

    kind = rows.schema[site_col].dataType.simpleString()
    return sums.mapInPandas(solve, f"`{site_col}` {kind}, n long, w array<double>")


def train_sites(df: DataFrame, features, label: str, global_w: Sequence[float] | None, site_col: str = "site_id",
                steps: int = 12) -> DataFrame:
    """one local model per site, ``steps`` Newton steps from the global
    weights: ``(site, n, w, local_auc)``.

    The same path for sites of any size and any number of them
    (:func:`newton_step`); the state between steps is a table in the shared
    folder.  ``local_auc`` is null for a site with one class.
    """
    d = len(features)
    rows = _site_rows(df, features, label, site_col)
    start = F.array(*[F.lit(float(x)) for x in (global_w if global_w is not None else [0.0] * (d + 1))])
    state = rows.groupBy(site_col).agg(F.count(F.lit(1)).alias("n")).withColumn("w", start)
    for _ in range(steps):
        state = materialize(newton_step(rows, state, d, site_col))
    scored = rows.join(state, site_col).select(site_col, F.col("_y").cast("int").alias("_y"), F.round(_dot(d), 9).alias("_s"))
    auc = M.roc_auc(scored, "_y", "_s", by=[site_col])
    return state.join(auc.select(site_col, F.round("auc", 4).alias("local_auc")), site_col, "left")


def federated_train(df: DataFrame, holdout: DataFrame, features, label: str, rounds: int = 5,
                    site_col: str = "site_id", min_n: int = 50, local_steps: int = 2) -> DataFrame:
    """F8: per round — ``local_steps`` Newton steps at every site that the gate
    lets in (B15, F7), their average by size (D11), AUC on the holdout (B8,
    D6), one governance row.

    Scaling uses merged per-site moments (the same numbers as pooled rows).
    Site weights move in tables; only the global weights of a round (d + 1
    numbers) reach the driver.  Returns ``round_number, participating_sites,
    sites_declined`` (sorted lists), ``global_auc`` (0 where no site takes part
    or the holdout has one class), ``aggregation_method, privacy_mechanism,
    global_weights``.
    """
    from .federated import fedavg, site_gate
    d = len(features)
    stats = materialize(M.moments(df, features))
    z = M.standardize(df.select(site_col, label, *features), features, stats)
    zh = materialize(M.standardize(holdout.select(label, *features), features, stats))
    gate = materialize(site_gate(z, site_col, min_n))
    inside = gate.where("status = 'PARTICIPATING'").select(site_col, F.col("n_patients").alias("n"))
    rows = materialize(_site_rows(z.join(inside.select(site_col), site_col, "left_semi"), features, label, site_col))
    logs, w = [], [0.0] * (d + 1)
    for rnd in range(1, rounds + 1):
        state = inside.withColumn("w", F.array(*[F.lit(float(x)) for x in w]))
        for _ in range(local_steps):
            state = materialize(newton_step(rows, state, d, site_col))
        avg = fedavg(state.withColumnRenamed(site_col, "site_id"), "w", "n").first()
        if avg is None or not avg.w:  # no site passed the gate: nothing to average
            logs.append((rnd, 0.0, None))
            continue
        w = list(avg.w)
        score = F.round(M.linear_score(features, w[:-1], w[-1]), 9)
        auc = M.roc_auc(zh.select(F.col(label).alias("y"), score.alias("s")), "y", "s").first().auc
        logs.append((rnd, 0.0 if auc is None else round(auc, 4), w))
    sites = lambda status: F.coalesce(gate.where(F.col("status") == status).agg(
        F.array_sort(F.collect_list(F.col(site_col).cast("string")))).scalar(), F.expr("cast(array() as array<string>)"))
    return (df.sparkSession.createDataFrame(logs, "round_number int, global_auc double, global_weights array<double>")
            .select("round_number", sites("PARTICIPATING").alias("participating_sites"),
                    sites("DECLINED").alias("sites_declined"), "global_auc", F.lit("FedAvg").alias("aggregation_method"),
                    F.lit("none").alias("privacy_mechanism"), "global_weights"))


def governance_log(logs: DataFrame) -> DataFrame:
    """Per round the participating and the declined sites, their numbers,
    the global AUC and how the weights were combined."""
    return logs.select("round_number", "participating_sites", "sites_declined",
                       F.size("participating_sites").alias("n_participating"),
                       F.size("sites_declined").alias("n_declined"), "global_auc", "aggregation_method",
                       "privacy_mechanism")


def round_progress(logs: DataFrame) -> DataFrame:
    """AUC change per round and the best round (rounds are few)."""
    w = Window.orderBy("round_number")
    best = logs.agg(F.max_by("round_number", F.struct("global_auc", -F.col("round_number")))).scalar()
    return logs.select("round_number", "global_auc",
                       (F.col("global_auc") - F.lag("global_auc").over(w)).alias("auc_change"),
                       best.alias("best_round"))


def regulator_report(logs: DataFrame, regulator: str, privacy_guarantee: str = "none") -> DataFrame:
    """Aggregates only — site count, metrics, the caller's privacy statement and an
    audit hash of (metrics JSON ‖ round)."""
    metrics = F.to_json(F.struct(F.col("global_auc").alias("auc")))
    return logs.select(
        F.lit(regulator).alias("regulator"), F.col("round_number").alias("round"),
        F.size("participating_sites").alias("participating_sites"),
        F.lit("aggregate model metrics").alias("data_transmitted"),
        metrics.alias("metrics_visible_to_regulator"),
        F.lit(privacy_guarantee).alias("privacy_guarantee"),
        F.sha2(F.concat(metrics, F.col("round_number").cast("string")), 256).alias("audit_log_hash"))


# --------------------------------------------------------------------------
# F4 — membership-inference AUC
# --------------------------------------------------------------------------

def mia_auc(real: DataFrame, synth: DataFrame, features, id_col: str = "id", n_shadow: int | None = 200,
            seed: int = 42, folds: int = 5, n_trees: int = 50) -> DataFrame:
    """balanced real-vs-synthetic sample (≤ ``n_shadow`` rows each, the
    lowest by a keyed uniform, found without a sort), a random forest per cross-validation fold, mean held-out AUC.  0.5 means
    the synthetic rows cannot be told apart.  ``n_shadow=None`` uses every
    row of the smaller side."""
    from pyspark.ml.classification import RandomForestClassifier
    n = min(real.count(), synth.count())
    if n_shadow is not None:
        n = min(n, n_shadow)

    def sample(df, tag):
        picked = M.mark_lowest(df.select(id_col, *features), F.least(F.col("_rows"), F.lit(n)), seed, f"mia:{tag}", id_col, "_in")
        return picked.where("_in").drop("_in").withColumn("_member", F.lit(float(tag == "real")))
    both = sample(real, "real").unionByName(sample(synth, "synth"))
    both = both.withColumn("_fold", F.floor(keyed_uniform_col(seed, "mia:fold", id_col, "_member") * folds)
                           .cast("int")).cache()
    vec = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep")
    aucs = []
    for k in range(folds):
        train = vec.transform(both.where(F.col("_fold") != k))
        test = vec.transform(both.where(F.col("_fold") == k))
        rf = RandomForestClassifier(featuresCol="_x", labelCol="_member", numTrees=n_trees, seed=seed)
        pred = rf.fit(train).transform(test).select(F.col("_member").cast("int").alias("y"),
                                                    vector_to_array("probability")[1].alias("p"))
        a = M.roc_auc(pred, "y", "p").first().auc
        if a is not None:
            aucs.append(a)
    both.unpersist()
    spark = real.sparkSession
    return spark.createDataFrame([(float(np.mean(aucs)) if aucs else None, int(n), len(aucs))],
                                 "mia_auc double, n_per_side long, n_folds int")


def keyed_uniform_col(seed, stream, *ids):
    from ..functions.prf import keyed_uniform
    return keyed_uniform(seed, stream, *ids)
