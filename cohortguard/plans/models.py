"""Model-job plans.

F1, F2, F6 and F8 have SQL oracles that train the same models in recursive queries
(:mod:`.fitsql`).  The other fits are statistical (MLlib), without oracle;
tests check ranges, orderings and invariants instead.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.noise import flip_probability, gaussian_noise_sql, gaussian_sigma
from ..functions.prf import keyed_uniform, keyed_uniform_sql
from ..operators import dp as DP
from ..operators import metrics as M
from ..operators import models as ML
from ..operators.common import materialize
from ..sources import bindings as B
from ..sources import fixtures as FX
from . import fitsql as Q
from .registry import register

FEATS = list(B.COHORT_FEATURES)
SEED = 99


def _cohort(spark, sf_dir):
    return materialize(B.customer_cohort(spark, sf_dir).select("id", "label", *FEATS))


TRAIN_FRAC = 0.75
F1_TOTAL, F1_EPOCH, F1_EPOCHS, F1_CLIP, F1_RATE = 2_000_000, 500_000, 5, 1.0, 2.0
D = len(FEATS)

# the stratified split (A10), scaled by the training rows' moments
_SPLIT = f"""
    split AS MATERIALIZED (
      SELECT *, rn <= round(CAST(n_class AS DOUBLE) * {TRAIN_FRAC}::DOUBLE) AS is_train FROM (
        SELECT id, label, {', '.join(FEATS)},
               row_number() OVER (PARTITION BY label ORDER BY {keyed_uniform_sql(SEED, 'split', 'id')}, id) AS rn,
               count(*) OVER (PARTITION BY label) AS n_class
        FROM {B.COHORT_SQL} c)),
    z AS MATERIALIZED ({Q.scaled_sql('split', FEATS, 'id, label, is_train', 'is_train')})"""


def _f1_sql() -> str:
    epochs = F1_TOTAL // F1_EPOCH  # the gate refuses the next
    sigma = gaussian_sigma(F1_CLIP, F1_EPOCH / 1e6)
    noise = lambda k, i: gaussian_noise_sql(sigma, "dpsgd", "gradient", k, str(i))
    rows = "tr AS (SELECT label AS y, " + ", ".join(f"x{i}" for i in range(D + 1)) + " FROM z WHERE is_train)"
    return f"""WITH RECURSIVE {_SPLIT}, {rows}, {Q.descent_ctes('tr', D, epochs, F1_CLIP, F1_RATE, noise)},
    final AS (SELECT * FROM descent WHERE k = {epochs}),
    scores AS (SELECT 0 AS model, label, {Q.score_sql(D)} AS s FROM z CROSS JOIN final WHERE NOT is_train),
    {Q.auc_ctes('scores', 'model')}
    SELECT {epochs} AS epochs_completed, round(auc, 4) AS auc, {epochs >= F1_EPOCHS} AS budget_maintained,
           CAST({epochs * F1_EPOCH} AS BIGINT) AS consumed_micro, CAST({F1_TOTAL} AS BIGINT) AS total_micro,
           round({sigma!r}::DOUBLE, 6) AS noise_sigma, {', '.join(f'round(b{i}, 6) AS w{i}' for i in range(D + 1))}
    FROM final, auc"""


@register("f1_train_with_budget", "F1", "E4", sql=_f1_sql(), bench=False)
def f1_train_with_budget(spark, sf_dir):
    s = M.split_train_test(_cohort(spark, sf_dir), "id", TRAIN_FRAC, SEED, stratify="label")
    out = ML.train_with_budget(s.where("is_train"), s.where("not is_train"), FEATS, "label", total_micro=F1_TOTAL,
                               epsilon_per_epoch_micro=F1_EPOCH, n_epochs=F1_EPOCHS, clip=F1_CLIP, rate=F1_RATE)
    return out.select("epochs_completed", "auc", "budget_maintained", "consumed_micro", "total_micro",
                      F.round("noise_sigma", 6).alias("noise_sigma"),
                      *[F.round(F.col("weights")[i], 6).alias(f"w{i}") for i in range(D + 1)])


def _f2_sql(runs: int = 5) -> str:
    grid = [(0, None, None)] + [(1 + k, e, r) for k, (e, r) in enumerate((e, r) for e in ML.EPSILONS for r in range(runs))]
    values = ", ".join(f"({m}, {'NULL' if e is None else repr(e)}::DOUBLE, {'NULL' if r is None else r}, "
                       f"{0.0 if e is None else flip_probability(e)!r}::DOUBLE)" for m, e, r in grid)
    draws = ", ".join(f"{keyed_uniform_sql(f'{SEED}:{r}', 'flip', 'id')} AS u{r}" for r in range(runs))
    u = "CASE run " + " ".join(f"WHEN {r} THEN u{r}" for r in range(runs)) + " END"
    xs = ", ".join(f"x{i}" for i in range(D + 1))
    return f"""WITH RECURSIVE {_SPLIT},
    grid(model, epsilon, run, p) AS (VALUES {values}),
    tr AS MATERIALIZED (
      SELECT model, {xs}, CASE WHEN {u} < p THEN 1 - label ELSE label END AS y, 1.0::DOUBLE AS w
      FROM (SELECT *, {draws} FROM z WHERE is_train) CROSS JOIN grid),
    {Q.newton_ctes('tr', D)},
    scores AS (SELECT model, label, {Q.score_sql(D)} AS s FROM z CROSS JOIN coef WHERE NOT is_train),
    {Q.auc_ctes('scores', 'model')},
    runs AS (SELECT epsilon, run, auc FROM grid LEFT JOIN auc ON auc.model = grid.model),
    summary AS (
      SELECT epsilon, round(avg(auc), 4) AS mean_auc, round(stddev_pop(auc), 4) AS std_auc,
             (SELECT auc FROM runs WHERE epsilon IS NULL) AS baseline
      FROM runs WHERE epsilon IS NOT NULL GROUP BY epsilon)
    SELECT epsilon, mean_auc, std_auc, round(baseline, 6) AS baseline_auc,
           CASE WHEN baseline > 0 THEN round(100.0::DOUBLE * mean_auc / baseline, 1) ELSE 0.0 END AS auc_retention_pct
    FROM summary"""


@register("f2_privacy_utility_curve", "F2", "D22", "B6", "A10", sql=_f2_sql(), bench=False)
def f2_privacy_utility_curve(spark, sf_dir):
    curve = ML.privacy_utility_curve(_cohort(spark, sf_dir), FEATS, "label", "id", seed=SEED)
    return curve.withColumn("baseline_auc", F.round("baseline_auc", 6))


# age-like and activity-span features are quasi-identifiers, the balance a direct one
F6_TIERS = (("acctbal", FX.TIER_DIRECT), ("span_days", FX.TIER_QUASI))
F6_TOLERANCE, F6_FOLDS, F6_SEED = 0.02, 5, 42


def _f6_sql() -> str:
    models = [(v, k) for v in range(D + 1) for k in range(F6_FOLDS)] + [(0, -1)]
    values = ", ".join(f"({m}, {v}, {k})" for m, (v, k) in enumerate(models))
    xs = ", ".join(f"CASE WHEN variant = {i + 1} THEN 0.0 ELSE x{i} END AS x{i}" for i in range(D)) + f", x{D}"
    tiers = ", ".join(f"('{f}', '{t}')" for f, t in F6_TIERS)
    worth = " UNION ALL ".join(f"SELECT {i} AS feature_pos, '{f}' AS feature, abs(b{i}) * (SELECT avg(abs(x{i})) FROM z) "
                               f"AS importance FROM coef WHERE model = {len(models) - 1}" for i, f in enumerate(FEATS))
    return f"""WITH RECURSIVE
    placed AS MATERIALIZED (
      SELECT id, label, {', '.join(FEATS)},
             (row_number() OVER (PARTITION BY label ORDER BY {keyed_uniform_sql(F6_SEED, 'fold', 'id')}, id) - 1)
             % {F6_FOLDS} AS fold
      FROM {B.COHORT_SQL} c),
    z AS MATERIALIZED ({Q.scaled_sql('placed', FEATS, 'id, label, fold')}),
    models(model, variant, held) AS (VALUES {values}),
    tr AS MATERIALIZED (SELECT model, {xs}, label AS y, 1.0::DOUBLE AS w FROM z CROSS JOIN models WHERE fold <> held),
    {Q.newton_ctes('tr', D)},
    scores AS (SELECT model, label, {Q.score_sql(D)} AS s
               FROM z JOIN models ON fold = held JOIN coef USING (model)),
    {Q.auc_ctes('scores', 'model')},
    variants AS (SELECT variant, avg(auc) AS auc FROM auc JOIN models USING (model) GROUP BY variant),
    worth AS ({worth}),
    found AS (
      SELECT worth.feature, feature_pos, round(importance, 4) AS importance, round(v.auc, 4) AS auc_without_feature,
             round((SELECT auc FROM variants WHERE variant = 0) - v.auc, 4) + 0.0::DOUBLE AS auc_delta,
             coalesce(t.tier, '{FX.TIER_BENIGN}') AS privacy_risk_tier
      FROM worth JOIN variants v ON v.variant = feature_pos + 1
      LEFT JOIN (VALUES {tiers}) AS t(feature, tier) ON t.feature = worth.feature)
    SELECT *, CASE WHEN auc_delta < {F6_TOLERANCE}::DOUBLE AND privacy_risk_tier IN ('{FX.TIER_QUASI}', '{FX.TIER_DIRECT}')
                   THEN 'Remove'
                   WHEN auc_delta < {F6_TOLERANCE / 2}::DOUBLE AND privacy_risk_tier = '{FX.TIER_BENIGN}' THEN 'Review'
                   ELSE 'Retain' END AS recommendation
    FROM found"""


@register("f6_feature_minimization", "F6", "B12", "C4", "E7", sql=_f6_sql(), bench=False)
def f6_feature_minimization(spark, sf_dir):
    tiers = spark.createDataFrame(list(F6_TIERS), "feature string, tier string")
    return ML.feature_minimization(_cohort(spark, sf_dir), FEATS, "label", "id", tiers, F6_TOLERANCE, F6_FOLDS, F6_SEED)


def _real_synth(spark, sf_dir):
    real = _cohort(spark, sf_dir)
    synth = DP.noise_features(real, FEATS, 4.0, 7, "id")
    return real, synth


@register("f3_tstr", "F3", "D7", "D8", bench=False)
def f3_tstr(spark, sf_dir):
    real, synth = _real_synth(spark, sf_dir)
    return ML.tstr(real, synth, FEATS, "label", "id")


@register("f5_mia_advantage", "F5", bench=False)
def f5_mia_advantage(spark, sf_dir):
    real, synth = _real_synth(spark, sf_dir)
    return ML.mia_advantage(real, synth, FEATS)


# F8: customers with orders, by nation; nations with fewer training rows than this decline
FL_MIN, FL_ROUNDS, FL_STEPS, FL_HOLDOUT = 45, 5, 2, 0.2


def _fl_log(spark, sf_dir):
    data = materialize(B.customer_cohort(spark, sf_dir).select(
        "id", "label", *FEATS, F.concat(F.lit("site_"), F.col("c_nationkey").cast("string")).alias("site_id"),
        keyed_uniform(SEED, "holdout", "id").alias("_u")))
    return ML.federated_train(data.where(f"_u >= {FL_HOLDOUT}"), data.where(f"_u < {FL_HOLDOUT}"), FEATS, "label",
                              rounds=FL_ROUNDS, min_n=FL_MIN, local_steps=FL_STEPS)


def _fl_sql(select: str) -> str:
    """``select`` over ``logs(round_number, global_auc, b0 .., participating,
    declined)``, the last two as lists."""
    xs = ", ".join(f"x{i}" for i in range(D + 1))
    return f"""WITH RECURSIVE
    data AS MATERIALIZED (
      SELECT id, label, {', '.join(FEATS)}, 'site_' || CAST(c_nationkey AS VARCHAR) AS site,
             {keyed_uniform_sql(SEED, 'holdout', 'id')} < {FL_HOLDOUT}::DOUBLE AS held FROM {B.COHORT_SQL} c),
    z AS MATERIALIZED ({Q.scaled_sql('data', FEATS, 'id, label, site, held', 'NOT held')}),
    gate AS (SELECT site, count(*) AS n FROM z WHERE NOT held GROUP BY site),
    tr AS MATERIALIZED (SELECT site, {xs}, label AS y, 1.0::DOUBLE AS w FROM z JOIN gate USING (site)
                        WHERE NOT held AND n >= {FL_MIN}),
    {Q.federated_ctes('tr', D, FL_ROUNDS, FL_STEPS)},
    scores AS (SELECT round, label, {Q.score_sql(D)} AS s FROM z CROSS JOIN globals WHERE held),
    {Q.auc_ctes('scores', 'round')},
    logs AS (
      SELECT CAST(r AS INTEGER) AS round_number, round(coalesce(auc, 0.0), 4) AS global_auc, g.* EXCLUDE (round),
             (SELECT coalesce(list(site ORDER BY site), []) FROM gate WHERE n >= {FL_MIN}) AS participating,
             (SELECT coalesce(list(site ORDER BY site), []) FROM gate WHERE n < {FL_MIN}) AS declined
      FROM range(1, {FL_ROUNDS + 1}) t(r) LEFT JOIN globals g ON g.round = r LEFT JOIN auc ON auc.round = r)
    {select}"""


_LISTS = ("array_to_string(participating, ',') AS participating_sites, array_to_string(declined, ',') AS sites_declined")


def _joined(df):
    """Site lists as text."""
    return df.withColumns({c: F.array_join(c, ",") for c in ("participating_sites", "sites_declined")})


@register("f8_federated_train", "F8", "F7", "B15", "D11", bench=False, sql=_fl_sql(
    f"SELECT round_number, {_LISTS}, global_auc, 'FedAvg' AS aggregation_method, 'none' AS privacy_mechanism, "
    f"{', '.join(f'round(b{i}, 6) AS w{i}' for i in range(D + 1))} FROM logs"))
def f8_federated_train(spark, sf_dir):
    return _joined(_fl_log(spark, sf_dir)).select(
        "round_number", "participating_sites", "sites_declined", "global_auc", "aggregation_method", "privacy_mechanism",
        *[F.round(F.col("global_weights")[i], 6).alias(f"w{i}") for i in range(D + 1)])


@register("d25_governance_log", "D25", "F8", bench=False, sql=_fl_sql(
    f"SELECT round_number, {_LISTS}, CAST(len(participating) AS INTEGER) AS n_participating, "
    f"CAST(len(declined) AS INTEGER) AS n_declined, global_auc, 'FedAvg' AS aggregation_method, "
    f"'none' AS privacy_mechanism FROM logs"))
def d25_governance_log(spark, sf_dir):
    return _joined(ML.governance_log(_fl_log(spark, sf_dir)))


@register("e8_round_progress", "E8", "F8", bench=False, sql=_fl_sql(
    "SELECT round_number, global_auc, global_auc - lag(global_auc) OVER (ORDER BY round_number) AS auc_change, "
    "first_value(round_number) OVER (ORDER BY global_auc DESC, round_number) AS best_round FROM logs"))
def e8_round_progress(spark, sf_dir):
    return ML.round_progress(_fl_log(spark, sf_dir))


@register("d23_regulator_report", "D23", "F8", bench=False, sql=_fl_sql(
    """SELECT 'regulator' AS regulator, round_number AS round,
       CAST(len(participating) AS INTEGER) AS participating_sites, 'aggregate model metrics' AS data_transmitted,
       metrics AS metrics_visible_to_regulator, 'none' AS privacy_guarantee,
       sha256(metrics || CAST(round_number AS VARCHAR)) AS audit_log_hash
       FROM (SELECT *, CAST(to_json({'auc': global_auc}) AS VARCHAR) AS metrics FROM logs)"""))
def d23_regulator_report(spark, sf_dir):
    return ML.regulator_report(_fl_log(spark, sf_dir), "regulator")


@register("f4_mia_auc", "F4", bench=False)
def f4_mia_auc(spark, sf_dir):
    real, synth = _real_synth(spark, sf_dir)
    return ML.mia_auc(real, synth, FEATS, "id", n_shadow=200, seed=SEED)
