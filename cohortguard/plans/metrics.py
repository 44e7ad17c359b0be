"""Privacy-risk, quality and fairness plans (T4 cohort, T5 QIs, T6 predictions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.noise import gaussian_noise, gaussian_noise_sql, gaussian_sigma
from ..functions.prf import keyed_uniform_sql
from ..operators import dp as DP
from ..operators import fairness as FA
from ..operators import metrics as M
from ..operators.common import materialize
from ..sources import bindings as B
from ..sources.tables import read
from .registry import register

QI = ("c_nationkey", "c_mktsegment")
K_TARGET = 11          # genomics-grade target; the standard target is 5
FEATURES = list(B.COHORT_FEATURES)
SCORE_WEIGHTS = (0.3, -0.1, 0.5, 0.2)
SCORE_BIAS = -1.2
NOISE_SEED = 7
NOISE_EPS = 4.0
SPLIT_SEED = 99
TRAIN_FRAC = 0.75
REF_MIA_AUC = 0.62     # membership-inference AUC fed to the re-identification score

_D = 6  # decimals for doubles whose last bits depend on summation order


# D1 / D2 ---------------------------------------------------------------------

@register("d1_k_anonymity", "D1", sql="""
SELECT min(class_size) AS k, count(*) AS n_classes, CAST(sum(class_size) AS BIGINT) AS n_rows
FROM (SELECT count(*) AS class_size FROM customer
      WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL
      GROUP BY c_nationkey, c_mktsegment)""")
def d1_k_anonymity(spark, sf_dir):
    return M.k_anonymity(read(spark, sf_dir, "customer", *QI), QI)


@register("d2_k_violations", "D2", sql=f"""
SELECT c_nationkey, c_mktsegment, count(*) AS class_size FROM customer
WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL
GROUP BY c_nationkey, c_mktsegment HAVING count(*) < {K_TARGET}""")
def d2_k_violations(spark, sf_dir):
    return M.k_violations(read(spark, sf_dir, "customer", *QI), QI, K_TARGET)


@register("d2_k_violation_summary", "D2", sql=f"""
SELECT CAST(sum(CASE WHEN class_size < {K_TARGET} THEN 1 ELSE 0 END) AS BIGINT) AS n_violating_classes,
       CAST(sum(CASE WHEN class_size < {K_TARGET} THEN class_size ELSE 0 END) AS BIGINT) AS n_rows_at_risk,
       CAST(sum(CASE WHEN class_size >= {K_TARGET} THEN class_size ELSE 0 END) AS BIGINT) AS n_rows_safe,
       {K_TARGET} AS k_target
FROM (SELECT count(*) AS class_size FROM customer
      WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY c_nationkey, c_mktsegment)""")
def d2_k_violation_summary(spark, sf_dir):
    return M.k_violation_summary(read(spark, sf_dir, "customer", *QI), QI, K_TARGET)


# B13 -------------------------------------------------------------------------

@register("b13_reidentification_risk", "B13", "D1", sql=f"""
SELECT c_nationkey, k,
       round(greatest(0.0::DOUBLE, ({REF_MIA_AUC}::DOUBLE - 0.5::DOUBLE) / 0.5::DOUBLE) * 60.0::DOUBLE
             + greatest(0.0::DOUBLE, 1.0::DOUBLE - least(CAST(k AS DOUBLE), 50.0::DOUBLE) / 50.0::DOUBLE)
               * 40.0::DOUBLE, 1) AS reid_risk
FROM (SELECT c_nationkey, min(n) AS k FROM
        (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer
         WHERE c_mktsegment IS NOT NULL GROUP BY 1, 2) GROUP BY c_nationkey)""")
def b13_reidentification_risk(spark, sf_dir):
    c = read(spark, sf_dir, "customer", *QI)
    per_nation = (M.equivalence_classes(c, QI).groupBy("c_nationkey")
                  .agg(F.min("class_size").alias("k")))
    return per_nation.select("c_nationkey", "k",
                             M.reidentification_risk(F.lit(REF_MIA_AUC), "k").alias("reid_risk"))


# D6 ----------------------------------------------------------------------------

_AUC_SQL = """
WITH per AS (
  SELECT {by_sel} CAST(mean_price AS DOUBLE) AS s, CAST(sum(label) AS BIGINT) AS pos,
         CAST(sum(1 - label) AS BIGINT) AS neg
  FROM {cohort} c GROUP BY {by_grp} mean_price),
pre AS (
  SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS nb FROM per)
SELECT {by_sel} CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
         sum(CAST(pos AS DOUBLE) * (CAST(nb AS DOUBLE) + CAST(neg AS DOUBLE) / 2.0::DOUBLE))
         / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM pre {group}"""


@register("d6_roc_auc", "D6", sql=_AUC_SQL.format(by_sel="", by_grp="", part="", group="",
                                                  cohort=B.COHORT_SQL))
def d6_roc_auc(spark, sf_dir):
    return M.roc_auc(B.customer_cohort(spark, sf_dir), "label", "mean_price")


@register("d6_roc_auc_by_segment", "D6", sql=_AUC_SQL.format(
    by_sel="c_mktsegment,", by_grp="c_mktsegment,", part="PARTITION BY c_mktsegment",
    group="GROUP BY c_mktsegment", cohort=B.COHORT_SQL))
def d6_roc_auc_by_segment(spark, sf_dir):
    return M.roc_auc(B.customer_cohort(spark, sf_dir), "label", "mean_price", by=["c_mktsegment"])


# B7 / B8 -------------------------------------------------------------------------

def _std_sql(c):
    return (f"(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 "
            f"OR stddev_pop({c}) OVER () IS NULL THEN 1.0 ELSE stddev_pop({c}) OVER () END)")


@register("b7_standardize", "B7", sql=f"""
SELECT id, label, {', '.join(f'round({_std_sql(c)}, {_D}) AS {c}' for c in FEATURES)}
FROM {B.COHORT_SQL} c""")
def b7_standardize(spark, sf_dir):
    z = M.standardize(B.customer_cohort(spark, sf_dir).select("id", "label", *FEATURES), FEATURES)
    return z.select("id", "label", *[F.round(c, _D).alias(c) for c in FEATURES])


def _score_sql():
    terms = " + ".join(f"{_std_sql(c)} * {w!r}::DOUBLE" for c, w in zip(FEATURES, SCORE_WEIGHTS))
    return f"({SCORE_BIAS!r}::DOUBLE + {terms})"


@register("b8_linear_score", "B8", "B7", sql=f"""
SELECT id, round({_score_sql()}, {_D}) AS score FROM {B.COHORT_SQL} c""")
def b8_linear_score(spark, sf_dir):
    z = M.standardize(B.customer_cohort(spark, sf_dir).select("id", *FEATURES), FEATURES)
    return z.select("id", F.round(M.linear_score(FEATURES, SCORE_WEIGHTS, SCORE_BIAS), _D).alias("score"))


_SCORE_NOISE_SIGMA = 0.001


@register("b8_score_error", "B8", sql=f"""
SELECT round(max(abs({_SCORE_NOISE_SIGMA!r}::DOUBLE * ({gaussian_noise_sql(1.0, NOISE_SEED, 'score', 'id')}))), {_D})
       AS max_error FROM {B.COHORT_SQL} c""")
def b8_score_error(spark, sf_dir):
    z = M.standardize(B.customer_cohort(spark, sf_dir).select("id", *FEATURES), FEATURES)
    s = z.select("id", M.linear_score(FEATURES, SCORE_WEIGHTS, SCORE_BIAS).alias("plain"))
    s = s.withColumn("approx", F.col("plain") + gaussian_noise(_SCORE_NOISE_SIGMA, NOISE_SEED, "score", "id"))
    return M.score_error(s, "plain", "approx").select(F.round("max_error", _D).alias("max_error"))


# D7 ----------------------------------------------------------------------------

def _noisy_cohort(spark, sf_dir):
    real = B.customer_cohort(spark, sf_dir)
    return real, DP.noise_features(real, FEATURES, NOISE_EPS, NOISE_SEED, "id")


def _noisy_sql():
    sigma = gaussian_sigma(1.0, NOISE_EPS)
    cols = ", ".join(f"{c} + {gaussian_noise_sql(sigma, NOISE_SEED, 'feat:' + c, 'id')} AS {c}"
                     for c in FEATURES)
    return f"(SELECT id, label, {cols} FROM {B.COHORT_SQL} c)"


def _fidelity_rows_sql():
    parts = []
    for c in FEATURES:
        parts.append(f"""SELECT '{c}' AS "column", (SELECT avg({c}) FROM {B.COHORT_SQL} r) AS real_mean,
               (SELECT stddev_samp({c}) FROM {B.COHORT_SQL} r) AS real_sd,
               (SELECT avg({c}) FROM {_noisy_sql()} s) AS synth_mean""")
    return " UNION ALL ".join(parts)


@register("d7_marginal_fidelity", "D7", "B5", sql=f"""
SELECT "column", round(real_mean, {_D}) AS real_mean, round(real_sd, {_D}) AS real_sd,
       round(synth_mean, {_D}) AS synth_mean,
       round(abs(real_mean - synth_mean) / (coalesce(real_sd, 0.0) + 1e-9::DOUBLE), {_D}) AS std_gap
FROM ({_fidelity_rows_sql()})""")
def d7_marginal_fidelity(spark, sf_dir):
    real, synth = _noisy_cohort(spark, sf_dir)
    f = M.marginal_fidelity(real, synth, FEATURES)
    return f.select("column", *[F.round(c, _D).alias(c) for c in ("real_mean", "real_sd", "synth_mean", "std_gap")])


@register("d7_fidelity_score", "D7", sql=f"""
SELECT round(greatest(0.0::DOUBLE, 100.0::DOUBLE - 50.0::DOUBLE * avg(abs(real_mean - synth_mean)
             / (coalesce(real_sd, 0.0) + 1e-9::DOUBLE))), 4) AS fidelity_score
FROM ({_fidelity_rows_sql()})""")
def d7_fidelity_score(spark, sf_dir):
    real, synth = _noisy_cohort(spark, sf_dir)
    return M.fidelity_score(M.marginal_fidelity(real, synth, FEATURES)).select(
        F.round("fidelity_score", 4).alias("fidelity_score"))


# B5 ----------------------------------------------------------------------------

@register("b5_noise_features", "B5", sql=f"""
SELECT id, label, {', '.join(f'round({c}, {_D}) AS {c}' for c in FEATURES)} FROM {_noisy_sql()}""")
def b5_noise_features(spark, sf_dir):
    _, synth = _noisy_cohort(spark, sf_dir)
    return synth.select("id", "label", *[F.round(c, _D).alias(c) for c in FEATURES])


# A10 ---------------------------------------------------------------------------

@register("a10_split_train_test", "A10", sql=f"""
SELECT id, label, rn <= round(CAST(n_class AS DOUBLE) * {TRAIN_FRAC}::DOUBLE) AS is_train FROM (
  SELECT id, label,
         row_number() OVER (PARTITION BY label ORDER BY
             {keyed_uniform_sql(SPLIT_SEED, 'split', 'id')}, id) AS rn,
         count(*) OVER (PARTITION BY label) AS n_class
  FROM {B.COHORT_SQL} c)""")
def a10_split_train_test(spark, sf_dir):
    s = M.split_train_test(materialize(B.customer_cohort(spark, sf_dir).select("id", "label")), "id",
                           TRAIN_FRAC, SPLIT_SEED, stratify="label")
    return s.select("id", "label", "is_train")


# D24 -----------------------------------------------------------------------------

def _profile_sql():
    c = B.COHORT_SQL
    parts = [f"SELECT 'rows' AS metric, '' AS \"column\", CAST(count(*) AS DOUBLE) AS value FROM {c} t",
             f"SELECT 'prevalence', 'label', avg(CAST(label AS DOUBLE)) FROM {c} t"]
    for f in FEATURES:
        parts += [f"SELECT 'nulls', '{f}', CAST(sum(CASE WHEN {f} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) FROM {c} t",
                  f"SELECT 'mean', '{f}', avg({f}) FROM {c} t",
                  f"SELECT 'std', '{f}', stddev_samp({f}) FROM {c} t",
                  f"SELECT 'min', '{f}', CAST(min({f}) AS DOUBLE) FROM {c} t",
                  f"SELECT 'max', '{f}', CAST(max({f}) AS DOUBLE) FROM {c} t"]
        # exact: at this size the sketch's rank error is below one row
        parts += [f"SELECT 'q{100 * q:g}', '{f}', CAST(quantile_disc({f}, {q}) AS DOUBLE) FROM {c} t" for q in M.QUANTILES]
    return " UNION ALL ".join(parts)


@register("d24_profile", "D24", sql=f"""
SELECT metric, "column", round(value, {_D}) AS value FROM ({_profile_sql()})""")
def d24_profile(spark, sf_dir):
    p = M.profile(B.customer_cohort(spark, sf_dir), FEATURES, label="label")
    return p.select("metric", "column", F.round("value", _D).alias("value"))


VALUE_COLUMNS = ("o_orderstatus", "o_orderpriority")


@register("d24_value_counts", "D24", sql=" UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n,
       count(*) / (SELECT count(*) FROM orders) AS share FROM orders GROUP BY {c}""" for c in VALUE_COLUMNS))
def d24_value_counts(spark, sf_dir):
    return M.value_counts(read(spark, sf_dir, "orders", *VALUE_COLUMNS), VALUE_COLUMNS)


# D3–D5 -------------------------------------------------------------------------

_T6 = """(SELECT l.doc_id AS id, CAST(l.quality AS INTEGER) AS y_true,
          CAST(d.n_chars > 1000 AS INTEGER) AS y_pred, d.lang AS sensitive
          FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

_RATES = f"""
SELECT sensitive, count(*) AS n, avg(CAST(y_pred AS DOUBLE)) AS positive_rate,
  CAST(sum(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS DOUBLE)
   / (CAST(sum(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS DOUBLE) + 1e-10::DOUBLE) AS tpr,
  CAST(sum(CASE WHEN y_true = 0 AND y_pred = 1 THEN 1 ELSE 0 END) AS DOUBLE)
   / (CAST(sum(CASE WHEN y_true = 0 THEN 1 ELSE 0 END) AS DOUBLE) + 1e-10::DOUBLE) AS fpr
FROM {_T6} t GROUP BY sensitive"""


@register("d3_group_rates", "D3", "D4", sql=_RATES)
def d3_group_rates(spark, sf_dir):
    return FA.group_rates(B.scored_documents(spark, sf_dir), "y_pred", "sensitive", "y_true")


@register("d3_demographic_parity", "D3", sql=f"""
SELECT max(positive_rate) - min(positive_rate) AS demographic_parity_difference,
       max(positive_rate) AS max_rate, min(positive_rate) AS min_rate, count(*) AS n_groups
FROM ({_RATES})""")
def d3_demographic_parity(spark, sf_dir):
    return FA.demographic_parity_difference(B.scored_documents(spark, sf_dir), "y_pred", "sensitive")


@register("d4_equalized_odds", "D4", sql=f"""
SELECT max(tpr) - min(tpr) AS tpr_difference, max(fpr) - min(fpr) AS fpr_difference, count(*) AS n_groups
FROM ({_RATES})""")
def d4_equalized_odds(spark, sf_dir):
    return FA.equalized_odds_difference(B.scored_documents(spark, sf_dir), "y_true", "y_pred", "sensitive")


@register("d5_disparate_impact", "D5", sql=f"""
SELECT min(positive_rate) / (max(positive_rate) + 1e-10::DOUBLE) AS disparate_impact_ratio,
       count(*) AS n_groups,
       min(positive_rate) / (max(positive_rate) + 1e-10::DOUBLE) >= 0.8::DOUBLE AS passes_four_fifths
FROM ({_RATES})""")
def d5_disparate_impact(spark, sf_dir):
    return FA.disparate_impact_ratio(B.scored_documents(spark, sf_dir), "y_pred", "sensitive")
