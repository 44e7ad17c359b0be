"""Governance plans: checklist scoring (T10), ROI (T11), feature
minimization on the cohort (T4), impact assessments (T13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import governance as G
from ..operators import metrics as M
from ..operators.common import materialize
from ..sources import bindings as B
from ..sources import fixtures as FX
from .registry import register

_D = 6

# ---------------------------------------------------------------------------
# SQL building blocks
# ---------------------------------------------------------------------------
_CL = FX.checklist_sql()

_ANSWERS = f"""
SELECT s_suppkey AS project,
       CASE WHEN s_suppkey % 2 = 0 THEN checklist.question_id
            ELSE CAST(checklist.principle_id AS VARCHAR) || '.' || regexp_extract(checklist.question_id, 'Q(\\d+)$', 1)
       END AS question_ref,
       CAST((s_suppkey * 7 + checklist.question_pos) % 3 AS DOUBLE) / 2.0::DOUBLE AS answer
FROM supplier CROSS JOIN {_CL}
WHERE (s_suppkey + checklist.question_pos) % 11 <> 0"""


def _norm_sql(ref: str) -> str:
    return (f"CASE WHEN contains({ref}, '-') THEN {ref} "
            f"WHEN contains({ref}, '.') THEN regexp_replace({ref}, '^([^.]+)\\.(.*)$', 'P\\1-Q\\2') "
            f"ELSE {ref} END")


_APPLIED = f"""
SELECT p.project, checklist.principle_id, checklist.principle, checklist.question_id,
       checklist.question_pos, checklist.weight, a.answer,
       coalesce(a.question_ref, checklist.question_id) AS criterion_ref
FROM (SELECT DISTINCT s_suppkey AS project FROM supplier) p CROSS JOIN {_CL}
LEFT JOIN (SELECT project, {_norm_sql('question_ref')} AS qid, question_ref, answer FROM ({_ANSWERS})) a
  ON a.project = p.project AND a.qid = checklist.question_id"""

_PSCORES = f"""
SELECT project, principle_id, principle,
       round(sum(coalesce(answer, 0.0::DOUBLE) * weight) * 100.0::DOUBLE, 1) AS principle_score
FROM ({_APPLIED}) GROUP BY project, principle_id, principle"""


def _grade_sql(x: str) -> str:
    whens = " ".join(f"WHEN {x} >= {lo!r}::DOUBLE THEN '{g}'" for lo, g in FX.CHECKLIST_GRADES)
    return f"CASE {whens} ELSE 'F' END"


def applied(spark, sf_dir):
    return G.apply_answers(B.checklist_projects(spark, sf_dir), FX.checklist(spark),
                           B.checklist_answers(spark, sf_dir))


# C3 --------------------------------------------------------------------------

@register("c3_apply_answers", "C3", "B14", sql=f"""
SELECT project, question_id, criterion_ref, answer FROM ({_APPLIED})""")
def c3_apply_answers(spark, sf_dir):
    return applied(spark, sf_dir).select("project", "question_id", "criterion_ref", "answer")


# D16 -------------------------------------------------------------------------

@register("d16_principle_scores", "D16", sql=_PSCORES)
def d16_principle_scores(spark, sf_dir):
    return G.principle_scores(applied(spark, sf_dir))


@register("d16_checklist_scores", "D16", "B11", sql=f"""
SELECT project, total, {_grade_sql('total')} AS grade, total >= {FX.CHECKLIST_PASS!r}::DOUBLE AS passed
FROM (SELECT project, round(sum(principle_score) / {float(len(FX.PRINCIPLES))!r}::DOUBLE, 1) AS total
      FROM ({_PSCORES}) GROUP BY project)""".replace("SELECT project, total,", "SELECT project, total AS total_score,"))
def d16_checklist_scores(spark, sf_dir):
    return G.checklist_scores(applied(spark, sf_dir))


# E6 + C5 ---------------------------------------------------------------------

@register("e6_weakest_principles", "E6", "C5", sql=f"""
SELECT w.project, w.principle_id, w.principle, w.principle_score, w.weak_rank,
       '[' || CAST(CAST(round_even(w.principle_score, 0) AS BIGINT) AS VARCHAR) || '/100] '
         || w.principle || ': ' || coalesce(remediation.advice, '{FX.DEFAULT_REMEDIATION}') AS remediation
FROM (SELECT *, row_number() OVER (PARTITION BY project ORDER BY principle_score, principle_id) AS weak_rank
      FROM ({_PSCORES})) w
LEFT JOIN {FX.remediation_sql()} ON remediation.principle = w.principle
WHERE w.weak_rank <= 3""")
def e6_weakest_principles(spark, sf_dir):
    weak = G.weakest_principles(G.principle_scores(applied(spark, sf_dir)), 3)
    return G.with_remediation(weak, FX.remediation(spark)).select(
        "project", "principle_id", "principle", "principle_score", "weak_rank", "remediation")


# D17 / D18 / D19 -------------------------------------------------------------

@register("d17_criteria_pass_rate", "D17", "B14", sql=f"""
SELECT project, round(overall, {_D}) AS overall_score, n_failed,
       CASE WHEN overall >= {FX.CRITERIA_PASS!r}::DOUBLE THEN 'PASS' ELSE 'FAIL' END AS status,
       overall < {FX.CRITERIA_PASS!r}::DOUBLE AS dpo_review_required
FROM (SELECT project,
             sum(CASE WHEN coalesce(answer <> 0, false) THEN weight ELSE 0.0::DOUBLE END) / sum(weight) AS overall,
             CAST(sum(CASE WHEN coalesce(answer <> 0, false) THEN 0 ELSE 1 END) AS BIGINT) AS n_failed
      FROM ({_APPLIED}) GROUP BY project)""")
def d17_criteria_pass_rate(spark, sf_dir):
    r = G.criteria_pass_rate(applied(spark, sf_dir))
    return r.select("project", F.round("overall_score", _D).alias("overall_score"), "n_failed",
                    "status", "dpo_review_required")


@register("d18_failed_criteria", "D18", sql=f"""
SELECT project, principle_id, criterion_ref, question_id FROM ({_APPLIED})
WHERE NOT coalesce(answer <> 0, false)""")
def d18_failed_criteria(spark, sf_dir):
    return G.failed_criteria(applied(spark, sf_dir))


@register("d19_assessment_json", "D19")
def d19_assessment_json(spark, sf_dir):
    return G.assessment_json(applied(spark, sf_dir))


# B9 / B10 ----------------------------------------------------------------------

_SCEN = """
SELECT n_name AS scenario, rev AS annual_revenue_eur, 8.0::DOUBLE AS breach_probability_pct,
       rev * 0.0015::DOUBLE AS privacy_investment_eur, rev * 0.001::DOUBLE AS approval_value_eur,
       rev * 0.0008::DOUBLE AS trust_premium_eur, rev * 0.0005::DOUBLE AS regulatory_dividend_eur,
       0.75::DOUBLE AS control_effectiveness
FROM (SELECT c_nationkey, round(sum(o_totalprice), 2) AS rev
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey) r
JOIN nation ON n_nationkey = r.c_nationkey"""


def _roi_cols_sql(src: str) -> str:
    fine = f"annual_revenue_eur * {FX.GDPR_FINE_RATE!r}::DOUBLE"
    risk = f"(({fine}) * (breach_probability_pct / 100.0::DOUBLE) * control_effectiveness)"
    total = f"({risk} + approval_value_eur + trust_premium_eur + regulatory_dividend_eur)"
    roi = f"(CASE WHEN privacy_investment_eur > 0 THEN {total} / privacy_investment_eur ELSE 0.0::DOUBLE END)"
    return f"""SELECT *, {fine} AS gdpr_max_fine_eur, round({risk}, 2) AS risk_avoidance_value_eur,
           round({total}, 2) AS total_return_eur, round({roi}, 2) AS p_roi,
           CASE WHEN {roi} > {FX.ROI_INVEST_THRESHOLD!r}::DOUBLE THEN '{FX.ROI_INVEST}'
                ELSE '{FX.ROI_REVIEW}' END AS recommendation
    FROM ({src})"""


def scenarios(spark, sf_dir):
    s = B.nation_scenarios(spark, sf_dir)
    return s.withColumn("annual_revenue_eur", F.round("annual_revenue_eur", 2)).select(
        "scenario", "annual_revenue_eur", "breach_probability_pct",
        (F.col("annual_revenue_eur") * 0.0015).alias("privacy_investment_eur"),
        (F.col("annual_revenue_eur") * 0.001).alias("approval_value_eur"),
        (F.col("annual_revenue_eur") * 0.0008).alias("trust_premium_eur"),
        (F.col("annual_revenue_eur") * 0.0005).alias("regulatory_dividend_eur"),
        "control_effectiveness")


@register("b9_privacy_roi", "B9", sql=f"""
SELECT scenario, gdpr_max_fine_eur, risk_avoidance_value_eur, total_return_eur, p_roi, recommendation
FROM ({_roi_cols_sql(_SCEN)})""")
def b9_privacy_roi(spark, sf_dir):
    return G.privacy_roi(scenarios(spark, sf_dir)).select(
        "scenario", "gdpr_max_fine_eur", "risk_avoidance_value_eur", "total_return_eur", "p_roi",
        "recommendation")


ROI_PROBABILITIES = (2.0, 4.0, 8.0, 12.0)
ROI_EFFECTIVENESS = (0.5, 0.75, 0.9)


def _grid_sql():
    vals = ", ".join(f"({p!r}::DOUBLE, {e!r}::DOUBLE)" for p in ROI_PROBABILITIES for e in ROI_EFFECTIVENESS)
    base = _SCEN.replace("8.0::DOUBLE AS breach_probability_pct,", "").replace(
        "0.75::DOUBLE AS control_effectiveness", "1 AS _one")
    return f"""SELECT b.* EXCLUDE (_one), g.breach_probability_pct, g.control_effectiveness
               FROM ({base}) b CROSS JOIN (VALUES {vals}) AS g(breach_probability_pct, control_effectiveness)"""


@register("b10_roi_grid", "B10", "B9", sql=f"""
WITH swept AS ({_roi_cols_sql(_grid_sql())}),
best AS (SELECT scenario, max(p_roi) AS best_p_roi FROM swept GROUP BY scenario)
SELECT s.scenario, max(p_roi) AS best_p_roi, min(p_roi) AS worst_p_roi,
       max(CASE WHEN s.p_roi = b.best_p_roi THEN breach_probability_pct END) AS best_probability_pct,
       count(*) AS n_cells,
       CAST(sum(CASE WHEN recommendation = '{FX.ROI_INVEST}' THEN 1 ELSE 0 END) AS BIGINT) AS n_invest
FROM swept s JOIN best b ON s.scenario = b.scenario GROUP BY s.scenario""")
def b10_roi_grid(spark, sf_dir):
    return G.roi_grid(scenarios(spark, sf_dir), ROI_PROBABILITIES, ROI_EFFECTIVENESS)


# B12 / C4 / E7 — leave-one-out minimization on the linear cohort score --------

FEATURE_TIERS = (("acctbal", FX.TIER_QUASI), ("span_days", FX.TIER_QUASI))
MIN_WEIGHTS = (0.3, -0.1, 0.5, 0.2)
MIN_TOL = 0.02


def feature_minimization(spark, sf_dir):
    """Importance = |w|·E|z − E z| (linear attribution); AUC cost of dropping
    each feature from the linear score; tier join; decision; rank."""
    feats = list(B.COHORT_FEATURES)
    coh = B.customer_cohort(spark, sf_dir).select("id", "label", *feats)
    z = materialize(M.standardize(coh, feats).select("id", "label", *[F.round(c, _D).alias(c) for c in feats]))
    variants = [F.struct(F.lit("__full__").alias("variant"),
                         M.linear_score(feats, MIN_WEIGHTS).alias("score"))]
    for f in feats:
        keep = [(c, w) for c, w in zip(feats, MIN_WEIGHTS) if c != f]
        variants.append(F.struct(F.lit(f).alias("variant"),
                                 M.linear_score([c for c, _ in keep], [w for _, w in keep]).alias("score")))
    long = z.select("label", F.explode(F.array(*variants)).alias("v")).select("label", "v.variant", "v.score")
    aucs = M.roc_auc(long, "label", "score", by=["variant"])
    full = aucs.where(F.col("variant") == "__full__").select("auc").scalar()
    drop = aucs.where(F.col("variant") != "__full__").select(F.col("variant").alias("feature"),
                                                              F.col("auc").alias("auc_without_feature"))
    dev = z.agg(*[F.avg(F.abs(F.col(c) - z.agg(F.avg(c)).scalar())).alias(c) for c in feats])
    pairs = ", ".join(f"'{c}', {i}, {abs(w)!r}D * `{c}`" for i, (c, w) in enumerate(zip(feats, MIN_WEIGHTS)))
    imp = dev.selectExpr(f"stack({len(feats)}, {pairs}) AS (feature, feature_pos, importance)")
    tiers = spark.createDataFrame(list(FEATURE_TIERS), "feature string, tier string")
    res = (G.with_privacy_tier(imp.join(drop, "feature"), tiers)
           .withColumn("auc_delta", F.round(full - F.col("auc_without_feature"), _D))
           .withColumn("recommendation", G.minimization_decision("auc_delta", "privacy_risk_tier", MIN_TOL)))
    from pyspark.sql import Window
    w = Window.orderBy("importance", "feature_pos")  # one row per feature: bounded
    return res.select("feature", F.round("importance", _D).alias("importance"),
                      F.round("auc_without_feature", _D).alias("auc_without_feature"), "auc_delta",
                      "privacy_risk_tier", "recommendation",
                      F.row_number().over(w).alias("importance_rank"))


def _minimization_sql():
    feats = list(B.COHORT_FEATURES)
    std = ", ".join(
        f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1.0 "
        f"ELSE stddev_pop({c}) OVER () END, {_D}) AS {c}" for c in feats)
    z = f"(SELECT id, label, {std} FROM {B.COHORT_SQL} c)"

    def score(cols):
        s = "0.0::DOUBLE"
        for c, w in cols:
            s = f"({s} + {c} * {w!r}::DOUBLE)"
        return s
    parts = [f"SELECT '__full__' AS variant, label, {score(list(zip(feats, MIN_WEIGHTS)))} AS s FROM z"]
    for f in feats:
        keep = [(c, w) for c, w in zip(feats, MIN_WEIGHTS) if c != f]
        parts.append(f"SELECT '{f}', label, {score(keep)} FROM z")
    long = " UNION ALL ".join(parts)
    dev = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {i} AS feature_pos, {abs(w)!r}::DOUBLE * avg(abs({c} - (SELECT avg({c}) FROM z))) "
        f"AS importance FROM z" for i, (c, w) in enumerate(zip(feats, MIN_WEIGHTS)))
    tiers = ", ".join(f"('{f}', '{t}')" for f, t in FEATURE_TIERS)
    return f"""
WITH z AS {z},
long AS ({long}),
per AS (SELECT variant, s, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
        FROM long GROUP BY variant, s),
pre AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY variant ORDER BY s
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM per),
auc AS (SELECT variant, sum(CAST(pos AS DOUBLE) * (CAST(nb AS DOUBLE) + CAST(neg AS DOUBLE) / 2.0::DOUBLE))
               / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc FROM pre GROUP BY variant),
imp AS ({dev}),
res AS (
  SELECT imp.feature, imp.feature_pos, imp.importance, a.auc AS auc_without_feature,
         coalesce(t.tier, '{FX.TIER_BENIGN}') AS privacy_risk_tier,
         round((SELECT auc FROM auc WHERE variant = '__full__') - a.auc, {_D}) AS auc_delta
  FROM imp JOIN auc a ON a.variant = imp.feature
  LEFT JOIN (VALUES {tiers}) AS t(feature, tier) ON t.feature = imp.feature)
SELECT feature, round(importance, {_D}) AS importance, round(auc_without_feature, {_D}) AS auc_without_feature,
       auc_delta, privacy_risk_tier,
       CASE WHEN auc_delta < {MIN_TOL!r}::DOUBLE AND privacy_risk_tier IN ('{FX.TIER_QUASI}', '{FX.TIER_DIRECT}')
            THEN 'Remove'
            WHEN auc_delta < {MIN_TOL / 2!r}::DOUBLE AND privacy_risk_tier = '{FX.TIER_BENIGN}' THEN 'Review'
            ELSE 'Retain' END AS recommendation,
       row_number() OVER (ORDER BY importance, feature_pos) AS importance_rank
FROM res"""


register("b12_feature_minimization", "B12", "C4", sql=_minimization_sql())(feature_minimization)


# B16 / C6 / D20 — impact assessments -------------------------------------------

def _lvl(idx: str) -> str:
    arr = "[" + ", ".join(f"'{x}'" for x in FX.RISK_LEVELS) + "]"
    return f"{arr}[{idx} + 1]"


_THREATS = f"""
SELECT s_suppkey AS project, j,
       {"[" + ", ".join(f"'{t}'" for t in FX.STRIDE_THREATS) + "]"}[(s_suppkey + j) % 6 + 1] AS threat,
       {_lvl('(s_suppkey + 2 * j) % 5')} AS residual_risk
FROM supplier CROSS JOIN (VALUES (0), (1), (2)) AS jj(j)"""


@register("b16_top_threats", "B16", sql=f"""
SELECT t.project, t.j, t.threat, t.residual_risk, risk_levels.severity
FROM ({_THREATS}) t LEFT JOIN {FX.risk_levels_sql()} ON risk_levels.level = t.residual_risk
WHERE t.residual_risk IN ('Critical', 'High')""")
def b16_top_threats(spark, sf_dir):
    return G.top_threats(B.assessment_threats(spark, sf_dir), FX.risk_levels(spark))


@register("c6_legal_basis_gaps", "C6", sql=f"""
WITH d AS (SELECT * FROM {B.DELIVERIES_SQL} t)
SELECT a.project, a.asset_name, p.purpose_id
FROM (SELECT DISTINCT project, asset_name FROM d) a JOIN (SELECT DISTINCT project, purpose_id FROM d) p
  ON a.project = p.project
WHERE NOT EXISTS (SELECT 1 FROM d WHERE NOT d.returned AND d.project = a.project AND d.asset_name = a.asset_name
                  AND d.purpose_id = p.purpose_id)""")
def c6_legal_basis_gaps(spark, sf_dir):
    return G.legal_basis_gaps(B.assessment_assets(spark, sf_dir), B.assessment_purposes(spark, sf_dir),
                              B.assessment_bases(spark, sf_dir))


@register("d20_impact_summary", "D20", sql=f"""
WITH a AS (SELECT s_suppkey AS project, {_lvl('s_suppkey % 4')} AS overall_residual_risk FROM supplier),
th AS (SELECT t.project, min(risk_levels.severity) AS sev FROM ({_THREATS}) t
       LEFT JOIN {FX.risk_levels_sql()} ON risk_levels.level = t.residual_risk GROUP BY t.project)
SELECT a.project, a.overall_residual_risk,
       a.overall_residual_risk IN ('Medium', 'Low') AS approved_for_deployment,
       coalesce(ass.n_assets, 0) AS n_assets, CAST(coalesce(ass.n_cross_border, 0) AS BIGINT) AS n_cross_border,
       CAST(1 + a.project % 3 AS BIGINT) AS control_gaps_count,
       CAST(CASE WHEN a.overall_residual_risk IN ('Medium', 'Low') THEN 0 ELSE 3 END AS BIGINT) AS conditions_count,
       lv.level AS max_threat_level
FROM a JOIN th ON th.project = a.project
LEFT JOIN (SELECT project, count(*) AS n_assets, sum(CAST(abroad AS BIGINT)) AS n_cross_border FROM (
             SELECT project, asset_name, bool_or(abroad) AS abroad FROM {B.DELIVERIES_SQL} t GROUP BY project, asset_name)
           GROUP BY project) ass ON ass.project = a.project
LEFT JOIN {FX.risk_levels_sql().replace('risk_levels', 'lv')} ON lv.severity = th.sev""")
def d20_impact_summary(spark, sf_dir):
    return G.impact_summary(B.assessments(spark, sf_dir), B.assessment_assets(spark, sf_dir),
                            B.assessment_gaps(spark, sf_dir), B.assessment_conditions(spark, sf_dir),
                            B.assessment_threats(spark, sf_dir), FX.risk_levels(spark))
