"""Governance scoring: checklists, privacy ROI, minimization decisions,
impact-assessment summaries.

Checklists and advice are small dimension tables (see
:mod:`cohortguard.sources.fixtures`); projects and answers are the large
side.  Scores are two-level aggregations (question → principle → project);
groups are bounded by the checklist size, so per-project windows are cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import fixtures as FX
from .common import sized_broadcast, with_dimension


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------------------
# Scalar rules
# --------------------------------------------------------------------------

def letter_grade(score, bands=FX.CHECKLIST_GRADES, fail: str = "F") -> Column:
    """First band whose lower bound the score reaches, else ``fail``."""
    expr = None
    for lo, grade in bands:
        cond = _c(score) >= F.lit(float(lo))
        expr = F.when(cond, F.lit(grade)) if expr is None else expr.when(cond, F.lit(grade))
    return expr.otherwise(F.lit(fail))


def minimization_decision(delta, tier, tol: float) -> Column:
    """Remove when the AUC cost is below ``tol`` and the feature is an
    identifier; Review when below ``tol/2`` and benign; else Retain."""
    d, t = _c(delta), _c(tier)
    return (F.when((d < F.lit(tol)) & t.isin(FX.TIER_QUASI, FX.TIER_DIRECT), F.lit("Remove"))
            .when((d < F.lit(tol / 2.0)) & (t == F.lit(FX.TIER_BENIGN)), F.lit("Review"))
            .otherwise(F.lit("Retain")))


def normalize_criterion_id(col) -> Column:
    """B14: "1.2" → "P1-Q2"; ids containing "-" (or no ".") are unchanged."""
    c = _c(col)
    dotted = F.regexp_replace(c, r"^([^.]+)\.(.*)$", "P$1-Q$2")
    return F.when(c.contains("-"), c).when(c.contains("."), dotted).otherwise(c)


def privacy_roi(df: DataFrame) -> DataFrame:
    """ROI of a privacy investment per scenario row.

    fine = 4 % of revenue; risk avoided = fine × breach probability ×
    control effectiveness; ROI = (risk avoided + other returns) / investment
    (0 when the investment is not positive); INVEST above 1.0.
    """
    fine = F.col("annual_revenue_eur") * F.lit(FX.GDPR_FINE_RATE)
    risk = fine * (F.col("breach_probability_pct") / F.lit(100.0)) * F.col("control_effectiveness")
    total = risk + F.col("approval_value_eur") + F.col("trust_premium_eur") + F.col("regulatory_dividend_eur")
    roi = F.when(F.col("privacy_investment_eur") > 0,
                 total / F.col("privacy_investment_eur")).otherwise(F.lit(0.0))
    return (df.withColumn("gdpr_max_fine_eur", fine)
            .withColumn("risk_avoidance_value_eur", F.round(risk, 2))
            .withColumn("total_return_eur", F.round(total, 2))
            .withColumn("p_roi", F.round(roi, 2))
            .withColumn("recommendation", F.when(roi > F.lit(FX.ROI_INVEST_THRESHOLD), F.lit(FX.ROI_INVEST))
                        .otherwise(F.lit(FX.ROI_REVIEW))))


def roi_grid(scenarios: DataFrame, probabilities: Sequence[float],
             effectiveness: Sequence[float], key: str = "scenario") -> DataFrame:
    """Sensitivity sweep — every scenario × probability × effectiveness,
    then best and worst ROI per scenario.  The grid values are literal arrays
    exploded next to each scenario (a narrow projection)."""
    base = scenarios.drop("breach_probability_pct", "control_effectiveness")
    swept = privacy_roi(
        base.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
                    .alias("breach_probability_pct"))
        .select("*", F.explode(F.array(*[F.lit(float(e)) for e in effectiveness]))
                .alias("control_effectiveness")))
    return (swept.groupBy(key)
            .agg(F.max("p_roi").alias("best_p_roi"), F.min("p_roi").alias("worst_p_roi"),
                 F.max_by("breach_probability_pct", F.struct("p_roi", "breach_probability_pct"))
                 .alias("best_probability_pct"),
                 F.count(F.lit(1)).alias("n_cells"),
                 F.sum((F.col("recommendation") == F.lit(FX.ROI_INVEST)).cast("int")).cast("long")
                 .alias("n_invest")))


# --------------------------------------------------------------------------
# Checklist
# --------------------------------------------------------------------------

def apply_answers(projects: DataFrame, checklist: DataFrame, answers: DataFrame,
                  project_col: str = "project") -> DataFrame:
    """One row per (project, question) with its answer (null if none).

    ``answers``: ``project, question_ref, answer`` where ``question_ref`` is
    either "P1-Q2" or "1.2".  Unknown references are ignored.  The caller's
    reference is kept in ``criterion_ref`` (canonical id when unanswered).
    """
    grid = with_dimension(projects.select(project_col).distinct(), checklist)
    ans = answers.select(project_col, normalize_criterion_id("question_ref").alias("question_id"),
                         "question_ref", "answer")
    return (grid.join(ans, [project_col, "question_id"], "left")
            .withColumn("criterion_ref", F.coalesce("question_ref", "question_id"))
            .drop("question_ref"))


def principle_scores(applied: DataFrame, project_col: str = "project") -> DataFrame:
    """D16 (level 1): round(100 · Σ answer·weight, 1) per principle; null = 0."""
    return (applied.groupBy(project_col, "principle_id", "principle")
            .agg(F.round(F.sum(F.coalesce(F.col("answer"), F.lit(0.0)) * F.col("weight"))
                         * F.lit(100.0), 1).alias("principle_score")))


def checklist_scores(applied: DataFrame, project_col: str = "project") -> DataFrame:
    """total = round(mean of principle scores, 1); grade; passed ≥ 70."""
    ps = principle_scores(applied, project_col)
    return (ps.groupBy(project_col)
            .agg(F.round(F.sum("principle_score") / F.lit(float(len(FX.PRINCIPLES))), 1).alias("total_score"))
            .withColumn("grade", letter_grade("total_score"))
            .withColumn("passed", F.col("total_score") >= F.lit(FX.CHECKLIST_PASS)))


def weakest_principles(scores: DataFrame, k: int = 3, project_col: str = "project") -> DataFrame:
    """The ``k`` lowest principle scores per project (ties by principle order).

    The window is partitioned by project, whose group size is the number of
    principles (7) — bounded by the checklist, not by the data."""
    w = Window.partitionBy(project_col).orderBy("principle_score", "principle_id")
    return (scores.withColumn("weak_rank", F.row_number().over(w))
            .where(F.col("weak_rank") <= k))


def with_remediation(weak: DataFrame, advice: DataFrame) -> DataFrame:
    """Advice text per weak principle (default "Review.") formatted as
    "[score/100] principle: advice" with the score rounded half-to-even."""
    adv = sized_broadcast(advice)
    j = weak.join(adv, "principle", "left")
    text = F.format_string("[%d/100] %s: %s", F.bround("principle_score", 0).cast("long"),
                           F.col("principle"), F.coalesce("advice", F.lit(FX.DEFAULT_REMEDIATION)))
    return j.withColumn("remediation", text).drop("advice")


def criteria_pass_rate(applied: DataFrame, project_col: str = "project") -> DataFrame:
    """Weight of passed criteria / total weight.

    A criterion passes when its answer is truthy (non-zero; 0.5 passes); an
    unanswered criterion fails but its weight still counts.  PASS at ≥ 0.7;
    below that a DPO review is required.
    """
    passed = F.coalesce(F.col("answer") != 0, F.lit(False))
    score = (F.sum(F.when(passed, F.col("weight")).otherwise(F.lit(0.0)))
             / F.sum("weight"))
    return (applied.groupBy(project_col)
            .agg(score.alias("overall_score"),
                 F.sum((~passed).cast("int")).cast("long").alias("n_failed"))
            .withColumn("status", F.when(F.col("overall_score") >= F.lit(FX.CRITERIA_PASS), "PASS")
                        .otherwise("FAIL"))
            .withColumn("dpo_review_required", F.col("overall_score") < F.lit(FX.CRITERIA_PASS)))


def failed_criteria(applied: DataFrame, project_col: str = "project") -> DataFrame:
    """Criteria not passed (unanswered included), in the caller's id format."""
    passed = F.coalesce(F.col("answer") != 0, F.lit(False))
    return applied.where(~passed).select(project_col, "principle_id", "criterion_ref", "question_id")


def assessment_json(applied: DataFrame, project_col: str = "project") -> DataFrame:
    """One nested JSON document per project (principles → criteria).

    Two bounded collects: ≤ 4 criteria per principle, 7 principles per
    project — sizes fixed by the checklist.
    """
    passed = F.coalesce(F.col("answer") != 0, F.lit(False))
    per_p = (applied.groupBy(project_col, "principle_id", "principle")
             .agg(F.array_sort(F.collect_list(F.struct(
                 F.col("question_pos"), F.col("criterion_ref").alias("criterion_id"),
                 passed.alias("passed")))).alias("criteria"),
                  F.sum(F.when(passed, F.col("weight")).otherwise(0.0)).alias("_w_pass"),
                  F.sum("weight").alias("_w")))
    per_p = per_p.withColumn("criteria", F.transform(
        "criteria", lambda s: F.struct(s["criterion_id"].alias("criterion_id"), s["passed"].alias("passed"))))
    doc = (per_p.groupBy(project_col)
           .agg(F.array_sort(F.collect_list(F.struct("principle_id", F.col("principle").alias("name"),
                                                     "criteria"))).alias("principles"),
                (F.sum("_w_pass") / F.sum("_w")).alias("overall_score")))
    return doc.select(project_col, F.to_json(F.struct(
        F.col(project_col).cast("string").alias("project_name"), "overall_score", "principles"))
        .alias("assessment_json"))


# --------------------------------------------------------------------------
# Features (C4, E7, B12)
# --------------------------------------------------------------------------

def with_privacy_tier(features: DataFrame, tiers: DataFrame, feature_col: str = "feature") -> DataFrame:
    """C4: attach each feature's privacy tier (default Benign)."""
    t = sized_broadcast(tiers.select(F.col("feature").alias(feature_col), "tier"))
    return (features.join(t, feature_col, "left")
            .withColumn("privacy_risk_tier", F.coalesce("tier", F.lit(FX.TIER_BENIGN)))
            .drop("tier"))


def rank_features(results: DataFrame, importance: str = "importance",
                  pos: str = "feature_pos") -> DataFrame:
    """Order by ascending importance (ties by feature position)."""
    return results.orderBy(F.col(importance).asc(), F.col(pos).asc())


# --------------------------------------------------------------------------
# Impact assessment
# --------------------------------------------------------------------------

def top_threats(threats: DataFrame, levels: DataFrame) -> DataFrame:
    """Threats whose residual risk is Critical or High, with severity
    ordinal for ordering."""
    lv = sized_broadcast(levels)
    return (threats.where(F.col("residual_risk").isin("Critical", "High"))
            .join(lv, threats.residual_risk == lv.level, "left").drop("level"))


def legal_basis_gaps(assets: DataFrame, purposes: DataFrame, bases: DataFrame,
                     project_col: str = "project") -> DataFrame:
    """(asset, purpose) pairs of a project that lack a legal basis.

    Pairs are formed per project (equi-join on project, not a global
    cross product), then an anti-join removes the documented ones."""
    pairs = assets.select(project_col, "asset_name").join(
        purposes.select(project_col, "purpose_id"), project_col)
    return pairs.join(bases.select(project_col, "asset_name", "purpose_id"),
                      [project_col, "asset_name", "purpose_id"], "left_anti")


def impact_summary(assessments: DataFrame, assets: DataFrame, gaps: DataFrame,
                   conditions: DataFrame, threats: DataFrame, levels: DataFrame,
                   project_col: str = "project") -> DataFrame:
    """Per project — residual risk, approval, counts of conditions and
    control gaps, assets crossing borders, most severe residual threat.

    Each child table is aggregated on its own before the joins, so no join
    multiplies rows."""
    lv = sized_broadcast(levels)
    a = assets.groupBy(project_col).agg(
        F.count(F.lit(1)).alias("n_assets"),
        F.sum(F.col("cross_border_transfer").cast("int")).cast("long").alias("n_cross_border"))
    g = gaps.groupBy(project_col).agg(F.count(F.lit(1)).alias("control_gaps_count"))
    c = conditions.groupBy(project_col).agg(F.count(F.lit(1)).alias("conditions_count"))
    t = (threats.join(lv, threats.residual_risk == lv.level, "left")
         .groupBy(project_col).agg(F.min("severity").alias("_sev")))
    out = (assessments.select(project_col, "overall_residual_risk", "approved_for_deployment")
           .join(a, project_col, "left").join(g, project_col, "left")
           .join(c, project_col, "left").join(t, project_col, "left")
           .join(lv.withColumnRenamed("level", "max_threat_level").withColumnRenamed("severity", "_sev"),
                 "_sev", "left"))
    return (out.fillna(0, ["n_assets", "n_cross_border", "control_gaps_count", "conditions_count"])
            .drop("_sev"))
