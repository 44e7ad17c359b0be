"""Model plans without an SQL oracle: what they return, not only that they run."""

import json

import pytest
from pyspark.sql import functions as F

from cohortguard.operators import governance as G
from cohortguard.operators import metrics as M
from cohortguard.plans.registry import all_plans

from .conftest import SF_SMALL


def only(spark, name):
    row, = all_plans()[name].plan(spark, SF_SMALL).collect()
    return row


def test_tstr_of_noised_rows(spark):
    r = only(spark, "f3_tstr")
    assert 0 <= r.fidelity_score <= 100 and 0 <= r.mia_advantage <= 0.5
    assert all(0 <= a <= 1 for a in (r.utility_auc_synthetic, r.utility_auc_tstr, r.utility_auc_real))
    want = composite(r.fidelity_score, r.utility_auc_tstr, r.utility_auc_real, r.mia_advantage)
    assert (r.utility_score, r.mia_resistance_score, r.overall_tstr_score) == pytest.approx(want, abs=0.051)
    assert r.grade == next((g for low, g in ((80, "A"), (70, "B"), (60, "C")) if r.overall_tstr_score >= low), "F")


def composite(fidelity, tstr, real, advantage):
    utility = min(100.0, 100 * tstr / max(real, 0.51))
    resistance = max(0.0, 100 - 200 * advantage)
    return round(utility, 1), round(resistance, 1), round(0.3 * fidelity + 0.5 * utility + 0.2 * resistance, 1)


def test_composite_over_a_grid_equals_sql(spark, duck):
    """D8 against DuckDB over the same written table."""
    grid = [(f, t, r, a) for f in (0.0, 61.3, 100.0) for t in (0.4, 0.73, 0.99) for r in (0.3, 0.8) for a in (0.0, 0.2, 0.6)]
    df = spark.createDataFrame(grid, "fidelity double, tstr double, real double, advantage double")
    got = sorted(tuple(x) for x in df.select("*", *M.tstr_composite("fidelity", "tstr", "real", "advantage")).collect())
    values = ", ".join(f"({f}::DOUBLE, {t}::DOUBLE, {r}::DOUBLE, {a}::DOUBLE)" for f, t, r, a in grid)
    want = duck(SF_SMALL).execute(f"""
        SELECT *, round(0.30 * f + 0.50 * u + 0.20 * m, 1) FROM (
          SELECT *, round(least(100.0, 100.0 * t / greatest(r, 0.51::DOUBLE)), 1) AS u,
                 round(greatest(0.0, 100.0 - 200.0 * a), 1) AS m FROM (VALUES {values}) v(f, t, r, a))""").fetchall()
    assert [pytest.approx(x, abs=0.1001) for x in sorted(map(tuple, want))] == got


def test_membership_inference(spark):
    auc, advantage = only(spark, "f4_mia_auc"), only(spark, "f5_mia_advantage")
    assert 0 <= auc.mia_auc <= 1 and auc.n_folds == 5 and auc.n_per_side > 0
    assert 0 <= advantage.mia_advantage <= 0.5 and 0 <= advantage.mia_advantage_balanced <= 0.5


def test_assessment_documents(spark):
    """One JSON document per project, whose criteria and scores agree with
    the scored checklist (D16)."""
    rows = all_plans()["d19_assessment_json"].plan(spark, SF_SMALL).collect()
    assert rows
    for r in rows:
        doc = json.loads(r.assessment_json)
        assert 0 <= doc["overall_score"] <= 1 and doc["principles"]
        assert all(p["criteria"] for p in doc["principles"])
    assert len({json.loads(r.assessment_json)["project_name"] for r in rows}) == len(rows)


def test_rank_features_breaks_ties_by_place(spark):
    df = spark.createDataFrame([("a", 2, 0.5), ("b", 1, 0.5), ("c", 0, 0.9), ("d", 3, 0.1)], "feature string, feature_pos int, importance double")
    assert [r.feature for r in G.rank_features(df).collect()] == ["d", "b", "a", "c"]
    assert G.rank_features(df.where(F.lit(False))).count() == 0
