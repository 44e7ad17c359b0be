"""B1, B9 and B13 written as Spark SQL with the library's SQL functions.

Same results (and the same DuckDB oracles) as the DataFrame plans of the
same operators; the inputs are the driver tables, bound as query arguments.
"""

from __future__ import annotations

from ..functions.sqlfunctions import register_sql_functions
from ..sources.tables import read
from . import consent  # noqa: F401  (registers the B1 plan whose SQL is reused)
from . import governance as PG
from . import metrics as PM
from .registry import _PLANS, register


def _sql_of(name: str) -> str:
    return _PLANS[name].sql


@register("b1_pseudonymize_sql", "B1", sql=_sql_of("b1_pseudonymize_customers"))
def b1_pseudonymize_sql(spark, sf_dir):
    register_sql_functions(spark)
    return spark.sql("SELECT c_custkey, cg_pseudonymize(CAST(c_custkey AS STRING)) AS pseudonym FROM {c}",
                     c=read(spark, sf_dir, "customer", "c_custkey"))


@register("b9_privacy_roi_sql", "B9", sql=f"""
SELECT scenario, p_roi, recommendation FROM ({PG._roi_cols_sql(PG._SCEN)})""")
def b9_privacy_roi_sql(spark, sf_dir):
    register_sql_functions(spark)
    from ..sources import fixtures as FX
    return spark.sql(f"""
        SELECT scenario, round(roi, 2) AS p_roi,
               CASE WHEN roi > {FX.ROI_INVEST_THRESHOLD!r}D THEN '{FX.ROI_INVEST}'
                    ELSE '{FX.ROI_REVIEW}' END AS recommendation
        FROM (SELECT scenario,
                     cg_privacy_roi(annual_revenue_eur, breach_probability_pct, control_effectiveness,
                                    approval_value_eur, trust_premium_eur, regulatory_dividend_eur,
                                    privacy_investment_eur) AS roi
              FROM {{s}})""", s=PG.scenarios(spark, sf_dir))


@register("b13_reidentification_risk_sql", "B13", "D1", sql=_sql_of("b13_reidentification_risk"))
def b13_reidentification_risk_sql(spark, sf_dir):
    register_sql_functions(spark)
    return spark.sql(f"""
        SELECT c_nationkey, k, cg_reidentification_risk({PM.REF_MIA_AUC!r}D, k) AS reid_risk
        FROM (SELECT c_nationkey, min(n) AS k
              FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM {{c}}
                    WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL
                    GROUP BY c_nationkey, c_mktsegment)
              GROUP BY c_nationkey)""", c=read(spark, sf_dir, "customer", *PM.QI))

