"""SQL functions for SQL users: B1, B9 and B13 as ``CREATE TEMPORARY FUNCTION``.

They are SQL-bodied functions, so the analyzer inlines their expressions
into the calling query: no Python, no serialization, and the calls stay
inside whole-stage codegen.  Each has the same formula as its DataFrame
counterpart (``hashing.pseudonymize``, ``governance.privacy_roi``,
``metrics.reidentification_risk``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources import fixtures as FX
from .hashing import PSEUDONYM_SALT


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the session's temporary functions; returns their names."""
    stmts = {
        "cg_pseudonymize": f"""
            (id STRING, salt STRING DEFAULT '{PSEUDONYM_SALT}') RETURNS STRING
            RETURN substr(sha2(concat(salt, id), 256), 1, 16)""",
        # unrounded ROI; recommendation is ROI > threshold
        "cg_privacy_roi": f"""
            (annual_revenue_eur DOUBLE, breach_probability_pct DOUBLE, control_effectiveness DOUBLE,
             approval_value_eur DOUBLE, trust_premium_eur DOUBLE, regulatory_dividend_eur DOUBLE,
             privacy_investment_eur DOUBLE) RETURNS DOUBLE
            RETURN CASE WHEN privacy_investment_eur > 0
                THEN (annual_revenue_eur * {FX.GDPR_FINE_RATE!r}D * (breach_probability_pct / 100.0D)
                      * control_effectiveness + approval_value_eur + trust_premium_eur
                      + regulatory_dividend_eur) / privacy_investment_eur
                ELSE 0.0D END""",
        "cg_reidentification_risk": """
            (mia_auc DOUBLE, k BIGINT, max_k INT DEFAULT 50) RETURNS DOUBLE
            RETURN round(greatest(0.0D, (mia_auc - 0.5D) / 0.5D) * 60.0D
                         + greatest(0.0D, 1.0D - least(CAST(k AS DOUBLE), CAST(max_k AS DOUBLE))
                                          / CAST(max_k AS DOUBLE)) * 40.0D, 1)""",
    }
    for name, body in stmts.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(stmts)
