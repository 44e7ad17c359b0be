"""Audit-event plans (A11–A14) over the driver tables."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..sources import audit as AU
from ..sources import bindings as B
from ..streaming.runner import scratch_dir
from .consent import LATEST, accepted
from .registry import _PLANS, register
from ..operators import ledger as L
from ..functions.hashing import PSEUDONYM_SALT, pseudonymize
from ..sources.tables import read
from . import consent as PC

_AUC_BY_SEG = _PLANS["d6_roc_auc_by_segment"].sql


@register("a12_training_event", "A12", "D6", sql=f"""
SELECT 'cohort' AS context, 'MODEL_TRAINING' AS event_type, c_mktsegment,
       to_json({{'model': 'mean_price_score', 'n_samples': n_pos + n_neg, 'privacy_protected': true,
                'epsilon': 1.0::DOUBLE, 'metrics': {{'auc': round(auc, 4)}}}}) AS details
FROM ({_AUC_BY_SEG})""")
def a12_training_event(spark, sf_dir):
    auc = M.roc_auc(B.customer_cohort(spark, sf_dir), "label", "mean_price", by=["c_mktsegment"])
    ev = AU.training_event(auc, "mean_price_score", F.col("n_pos") + F.col("n_neg"), True, 1.0,
                           metrics=F.struct(F.round("auc", 4).alias("auc")), context="cohort")
    return ev.select("context", "event_type", "c_mktsegment", "details")


@register("a13_data_access_event", "A13", "C2", sql=f"""
SELECT 'orders' AS context, 'DATA_ACCESS' AS event_type, c_mktsegment,
       to_json({{'accessor': 'analytics', 'data_type': 'orders', 'purpose': 'UC0',
                'consent_verified': true, 'n_records': count(*)}}) AS details
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE substr(sha256('{PSEUDONYM_SALT}' || CAST(o_custkey AS VARCHAR)), 1, 16) IN ({PC._CONSENTED_UC0})
GROUP BY c_mktsegment""")
def a13_data_access_event(spark, sf_dir):
    o = read(spark, sf_dir, "orders", "o_custkey").withColumn("_p", pseudonymize("o_custkey"))
    gated = L.consented_rows(o, "_p", accepted(spark, sf_dir), "UC0", order=LATEST())
    c = read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    per = (gated.join(c, gated.o_custkey == c.c_custkey).groupBy("c_mktsegment")
           .agg(F.count(F.lit(1)).alias("n")))
    ev = AU.data_access_event(per, "analytics", "orders", "UC0", True, F.col("n"), context="orders")
    return ev.select("context", "event_type", "c_mktsegment", "details")


@register("a14_decision_event", "A14", sql=f"""
SELECT 'cohort' AS context, 'MODEL_DECISION' AS event_type, id,
       to_json({{'model': 'spend_rule', 'input_hash': sha256(CAST(id AS VARCHAR) || '|' || CAST(n_orders AS BIGINT)),
                'output': CASE WHEN n_orders >= 10 THEN 'HIGH' ELSE 'LOW' END,
                'confidence': round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(n_orders - 10.0::DOUBLE) / 2.0::DOUBLE)), 4),
                'human_override': false}}) AS details
FROM {B.COHORT_SQL} c""")
def a14_decision_event(spark, sf_dir):
    c = B.customer_cohort(spark, sf_dir).withColumn("n_orders_i", F.col("n_orders").cast("long"))
    conf = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("n_orders") - F.lit(10.0)) / F.lit(2.0)))
    ev = AU.decision_event(c, "spend_rule", ["id", "n_orders_i"],
                           F.when(F.col("n_orders") >= 10, "HIGH").otherwise("LOW"), conf, False,
                           context="cohort")
    return ev.select("context", "event_type", "id", "details")


@register("a11_audit_roundtrip", "A11", sql="""
SELECT 's' || CAST(user_id % 10 AS VARCHAR) AS session_id, upper(event_type) AS event_type,
       count(*) AS n_events, count(DISTINCT props) AS n_distinct_details
FROM events GROUP BY 1, 2""", bench=False)
def a11_audit_roundtrip(spark, sf_dir):
    path = os.path.join(scratch_dir(spark, "audit"), "log")
    AU.append_audit(B.audit_source(spark, sf_dir), path)
    back = AU.read_audit(spark, path)
    return back.groupBy("session_id", "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("details").alias("n_distinct_details"))
