"""Streaming plans: the events table replayed as a file stream.

Each plan runs its stream with ``trigger(availableNow=True)`` into Parquet
under the checkpoint folder and returns the written result; the SQL oracle
is the batch computation the stream must reproduce.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger as L
from ..sources import bindings as B
from ..streaming import operators as S
from ..streaming import runner as R
from . import budget as PB
from . import consent as PC
from .registry import _PLANS, register

WINDOW, DELAY_HOURS = "1 day", 1


def g1_stream_consent_status(spark, sf_dir):
    reqs = B.consent_requests_from(R.events_stream(spark, sf_dir))
    acc = L.validate_use_cases(reqs, B.use_case_registry(spark)).where("accepted")
    res = R.run_update(S.stream_consent_status(acc), "g1", ["patient_pseudonym", "use_case_id"])
    return res.select("patient_pseudonym", "use_case_id", "last_action", "consented", "n_actions")


register("g1_stream_consent_status", "G1", "E1", sql=_PLANS["e1_consent_status"].sql, bench=False)(g1_stream_consent_status)


GATE_SLICE_MS = 86_400_000


def g2_stream_budget_gate(spark, sf_dir):
    """Decisions of the slices that the watermark has closed."""
    ops = B.budget_ops_from(R.events_stream(spark, sf_dir))
    gate = S.stream_budget_gate(ops, B.BUDGET_TOTAL_MICRO, delay=f"{DELAY_HOURS} hour", slice_ms=GATE_SLICE_MS)
    return R.run_append(gate, "g2").select("budget_id", "op_id", "epsilon_micro", "allowed", "cumulative_micro")


register("g2_stream_budget_gate", "G2", "E4", sql=f"""
SELECT gate.* FROM ({_PLANS["e4_consume_budget"].sql}) gate JOIN events ON event_id = op_id
WHERE (epoch_ms(CAST(ts AS TIMESTAMP)) // {GATE_SLICE_MS} + 1) * {GATE_SLICE_MS}
      <= (SELECT epoch_ms(max(CAST(ts AS TIMESTAMP))) FROM events) - {DELAY_HOURS} * 3600000""",
         bench=False)(g2_stream_budget_gate)


@register("g3_stream_audit_counts", "G3", sql=f"""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       upper(event_type) AS event_type, count(*) AS n_events
FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL {DELAY_HOURS} HOUR
GROUP BY 1, 2, 3""", bench=False)
def g3_stream_audit_counts(spark, sf_dir):
    ev = B.audit_source_from(R.events_stream(spark, sf_dir))
    res = R.run_append(S.stream_audit_counts(ev, WINDOW, f"{DELAY_HOURS} hour"), "g3")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return res.select(F.date_format("window_start", fmt).alias("window_start"),
                      F.date_format("window_end", fmt).alias("window_end"), "event_type", "n_events")


del PB, PC  # imported so the batch plans are registered first
