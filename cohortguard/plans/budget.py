"""Privacy-budget plans: T2 ordered gate (E4, D21) and T3 allocation (E5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import budget as BG
from ..sources import bindings as B
from . import sqlfrag as S
from .registry import register

_T2_SRC = f"""
SELECT user_id AS budget_id, event_id AS op_id,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
       CAST(round(value * 1000) AS BIGINT) AS cost,
       CAST({B.BUDGET_TOTAL_MICRO} AS BIGINT) AS total
FROM events"""


def charged_ops(spark, sf_dir):
    return BG.consume_budget(B.budget_ops(spark, sf_dir), B.BUDGET_TOTAL_MICRO,
                             order=("ts", "op_id"))


_E4_SQL = f"""WITH RECURSIVE {S.skip_fold_sql(_T2_SRC)}
SELECT s.budget_id, s.op_id, s.cost AS epsilon_micro, f.admitted AS allowed,
       f.used_after AS cumulative_micro
FROM src s JOIN fold f ON s.budget_id = f.budget_id AND s.rn = f.rn"""


@register("e4_consume_budget", "E4", sql=_E4_SQL)
def e4_consume_budget(spark, sf_dir):
    return charged_ops(spark, sf_dir).select(
        "budget_id", "op_id", "epsilon_micro", "allowed", "cumulative_micro")


@register("e4_consume_budget_split", "E4", sql=_E4_SQL, bench=False)
def e4_consume_budget_split(spark, sf_dir):
    """E4 with every budget treated as hot: the prefix-sum rounds (and the
    fold for what they leave) must give the fold's answer."""
    return BG.consume_budget(B.budget_ops(spark, sf_dir), B.BUDGET_TOTAL_MICRO, order=("ts", "op_id"),
                             hot_rows=0).select(
        "budget_id", "op_id", "epsilon_micro", "allowed", "cumulative_micro")


@register("d21_budget_status", "D21", "E4", sql=f"""WITH RECURSIVE {S.skip_fold_sql(_T2_SRC)},
agg AS (
  SELECT s.budget_id, max(s.total) AS total_micro,
         CAST(sum(CASE WHEN f.admitted THEN s.cost ELSE 0 END) AS BIGINT) AS consumed_micro,
         CAST(sum(CASE WHEN f.admitted THEN 1 ELSE 0 END) AS BIGINT) AS n_allowed,
         CAST(sum(CASE WHEN f.admitted THEN 0 ELSE 1 END) AS BIGINT) AS n_blocked
  FROM src s JOIN fold f ON s.budget_id = f.budget_id AND s.rn = f.rn GROUP BY s.budget_id)
SELECT budget_id, total_micro, consumed_micro, n_allowed, n_blocked,
       greatest(total_micro - consumed_micro, 0) AS remaining_micro,
       CAST(consumed_micro AS DOUBLE) * 100.0::DOUBLE / CAST(total_micro AS DOUBLE) AS pct_consumed,
       consumed_micro >= total_micro AS exhausted,
       CASE WHEN consumed_micro >= total_micro THEN 'EXHAUSTED' ELSE 'ACTIVE' END AS status
FROM agg""")
def d21_budget_status(spark, sf_dir):
    return BG.budget_status(charged_ops(spark, sf_dir))


_T3_SRC = f"""
SELECT p_brand AS budget_id, p_partkey AS op_id, p_retailprice AS utility_value,
       CAST(1 + p_partkey % 3 AS INTEGER) AS priority_tier, p_partkey % 2 = 0 AS can_be_deferred,
       CAST(p_size AS BIGINT) * 1000000 AS cost,
       CAST({B.ALLOCATION_TOTAL_MICRO} AS BIGINT) AS total,
       row_number() OVER (PARTITION BY p_brand ORDER BY
           CASE WHEN 1 + p_partkey % 3 > 1 THEN 1 ELSE 0 END,
           CASE WHEN 1 + p_partkey % 3 > 1
                THEN -(p_retailprice / (CAST(p_size AS DOUBLE) * 1000000.0::DOUBLE)) ELSE 0.0 END,
           p_partkey) AS rn
FROM part"""


def allocated(spark, sf_dir):
    return BG.allocate_budget(B.allocation_ops(spark, sf_dir), B.ALLOCATION_TOTAL_MICRO)


_ALLOC_ROWS = f"""WITH RECURSIVE {S.skip_fold_sql(_T3_SRC, refuse_when_exhausted=False)},
rows AS (
  SELECT s.budget_id, s.op_id, s.cost AS epsilon_micro, s.utility_value, s.total,
         CASE WHEN f.admitted THEN 'ALLOCATED' WHEN s.can_be_deferred THEN 'DEFERRED'
              ELSE 'BLOCKED' END AS status,
         s.rn AS alloc_rank, s.total - f.used_after AS remaining_micro
  FROM src s JOIN fold f ON s.budget_id = f.budget_id AND s.rn = f.rn)"""


@register("e5_allocate_budget", "E5", sql=_ALLOC_ROWS + """
SELECT budget_id, op_id, epsilon_micro, status, alloc_rank, remaining_micro FROM rows""")
def e5_allocate_budget(spark, sf_dir):
    return allocated(spark, sf_dir).select(
        "budget_id", "op_id", "epsilon_micro", "status", "alloc_rank", "remaining_micro")


@register("e5_allocate_budget_split", "E5", sql=_ALLOC_ROWS + """
SELECT budget_id, op_id, epsilon_micro, status, alloc_rank, remaining_micro FROM rows""", bench=False)
def e5_allocate_budget_split(spark, sf_dir):
    """E5 with every budget treated as hot (two-phase split path)."""
    return BG.allocate_budget(B.allocation_ops(spark, sf_dir), B.ALLOCATION_TOTAL_MICRO, hot_rows=0).select(
        "budget_id", "op_id", "epsilon_micro", "status", "alloc_rank", "remaining_micro")


@register("e5_allocation_summary", "E5", sql=_ALLOC_ROWS + """
SELECT budget_id, max(total) AS total_micro,
       CAST(sum(CASE WHEN status = 'ALLOCATED' THEN epsilon_micro ELSE 0 END) AS BIGINT) AS used_micro,
       round(sum(CASE WHEN status = 'ALLOCATED' THEN utility_value ELSE 0.0 END), 2) AS utility_achieved,
       CAST(sum(CASE WHEN status = 'ALLOCATED' THEN 1 ELSE 0 END) AS BIGINT) AS n_allocated,
       CAST(sum(CASE WHEN status = 'DEFERRED' THEN 1 ELSE 0 END) AS BIGINT) AS n_deferred,
       CAST(sum(CASE WHEN status = 'BLOCKED' THEN 1 ELSE 0 END) AS BIGINT) AS n_blocked,
       round(CAST(sum(CASE WHEN status = 'ALLOCATED' THEN epsilon_micro ELSE 0 END) AS DOUBLE)
             * 100.0::DOUBLE / CAST(max(total) AS DOUBLE), 1) AS utilization_pct
FROM rows GROUP BY budget_id""")
def e5_allocation_summary(spark, sf_dir):
    return BG.allocation_summary(allocated(spark, sf_dir))
