"""Synthetic-cohort plans (A1–A9): ids come from driver tables, so every
cohort grows with the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import synth as SY
from ..sources.tables import read
from .registry import register

SEED = 42


def _ids(spark, sf_dir, table, col):
    return read(spark, sf_dir, table, col).select(F.col(col).alias("id"))


def _preset(name, ops_ids, table, col, spec_fn):
    spec = spec_fn()
    ids_sql = f"SELECT {col} AS id FROM {table}"

    def plan(spark, sf_dir):
        return SY.synthesize(_ids(spark, sf_dir, table, col), spec, SEED)
    plan.__name__ = name
    register(name, "A1", *ops_ids, sql=SY.synthesize_sql(ids_sql, spec, SEED))(plan)


_preset("a2_ehr_readmission", ("A2",), "customer", "c_custkey", SY.ehr_readmission)
_preset("a3_adverse_event_reports", ("A3",), "orders", "o_orderkey", SY.adverse_event_reports)
_preset("a4_ehr_liver_risk", ("A4",), "customer", "c_custkey", SY.ehr_liver_risk)
_preset("a5_safety_cases", ("A5",), "orders", "o_orderkey", SY.safety_cases)
_preset("a6_liver_frame", ("A6",), "orders", "o_orderkey", SY.liver_frame)
_preset("a7_wide_47", ("A7",), "customer", "c_custkey", SY.wide_47)
_preset("a9_uniform_8", ("A9", "B8"), "part", "p_partkey", SY.uniform_8)


def _multi_site_sql():
    parts = ", ".join(SY.multi_site_sql_parts(SEED, "site_id", "id", "duckdb"))
    cols = ", ".join(["id", "site_id", "label"] + [f"f{i}" for i in range(8)])
    return (f"SELECT {cols} FROM (SELECT id, site_id, {parts} FROM "
            f"(SELECT c_custkey AS id, 'site_' || CAST(c_nationkey AS VARCHAR) AS site_id FROM customer) i) g")


@register("a8_multi_site", "A1", "A8", sql=_multi_site_sql())
def a8_multi_site(spark, sf_dir):
    c = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    ids = c.select(F.col("c_custkey").alias("id"),
                   F.concat(F.lit("site_"), F.col("c_nationkey").cast("string")).alias("site_id"))
    return SY.multi_site(ids, SEED)
