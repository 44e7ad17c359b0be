"""Consent-ledger plans (T1 binding) and the flagship consented DP release."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import PSEUDONYM_SALT, pseudonymize
from ..functions.noise import laplace_noise_sql, laplace_scale
from ..operators import budget as BG
from ..operators import dp as DP
from ..operators import ledger as L
from ..operators.common import materialize
from ..sources import bindings as B
from ..sources.tables import read
from . import sqlfrag as S
from .registry import register

def LATEST():
    return F.struct("timestamp", "request_seq")


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.validate_use_cases(B.consent_requests(spark, sf_dir), B.use_case_registry(spark))


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(spark, sf_dir).where("accepted")


def built_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.append_records(accepted(spark, sf_dir), order=("timestamp", "request_seq"))


# C1 --------------------------------------------------------------------------

@register("c1_validate_use_cases", "C1", sql=f"""
SELECT record_id, patient_pseudonym, use_case_id, action, use_case_description, accepted, reject_reason
FROM ({S.validated_sql()}) v""")
def c1_validate_use_cases(spark, sf_dir):
    return validated(spark, sf_dir).select(
        "record_id", "patient_pseudonym", "use_case_id", "action",
        "use_case_description", "accepted", "reject_reason")


# B1 --------------------------------------------------------------------------

@register("b1_pseudonymize_customers", "B1", sql=f"""
SELECT c_custkey, substr(sha256('{PSEUDONYM_SALT}' || CAST(c_custkey AS VARCHAR)), 1, 16) AS pseudonym
FROM customer""")
def b1_pseudonymize_customers(spark, sf_dir):
    c = read(spark, sf_dir, "customer", "c_custkey")
    return c.select("c_custkey", pseudonymize("c_custkey").alias("pseudonym"))


# E1 --------------------------------------------------------------------------

@register("e1_consent_status", "E1", sql=f"""
SELECT patient_pseudonym, use_case_id, action AS last_action, action = 'GRANT' AS consented, n_actions
FROM (
  SELECT patient_pseudonym, use_case_id, action,
         row_number() OVER (PARTITION BY patient_pseudonym, use_case_id
                            ORDER BY "timestamp" DESC, request_seq DESC) AS rn,
         count(*) OVER (PARTITION BY patient_pseudonym, use_case_id) AS n_actions
  FROM ({S.validated_sql()}) v WHERE accepted) t
WHERE rn = 1""")
def e1_consent_status(spark, sf_dir):
    return L.consent_status(accepted(spark, sf_dir), order=LATEST())


# C2 --------------------------------------------------------------------------

_CONSENTED_UC0 = f"""
SELECT patient_pseudonym FROM (
  SELECT patient_pseudonym, use_case_id, action,
         row_number() OVER (PARTITION BY patient_pseudonym, use_case_id
                            ORDER BY "timestamp" DESC, request_seq DESC) AS rn
  FROM ({S.validated_sql()}) v WHERE accepted) t
WHERE rn = 1 AND use_case_id = 'UC0' AND action = 'GRANT'"""


@register("c2_consented_orders", "C2", "B1", sql=f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE substr(sha256('{PSEUDONYM_SALT}' || CAST(o_custkey AS VARCHAR)), 1, 16) IN ({_CONSENTED_UC0})""")
def c2_consented_orders(spark, sf_dir):
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    o = o.withColumn("_pseud", pseudonymize("o_custkey"))
    return L.consented_rows(o, "_pseud", accepted(spark, sf_dir), "UC0", order=LATEST()).drop("_pseud")


# E3 / B2 ---------------------------------------------------------------------

@register("e3_append_records", "E3", "B2", sql=S.ledger_sql().replace(
    'a."timestamp", a.version, a.use_case_description,', ''))
def e3_append_records(spark, sf_dir):
    return built_ledger(spark, sf_dir).select(
        "ledger_id", "seq", "record_id", "patient_pseudonym", "use_case_id", "action",
        "previous_record_hash", "record_hash")


# E2 --------------------------------------------------------------------------

@register("e2_verify_chain", "E2", sql=f"""WITH RECURSIVE {S.chain_ctes()},
ledger AS (SELECT a.*, c.previous_record_hash, c.record_hash
           FROM acc a JOIN chain c ON a.ledger_id = c.ledger_id AND a.seq = c.seq),
checked AS (
  SELECT l.ledger_id, l.seq,
         coalesce(l.previous_record_hash =
                  CASE WHEN l.seq = 1 THEN '{S.GENESIS_HASH}' ELSE p.record_hash END, false) AS link_ok,
         l.record_hash = sha256({S._payload('l', 'l.previous_record_hash')}) AS hash_ok
  FROM ledger l LEFT JOIN ledger p ON p.ledger_id = l.ledger_id AND p.seq + 1 = l.seq)
SELECT ledger_id, count(*) AS n_records,
       CAST(sum(CASE WHEN NOT link_ok THEN 1 ELSE 0 END) AS BIGINT) AS n_broken_links,
       CAST(sum(CASE WHEN NOT hash_ok THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_hashes,
       min(CASE WHEN NOT (link_ok AND hash_ok) THEN seq END) AS first_bad_seq,
       min(CASE WHEN NOT (link_ok AND hash_ok) THEN seq END) IS NULL AS intact
FROM checked GROUP BY ledger_id""")
def e2_verify_chain(spark, sf_dir):
    # The ledger is a stored table in production; materialise the freshly
    # built chain so the join's two sides do not each re-run the fold.
    return L.verify_chain(materialize(built_ledger(spark, sf_dir)))


# A15 -------------------------------------------------------------------------

@register("a15_export_audit_trail", "A15", sql=f"""WITH RECURSIVE {S.chain_ctes()}
SELECT a.record_id, a.patient_pseudonym, a.use_case_id, a.action,
       strftime(a."timestamp", '{S.ISO_MICROS_DUCKDB}') AS "timestamp", a.version, c.record_hash
FROM acc a JOIN chain c ON a.ledger_id = c.ledger_id AND a.seq = c.seq""")
def a15_export_audit_trail(spark, sf_dir):
    return L.export_audit_trail(built_ledger(spark, sf_dir))


# Flagship: consented, budget-gated DP mean order value per segment -----------

FLAGSHIP_SEED = 20240101
FLAGSHIP_EPS = 1.0                 # per released segment (split count/sum)
FLAGSHIP_TOTAL_MICRO = 4_000_000   # 4 ε for the whole release
PRICE_LOWER, PRICE_UPPER = 0.0, 500_000.0
# a customer lies in one segment; ten of their orders count
FLAGSHIP_SUBJECT = DP.SubjectBound("o_custkey", "o_orderkey", max_groups=1, max_rows=10)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 → C1 → E1 → C2 → D9 (keyed Laplace) → E4 charge → D21 columns.

    Mean order value per market segment over consenting customers only,
    released with ε = 1 per segment and customer against a 4 ε budget; a release the
    budget refuses is suppressed (null values).
    """
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    c = read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    gated = L.consented_rows(o.withColumn("_pseud", pseudonymize("o_custkey")), "_pseud",
                             accepted(spark, sf_dir), "UC0", order=LATEST())
    rows = gated.join(c, gated.o_custkey == c.c_custkey).select("c_mktsegment", "o_custkey", "o_orderkey",
                                                                             "o_totalprice")
    release = DP.dp_mean(rows, ["c_mktsegment"], "o_totalprice", PRICE_LOWER, PRICE_UPPER,
                         FLAGSHIP_EPS, FLAGSHIP_SEED, stream="flagship", subject=FLAGSHIP_SUBJECT)
    ops = release.select(F.lit("flagship").alias("budget_id"), "c_mktsegment",
                         F.lit(int(FLAGSHIP_EPS * BG.MICRO)).cast("long").alias("epsilon_micro"),
                         "dp_count", "dp_mean")
    charged = BG.consume_budget(ops, FLAGSHIP_TOTAL_MICRO, order=("c_mktsegment",), num_partitions=1)
    return charged.select(
        "c_mktsegment", "epsilon_micro", "allowed", "cumulative_micro",
        (F.col("total_micro") - F.col("cumulative_micro")).alias("remaining_micro"),
        F.when(F.col("allowed"), F.col("dp_count")).alias("dp_count"),
        F.when(F.col("allowed"), F.col("dp_mean")).alias("dp_mean"))


def _flagship_sql() -> str:
    half = FLAGSHIP_EPS / 2.0
    n_noise = laplace_noise_sql(laplace_scale(FLAGSHIP_SUBJECT.sensitivity(1.0, "laplace"), half), FLAGSHIP_SEED, "flagship:n", "c_mktsegment")
    sens = FLAGSHIP_SUBJECT.sensitivity(max(abs(PRICE_LOWER), abs(PRICE_UPPER)), "laplace")
    s_noise = laplace_noise_sql(laplace_scale(sens, half), FLAGSHIP_SEED, "flagship:s", "c_mktsegment")
    cost = int(FLAGSHIP_EPS * BG.MICRO)
    return f"""WITH RECURSIVE
    consented AS (
      SELECT c_mktsegment, o_custkey, o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE substr(sha256('{PSEUDONYM_SALT}' || CAST(o_custkey AS VARCHAR)), 1, 16) IN ({_CONSENTED_UC0})),
    rel AS (
      SELECT c_mktsegment, CAST(count(*) AS DOUBLE) + {n_noise} AS nn,
             sum(least(greatest(o_totalprice, {PRICE_LOWER}::DOUBLE), {PRICE_UPPER}::DOUBLE)) + {s_noise} AS sn
      FROM {FLAGSHIP_SUBJECT.sql('consented', 'c_mktsegment')} GROUP BY c_mktsegment),
    {S.skip_fold_sql(f'''SELECT 'flagship' AS budget_id, c_mktsegment,
           row_number() OVER (ORDER BY c_mktsegment) AS rn,
           CAST({cost} AS BIGINT) AS cost, CAST({FLAGSHIP_TOTAL_MICRO} AS BIGINT) AS total FROM rel''')}
    SELECT s.c_mktsegment, s.cost AS epsilon_micro, f.admitted AS allowed,
           f.used_after AS cumulative_micro, s.total - f.used_after AS remaining_micro,
           CASE WHEN f.admitted THEN round(r.nn, 6) END AS dp_count,
           CASE WHEN f.admitted THEN round(r.sn / greatest(r.nn, 1.0::DOUBLE), 6) END AS dp_mean
    FROM src s JOIN fold f ON s.budget_id = f.budget_id AND s.rn = f.rn
    JOIN rel r ON r.c_mktsegment = s.c_mktsegment"""


register("flagship_consented_dp_mean", "C1", "E1", "C2", "D9", "E4", "D21",
         sql=_flagship_sql())(flagship)
