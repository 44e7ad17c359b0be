"""DuckDB SQL fragments shared by the oracles.

These mirror the bindings and operators in plain SQL so the oracle is an
independent computation (window functions and recursive CTEs instead of the
Spark folds).
"""

from __future__ import annotations

from ..functions.hashing import (
    GENESIS_HASH,
    ISO_MICROS_DUCKDB,
    PSEUDONYM_SALT,
    json_payload_sql,
)
from ..sources import bindings as B


def requests_sql() -> str:
    return f"""
    SELECT 'L' || CAST(user_id % {B.N_LEDGER_SHARDS} AS VARCHAR) AS ledger_id,
           'r' || CAST(event_id AS VARCHAR) AS record_id,
           event_id AS request_seq,
           user_id AS subject_id,
           substr(sha256('{PSEUDONYM_SALT}' || CAST(user_id AS VARCHAR)), 1, 16) AS patient_pseudonym,
           'UC' || CAST(event_id % {B.N_USE_CASES} AS VARCHAR) AS use_case_id,
           CASE WHEN event_type = 'error' THEN 'WITHDRAW' ELSE 'GRANT' END AS action,
           CAST(ts AS TIMESTAMP) AS "timestamp",
           '{B.CONSENT_VERSION}' AS version
    FROM events"""


def validated_sql() -> str:
    return f"""
    SELECT r.*, coalesce(registry.description, '') AS use_case_description,
           (r.action = 'WITHDRAW' OR registry.use_case_id IS NOT NULL) AS accepted,
           CASE WHEN r.action = 'WITHDRAW' OR registry.use_case_id IS NOT NULL THEN NULL
                ELSE 'use case not registered' END AS reject_reason
    FROM ({requests_sql()}) r LEFT JOIN {B.registry_sql()} ON r.use_case_id = registry.use_case_id"""


def _payload(alias: str, prev_expr: str) -> str:
    return json_payload_sql({
        "action": f"{alias}.action",
        "patient_pseudonym": f"{alias}.patient_pseudonym",
        "previous_record_hash": prev_expr,
        "record_id": f"{alias}.record_id",
        "timestamp": f"strftime({alias}.\"timestamp\", '{ISO_MICROS_DUCKDB}')",
        "use_case_id": f"{alias}.use_case_id",
        "version": f"{alias}.version",
    })


def chain_ctes() -> str:
    """CTEs ``acc`` (accepted requests with seq) and ``chain`` (hash chain)."""
    return f"""
    acc AS (
      SELECT v.*, row_number() OVER (PARTITION BY ledger_id ORDER BY "timestamp", request_seq) AS seq
      FROM ({validated_sql()}) v WHERE accepted),
    chain(ledger_id, seq, previous_record_hash, record_hash) AS (
      SELECT a.ledger_id, a.seq, '{GENESIS_HASH}', sha256({_payload('a', "'" + GENESIS_HASH + "'")})
      FROM acc a WHERE a.seq = 1
      UNION ALL
      SELECT a.ledger_id, a.seq, c.record_hash, sha256({_payload('a', 'c.record_hash')})
      FROM chain c JOIN acc a ON a.ledger_id = c.ledger_id AND a.seq = c.seq + 1)"""


def ledger_sql() -> str:
    """Full ledger rows (acc ⋈ chain) as a WITH RECURSIVE query."""
    return f"""WITH RECURSIVE {chain_ctes()}
    SELECT a.ledger_id, a.seq, a.record_id, a.patient_pseudonym, a.use_case_id, a.action,
           a."timestamp", a.version, a.use_case_description,
           c.previous_record_hash, c.record_hash
    FROM acc a JOIN chain c ON a.ledger_id = c.ledger_id AND a.seq = c.seq"""


def skip_fold_sql(src: str, key: str = "budget_id", refuse_when_exhausted: bool = True) -> str:
    """Recursive CTE ``fold(key, rn, admitted, used_after)`` over ``src``.

    ``src`` must provide ``key, rn (1..n per key), cost, total``.
    """
    if refuse_when_exhausted:
        fits0 = "(0 < s.total AND s.cost >= 0 AND s.cost <= s.total)"
        fits = "(f.used_after < s.total AND s.cost >= 0 AND f.used_after + s.cost <= s.total)"
    else:
        fits0 = "(s.cost > 0 AND s.cost <= s.total)"
        fits = "(s.cost > 0 AND f.used_after + s.cost <= s.total)"
    return f"""
    src AS ({src}),
    fold({key}, rn, admitted, used_after) AS (
      SELECT s.{key}, s.rn, {fits0}, CASE WHEN {fits0} THEN s.cost ELSE 0 END
      FROM src s WHERE s.rn = 1
      UNION ALL
      SELECT s.{key}, s.rn, {fits}, CASE WHEN {fits} THEN f.used_after + s.cost ELSE f.used_after END
      FROM fold f JOIN src s ON s.{key} = f.{key} AND s.rn = f.rn + 1)"""
