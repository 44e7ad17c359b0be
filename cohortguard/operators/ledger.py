"""Consent ledger: validation, hash-chained append, status, integrity, export.

The ledger is a table, one row per consent action::

    ledger_id STRING, seq BIGINT, record_id STRING, patient_pseudonym STRING,
    use_case_id STRING, use_case_description STRING, action STRING,
    timestamp TIMESTAMP, expiry_date DATE, version STRING,
    previous_record_hash STRING, record_hash STRING

``ledger_id`` shards the chain: each shard is an independent hash chain, so
appends of different shards run in parallel tasks.  Route every action of a
subject to the same shard (e.g. by pseudonym) so "latest action" is ordered
by ``seq`` within one chain.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import (
    GENESIS_HASH,
    iso_utc,
    json_string,
    record_hash,
)
from .common import sized_broadcast
from .fold import ordered_fold

GRANT = "GRANT"
WITHDRAW = "WITHDRAW"

LEDGER_SCHEMA = T.StructType([
    T.StructField("ledger_id", T.StringType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("record_id", T.StringType(), False),
    T.StructField("patient_pseudonym", T.StringType(), False),
    T.StructField("use_case_id", T.StringType(), False),
    T.StructField("use_case_description", T.StringType(), True),
    T.StructField("action", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("expiry_date", T.DateType(), True),
    T.StructField("version", T.StringType(), False),
    T.StructField("previous_record_hash", T.StringType(), False),
    T.StructField("record_hash", T.StringType(), False),
])


def _hash_fields(df_cols=None, previous="previous_record_hash"):
    """The seven hashed fields (expiry and description are not hashed)."""
    return {
        "action": F.col("action"),
        "patient_pseudonym": F.col("patient_pseudonym"),
        "previous_record_hash": F.col(previous),
        "record_id": F.col("record_id"),
        "timestamp": iso_utc("timestamp"),
        "use_case_id": F.col("use_case_id"),
        "version": F.col("version"),
    }


def _hash_fields_all(previous="previous_record_hash"):
    fields = _hash_fields(previous=previous)
    fields["expiry_date"] = F.coalesce(F.date_format("expiry_date", "yyyy-MM-dd"), F.lit(""))
    fields["use_case_description"] = F.coalesce(F.col("use_case_description"), F.lit(""))
    return fields


# --------------------------------------------------------------------------
# C1 — validate requests against the use-case registry
# --------------------------------------------------------------------------

def validate_use_cases(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Flag each request ``accepted`` or rejected.

    A GRANT for an unregistered use case is rejected; a WITHDRAW is always
    accepted (an unregistered use case gets an empty description).  Adds
    ``use_case_description``, ``accepted`` and ``reject_reason``.
    """
    reg = sized_broadcast(registry.select(
        "use_case_id", F.col("description").alias("_reg_desc"), F.lit(True).alias("_registered")))
    joined = requests.join(reg, "use_case_id", "left")
    registered = F.coalesce(F.col("_registered"), F.lit(False))
    accepted = (F.col("action") == F.lit(WITHDRAW)) | registered
    return (joined
            .withColumn("use_case_description", F.coalesce(F.col("_reg_desc"), F.lit("")))
            .withColumn("accepted", accepted)
            .withColumn("reject_reason", F.when(accepted, F.lit(None).cast("string"))
                        .otherwise(F.lit("use case not registered")))
            .drop("_reg_desc", "_registered"))


# --------------------------------------------------------------------------
# E3 — append requests to the hash chain
# --------------------------------------------------------------------------

def append_records(requests: DataFrame, ledger: DataFrame | None = None,
                   order=("timestamp", "record_id"), hash_all_fields: bool = False,
                   num_partitions: int | None = None) -> DataFrame:
    """Extend each shard's chain with ``requests`` in ``order``.

    ``requests`` carries ``ledger_id, record_id, patient_pseudonym,
    use_case_id, use_case_description, action, timestamp, expiry_date,
    version`` (only accepted requests — see :func:`validate_use_cases`).
    Returns the new ledger rows (``seq`` continues from the existing
    ``ledger``; the first record of a new shard links to the genesis hash).

    The chain is serial within a shard, so the fold streams each shard's
    sorted rows through one task (bounded memory); shards run in parallel.
    All JSON text except the predecessor's hash is built in the JVM; the
    Python step only concatenates and hashes.
    """
    if ledger is not None:
        tip = (ledger.groupBy("ledger_id")
               .agg(F.max_by("record_hash", "seq").alias("_base_hash"),
                    F.max("seq").alias("_base_seq")))
        requests = requests.join(tip, "ledger_id", "left")
    else:
        requests = (requests.withColumn("_base_hash", F.lit(None).cast("string"))
                    .withColumn("_base_seq", F.lit(None).cast("long")))

    fields = _hash_fields_all("_prev") if hash_all_fields else _hash_fields(previous="_prev")
    names = sorted(fields)
    pos = names.index("previous_record_hash")
    head_parts, tail_parts = [], []
    for i, name in enumerate(names):
        lead = F.lit(("{" if i == 0 else ", ") + f'"{name}": ')
        if i < pos:
            head_parts += [lead, json_string(fields[name])]
        elif i == pos:
            head_parts += [lead]
        else:
            tail_parts += [lead, json_string(fields[name])]
    tail_parts.append(F.lit("}"))

    staged = (requests
              .withColumn("_prev", F.lit(""))
              .withColumn("_head", F.concat(*head_parts))
              .withColumn("_tail", F.concat(*tail_parts))
              .select("ledger_id", "record_id", "patient_pseudonym", "use_case_id",
                      "use_case_description", "action", "timestamp", "expiry_date",
                      "version", "_head", "_tail", "_base_hash", "_base_seq"))

    out_schema = T.StructType(
        [f for f in LEDGER_SCHEMA.fields if f.name not in ("record_hash",)]
        + [T.StructField("record_hash", T.StringType(), False)])
    out_cols = [f.name for f in out_schema.fields]

    def init(first):
        base = first["_base_hash"]
        seq = first["_base_seq"]
        return (GENESIS_HASH if base is None or pd.isna(base) else base,
                0 if seq is None or pd.isna(seq) else int(seq))

    def step(state, seg: pd.DataFrame):
        prev, seq = state
        heads = seg["_head"].tolist()
        tails = seg["_tail"].tolist()
        prevs, hashes = [], []
        for h, t in zip(heads, tails):
            prevs.append(prev)
            prev = hashlib.sha256(f'{h}"{prev}"{t}'.encode()).hexdigest()
            hashes.append(prev)
        n = len(seg)
        out = seg.drop(columns=["_head", "_tail", "_base_hash", "_base_seq"]).copy()
        out["seq"] = range(seq + 1, seq + n + 1)
        out["previous_record_hash"] = prevs
        out["record_hash"] = hashes
        return (prev, seq + n), out[out_cols]

    return ordered_fold(staged, ["ledger_id"], list(order), init, step, out_schema,
                        num_partitions=num_partitions)


# --------------------------------------------------------------------------
# E1 — latest action per (subject, use case)
# --------------------------------------------------------------------------

def consent_status(ledger: DataFrame, enforce_expiry: bool = False, as_of=None,
                   order="seq") -> DataFrame:
    """Consented iff the latest action for (subject, use case) is GRANT.

    ``order`` (column name or Column, e.g. ``struct(timestamp, request_seq)``)
    decides which action is latest.  One aggregation with a map-side partial
    ``max_by`` — a hot subject is combined before the shuffle.  With
    ``enforce_expiry`` a GRANT whose ``expiry_date`` is before ``as_of``
    (default: today) no longer counts.
    """
    order_col = F.col(order) if isinstance(order, str) else order
    if "expiry_date" not in ledger.columns:
        ledger = ledger.withColumn("expiry_date", F.lit(None).cast("date"))
    latest = (ledger.groupBy("patient_pseudonym", "use_case_id")
              .agg(F.max_by(F.struct("action", "expiry_date"), order_col).alias("_last"),
                   F.count(F.lit(1)).alias("n_actions")))
    consented = F.col("_last.action") == F.lit(GRANT)
    if enforce_expiry:
        day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
        consented = consented & (F.col("_last.expiry_date").isNull() | (F.col("_last.expiry_date") >= day))
    return latest.select(
        "patient_pseudonym", "use_case_id",
        F.col("_last.action").alias("last_action"),
        consented.alias("consented"),
        "n_actions")


def consented_subjects(ledger: DataFrame, use_case_id: str, **kw) -> DataFrame:
    return (consent_status(ledger, **kw)
            .where((F.col("use_case_id") == use_case_id) & F.col("consented"))
            .select("patient_pseudonym"))


def consented_rows(df: DataFrame, subject_pseudonym: str, ledger: DataFrame,
                   use_case_id: str, **kw) -> DataFrame:
    """Keep only rows whose subject currently consents to ``use_case_id``.

    ``subject_pseudonym`` is a column of ``df`` holding the pseudonymised
    subject (the ledger never stores raw identifiers).  A left-semi join:
    no ledger columns are added and no row is duplicated.
    """
    ok = consented_subjects(ledger, use_case_id, **kw).withColumnRenamed(
        "patient_pseudonym", subject_pseudonym)
    return df.join(ok, subject_pseudonym, "left_semi")


# --------------------------------------------------------------------------
# E2 — verify the hash chains
# --------------------------------------------------------------------------

def verify_chain(ledger: DataFrame, hash_all_fields: bool = False) -> DataFrame:
    """Check every link and every record hash, in parallel.

    Record ``seq`` must point at the hash of record ``seq − 1`` of the same
    shard (the genesis hash for ``seq = 1``) and its own hash must recompute.
    The predecessor's hash meets the record at its place ``(ledger_id, seq)``,
    so a long or hot shard is spread over all tasks — no per-shard sort.  A
    missing record shows up as a broken link.  Returns one row per shard
    with counts and the first failing ``seq`` (null when intact).
    """
    bad = ~(F.col("link_ok") & F.col("hash_ok"))
    return (_checked(ledger, hash_all_fields, ()).groupBy("ledger_id")
            .agg(F.count(F.lit(1)).alias("n_records"),
                 F.sum(F.when(~F.col("link_ok"), 1).otherwise(0)).cast("long").alias("n_broken_links"),
                 F.sum(F.when(~F.col("hash_ok"), 1).otherwise(0)).cast("long").alias("n_bad_hashes"),
                 F.min(F.when(bad, F.col("seq"))).alias("first_bad_seq"),
                 F.sum(F.when(bad, 1).otherwise(0)).alias("_n_bad"))
            .withColumn("intact", F.col("_n_bad") == 0).drop("_n_bad"))


def _checked(ledger: DataFrame, hash_all_fields: bool, keep) -> DataFrame:
    """``ledger_id, seq, keep ..., link_ok, hash_ok`` per record; no flag is
    ever null.

    A place ``(ledger_id, seq)`` that several records hold breaks the link of
    each of them; a null place, hash or hashed field fails the record.

    Hashes are recomputed where the records are read, so only places, hashes
    and what ``keep`` names are moved, once: every record goes to its own place
    and its hash to the next one, where a window sees both.
    """
    fields = _hash_fields_all() if hash_all_fields else _hash_fields()
    hash_ok = F.coalesce(F.col("record_hash") == record_hash(fields), F.lit(False))
    own = ledger.select("ledger_id", "seq", *keep, F.col("previous_record_hash").alias("_points_at"), hash_ok.alias("hash_ok"),
                        F.col("seq").alias("_place"), F.lit(1).alias("_own"), F.lit(None).cast("string").alias("_pred_hash"))
    pred = ledger.select("ledger_id", (F.col("seq") + 1).alias("_place"), F.lit(0).alias("_own"),
                         F.col("record_hash").alias("_pred_hash"))
    place = Window.partitionBy("ledger_id", "_place")
    both = (own.unionByName(pred, allowMissingColumns=True)
            .withColumns({"_copies": F.sum("_own").over(place), "_pred_hash": F.min("_pred_hash").over(place)})
            .where("_own = 1"))
    expected = F.when(F.col("seq") == 1, F.lit(GENESIS_HASH)).otherwise(F.col("_pred_hash"))
    link_ok = ((F.col("_points_at") == expected) & (F.col("_copies") == 1)
               & F.col("ledger_id").isNotNull() & F.col("seq").isNotNull())
    return both.select("ledger_id", "seq", *keep, F.coalesce(link_ok, F.lit(False)).alias("link_ok"), "hash_ok")


def verify_records(ledger: DataFrame, hash_all_fields: bool = False) -> DataFrame:
    """Per-record integrity flags (``link_ok``, ``hash_ok``) for drill-down."""
    rest = [c for c in ledger.columns if c not in ("ledger_id", "seq")]
    return _checked(ledger, hash_all_fields, rest).select(*ledger.columns, "link_ok", "hash_ok")


# --------------------------------------------------------------------------
# A15 — audit-trail export
# --------------------------------------------------------------------------

def export_audit_trail(ledger: DataFrame) -> DataFrame:
    """The seven exported ledger columns, timestamp as ISO text."""
    return ledger.select(
        "record_id", "patient_pseudonym", "use_case_id", "action",
        iso_utc("timestamp").alias("timestamp"),
        "version", "record_hash")

