"""Structured audit events: builders (A12–A14), JSON sink and source.

An audit event is a row ``(timestamp, session_id, context, event_type,
details)`` where ``details`` is a JSON object.  Builders turn any DataFrame
into events — one per row — with ``to_json(struct(...))``, so logging a
million decisions is one distributed projection, not a Python loop.  The
sink appends JSON lines partitioned by session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("context", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("details", T.StringType()),
])
AUDIT_COLUMNS = [f.name for f in AUDIT_SCHEMA.fields]
ISO_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
_JSON_OPTS = {"ignoreNullFields": "false"}


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _event(df: DataFrame, event_type: str, details: Column, context: str, session_id) -> DataFrame:
    return df.select(F.current_timestamp().alias("timestamp"), _c(session_id).alias("session_id"),
                     F.lit(context).alias("context"), F.lit(event_type).alias("event_type"),
                     F.to_json(details, _JSON_OPTS).alias("details"), "*")


def training_event(df: DataFrame, model, n_samples, privacy_protected, epsilon=None,
                   metrics: Column | None = None, context: str = "", session_id="") -> DataFrame:
    """MODEL_TRAINING — model, sample count, protection, ε, metrics."""
    details = F.struct(_c(model).alias("model"), _c(n_samples).alias("n_samples"),
                       _c(privacy_protected).alias("privacy_protected"),
                       _c(epsilon).cast("double").alias("epsilon"),
                       (metrics if metrics is not None else F.create_map()).alias("metrics"))
    return _event(df, "MODEL_TRAINING", details, context, session_id)


def data_access_event(df: DataFrame, accessor, data_type, purpose, consent_verified,
                      n_records=None, context: str = "", session_id="") -> DataFrame:
    """DATA_ACCESS — who read what, for which purpose, consent checked."""
    details = F.struct(_c(accessor).alias("accessor"), _c(data_type).alias("data_type"),
                       _c(purpose).alias("purpose"), _c(consent_verified).alias("consent_verified"),
                       _c(n_records).alias("n_records"))
    return _event(df, "DATA_ACCESS", details, context, session_id)


def decision_event(df: DataFrame, model, input_cols, output, confidence, human_override=False,
                   context: str = "", session_id="") -> DataFrame:
    """MODEL_DECISION — SHA-256 of the inputs, output, confidence (4 dp)."""
    input_hash = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in input_cols]), 256)
    details = F.struct(_c(model).alias("model"), input_hash.alias("input_hash"),
                       _c(output).alias("output"), F.round(_c(confidence), 4).alias("confidence"),
                       _c(human_override).alias("human_override"))
    return _event(df, "MODEL_DECISION", details, context, session_id)


def append_audit(events: DataFrame, path: str) -> None:
    """A11 sink: append JSON lines, one folder per session."""
    (events.select(*AUDIT_COLUMNS).write.mode("append").partitionBy("session_id")
     .option("timestampFormat", ISO_Z).json(path))


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """A11 source: read the audit log back with a fixed schema."""
    return spark.read.schema(AUDIT_SCHEMA).option("timestampFormat", ISO_Z).json(path)
