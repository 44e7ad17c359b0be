"""Run a streaming query to completion over the data available now.

Sinks write Parquet into a fresh folder under the session's checkpoint
directory (shared storage on a cluster), with the stream's own checkpoint
beside it, so a restarted query resumes exactly where it stopped.  Update
mode results go through ``foreachBatch``: each micro-batch appends its
changed rows tagged with the batch id, and readers keep the newest version
of every key.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "streams", f"{name}-{uuid.uuid4().hex}")


def events_stream(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    """The driver table as a file stream (schema taken from the batch table)."""
    schema = spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet")).schema
    return (spark.readStream.schema(schema)
            .option("pathGlobFilter", f"{table}.parquet")
            .option("maxFilesPerTrigger", 1)
            .parquet(sf_dir))


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, as processors with
    several states need."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def run_append(stream: DataFrame, name: str) -> DataFrame:
    """Append-mode stream → Parquet; returns the written rows as a batch DataFrame."""
    spark = stream.sparkSession
    d = scratch_dir(spark, name)
    with rocksdb(spark):
        q = (stream.writeStream.outputMode("append").format("parquet")
             .option("path", os.path.join(d, "out"))
             .option("checkpointLocation", os.path.join(d, "checkpoint"))
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(os.path.join(d, "out"))


def run_update(stream: DataFrame, name: str, keys) -> DataFrame:
    """Update-mode stream → versioned Parquet; returns the latest row per key."""
    spark = stream.sparkSession
    d = scratch_dir(spark, name)
    out = os.path.join(d, "out")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(out)

    with rocksdb(spark):
        q = (stream.writeStream.outputMode("update").foreachBatch(sink)
             .option("checkpointLocation", os.path.join(d, "checkpoint"))
             .trigger(availableNow=True).start())
    q.awaitTermination()
    res = spark.read.parquet(out)
    value_cols = [c for c in res.columns if c not in keys and c != "_batch"]
    latest = res.groupBy(*keys).agg(F.max_by(F.struct(*value_cols), "_batch").alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in value_cols])
