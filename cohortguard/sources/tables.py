"""Readers for the driver's Parquet tables.

Tables are read lazily with ``spark.read.parquet``; callers project the
columns they need right away so Catalyst prunes the scan's ``ReadSchema`` and
pushes filters into the Parquet reader.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return os.path.join(sf_dir, f"{name}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one driver table, optionally projected to ``columns``."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
