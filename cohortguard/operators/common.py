"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension we are willing to ship to every executor.
BROADCAST_MAX_ROWS = 1_000_000


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast-hint ``df`` only if it provably holds at most ``max_rows`` rows.

    The check is a bounded job (``limit(max_rows + 1).count()``); beyond the
    bound the DataFrame is returned unhinted and Spark plans a shuffle join
    (AQE may still convert it at run time from the measured size).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


# Largest fixed dimension (questionnaire, grid) embedded in a plan as literals.
DIMENSION_MAX_ROWS = 10_000


def with_dimension(df: DataFrame, dim: DataFrame, max_rows: int = DIMENSION_MAX_ROWS) -> DataFrame:
    """Pair every row of ``df`` with every row of a small fixed dimension
    (a questionnaire, a parameter grid).

    The dimension is gathered into one array by a scalar subquery over
    ``limit(max_rows + 1)`` (so the gathered list is bounded, and more rows
    fail the query: it is not a fixed dimension), then exploded next to each
    row — a narrow projection, no join.
    """
    cols = dim.columns
    bounded = dim.limit(max_rows + 1)
    arr = bounded.agg(
        F.when(F.count(F.lit(1)) <= F.lit(max_rows), F.collect_list(F.struct(*cols)))
        .otherwise(F.raise_error(F.lit(f"dimension has more than {max_rows} rows; "
                                       "it is meant to be a small fixed table")))).scalar()
    return (df.select("*", F.explode(arr).alias("_dim"))
            .select(*[F.col(c) for c in df.columns], *[F.col(f"_dim.{c}").alias(c) for c in cols]))


def with_defaults(df: DataFrame, **defaults) -> DataFrame:
    """Fill nulls in the named columns with Python literals."""
    for name, value in defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return df


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` once to the cluster's checkpoint folder.

    Used where a plan reads one expensive intermediate from several
    branches (each branch would otherwise recompute it) or feeds it to a
    driver-side loop (iterative rounds) and then to the main job.
    The folder is ``spark.checkpoint.dir`` from the session (a shared,
    fault-tolerant location on a cluster); a scratch folder is set only when
    none is configured (tests).  Survives executor loss, unlike a local
    checkpoint.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
