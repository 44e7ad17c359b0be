"""Distributed exclusive prefix sums over an ordered column.

A window ``sum(x) OVER (ORDER BY s)`` without ``PARTITION BY`` moves every
row into one task, and ``PARTITION BY g`` does the same for a group that
holds most rows.  Instead we cut the order column into ``n_buckets`` ranges
(bounds from ``percentile_approx`` as a scalar subquery of the same query,
so nothing runs at plan-build time) and compute:

1. per (group, bucket) totals — a small table (groups × buckets rows),
2. the exclusive running total of those bucket totals (a window over the
   small table), and
3. the running sum inside each (group, bucket) — a window partitioned by
   (group, bucket), so each task sees one slice of one group.

prefix = (1) offset of the bucket + (3) running sum inside it.  Any
bucketing that is monotone in the order gives the exact prefix, so the
approximate bounds only affect balance, never values; a query evaluates
its bounds once, and every task (including retries) uses that value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 64
BUCKET_ROWS = 100_000  # of one group, that one window may hold
BOUND_ACCURACY = 1000  # percentile_approx accuracy (relative error 1/1000)


def with_bucket(df: DataFrame, col: str, n_buckets: int, out: str = "_bkt") -> DataFrame:
    """Add ``out``: how many of the ``n_buckets − 1`` approximate quantile
    bounds of ``col`` (one scalar subquery over ``df``) are ≤ the value."""
    if n_buckets <= 1:
        return df.withColumn(out, F.lit(0))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = df.select(F.percentile_approx(col, probs, BOUND_ACCURACY)).scalar()
    v, bnd = F.col(col), F.col("_bnd")
    n = sum(((v >= bnd[i]).cast("int") for i in range(len(probs))), F.lit(0))
    return df.withColumn("_bnd", bounds).withColumn(out, F.coalesce(n, F.lit(0))).drop("_bnd")


def buckets_for(df: DataFrame, groups: Sequence[str], rows: int = BUCKET_ROWS) -> int:
    """Ranges that leave about ``rows`` rows of the largest group in each, up
    to ``DEFAULT_BUCKETS`` (one aggregation; small groups are not cut)."""
    most = df.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0
    return max(1, min(DEFAULT_BUCKETS, -(-most // rows)))


def exclusive_prefix(df: DataFrame, order_col: str, values: Sequence[str],
                     groups: Sequence[str] = (), tie_cols: Sequence[str] = (),
                     n_buckets: int = DEFAULT_BUCKETS, suffix: str = "_before",
                     with_totals: bool = False) -> DataFrame:
    """Add ``<v><suffix>``: sum of ``v`` over rows of the same group that come
    strictly before this row in (order_col, *tie_cols) order.  With
    ``with_totals`` also add ``<v>_total``, the group's sum (from the small
    per-bucket table, so it costs no extra pass).

    ``order_col`` must be numeric.  Rows equal in the full order key must not
    occur (add ``tie_cols`` to make the order total).
    """
    groups, values = list(groups), list(values)
    if n_buckets <= 1 and groups and not with_totals:  # a group is one range
        w = Window.partitionBy(*groups).orderBy(order_col, *tie_cols).rowsBetween(Window.unboundedPreceding, -1)
        return df.select("*", *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(f"{v}{suffix}") for v in values])
    b = with_bucket(df, order_col, n_buckets)
    totals = b.groupBy(*groups, "_bkt").agg(*[F.sum(v).alias(f"_bt_{v}") for v in values])
    w_off = (Window.partitionBy(*groups).orderBy("_bkt")
             .rowsBetween(Window.unboundedPreceding, -1))
    extra = []
    if with_totals:
        w_all = Window.partitionBy(*groups)
        extra = [F.sum(f"_bt_{v}").over(w_all).alias(f"{v}_total") for v in values]
    offsets = totals.select(*groups, "_bkt", *[
        F.coalesce(F.sum(f"_bt_{v}").over(w_off), F.lit(0)).alias(f"_off_{v}") for v in values], *extra)
    w_in = (Window.partitionBy(*groups, "_bkt").orderBy(order_col, *tie_cols)
            .rowsBetween(Window.unboundedPreceding, -1))
    inner = b.select("*", *[F.coalesce(F.sum(v).over(w_in), F.lit(0)).alias(f"_in_{v}") for v in values])
    out = inner.join(offsets, [*groups, "_bkt"], "inner")
    for v in values:
        out = out.withColumn(f"{v}{suffix}", F.col(f"_off_{v}") + F.col(f"_in_{v}"))
    return out.drop("_bkt", *[f"_off_{v}" for v in values], *[f"_in_{v}" for v in values])
