"""Differentially private releases as DataFrame operators.

Rules every operator here follows:

* noise is added **after** aggregation, one draw per released cell, keyed by
  (seed, stream, group key) so a recomputed plan cannot release a second,
  different draw of the same cell;
* sensitivity is explicit — sums and means clip values into declared
  bounds, and a :class:`SubjectBound` limits the groups and rows of each
  subject and scales the noise to what is left;
* epsilon must be > 0; the caller charges it through the budget gate.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.noise import (
    DEFAULT_DELTA,
    flip_probability,
    gaussian_noise,
    gaussian_sigma,
    laplace_noise,
    laplace_scale,
)
from ..functions.prf import keyed_uniform, keyed_uniform_sql

RELEASE_DECIMALS = 6


@dataclass(frozen=True)
class SubjectBound:
    """How much one subject may contribute to a release.

    A subject keeps at most ``max_groups`` groups and ``max_rows`` rows in each,
    chosen by keyed uniforms of (subject, group) and of ``id_col``.  All rows
    with a null subject count as one subject.  Whatever rows a subject has, it
    moves the released sums by at most ``max_rows`` times a row's bound in
    ``max_groups`` cells; the noise of a release is scaled to that.
    """
    subject_col: str
    id_col: str
    max_groups: int
    max_rows: int
    seed: object = "bound"

    def __post_init__(self):
        if self.max_groups < 1 or self.max_rows < 1:
            raise ValueError("a subject keeps one group and one row at least")

    def sensitivity(self, row_bound: float, mechanism: str) -> float:
        """L1 (Laplace) or L2 (Gaussian) distance that one subject can cause,
        each row adding at most ``row_bound``."""
        cells = self.max_groups if mechanism == "laplace" else math.sqrt(self.max_groups)
        return cells * self.max_rows * row_bound

    def apply(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The rows of ``df`` that count.

        Both choices are rank limits, which Spark plans with a partial
        ``WindowGroupLimit`` before the shuffle (for limits up to
        ``spark.sql.optimizer.windowGroupLimitThreshold``): a map task forwards
        a bounded number of rows per subject, so a subject with a third of all
        rows is cut down before it moves.
        """
        row, group = f"_{uuid.uuid4().hex}", f"_{uuid.uuid4().hex}"
        of = Window.partitionBy(self.subject_col, *keys).orderBy(keyed_uniform(self.seed, "rows", self.id_col), self.id_col)
        draw = keyed_uniform(self.seed, "groups", self.subject_col, *keys)
        kept = df.withColumn(row, F.row_number().over(of)).where(F.col(row) <= self.max_rows)
        among = Window.partitionBy(self.subject_col).orderBy(draw, *keys)
        return (kept.withColumn(group, F.dense_rank().over(among)).where(F.col(group) <= self.max_groups)
                .select(*df.columns))

    def sql(self, rows: str, key: str) -> str:
        """The same choice as a DuckDB query over the relation ``rows``."""
        return f"""(
          SELECT * FROM (
            SELECT *, dense_rank() OVER (PARTITION BY {self.subject_col} ORDER BY
                   {keyed_uniform_sql(self.seed, 'groups', self.subject_col, key)}, {key}) AS bound_group
            FROM (SELECT *, row_number() OVER (PARTITION BY {self.subject_col}, {key} ORDER BY
                         {keyed_uniform_sql(self.seed, 'rows', self.id_col)}, {self.id_col}) AS bound_row FROM {rows})
            WHERE bound_row <= {self.max_rows})
          WHERE bound_group <= {self.max_groups})"""


def _bounded(df: DataFrame, keys: Sequence[str], subject: SubjectBound | None, row_bound: float,
             mechanism: str) -> tuple[DataFrame, float]:
    """Rows that count and what one subject (without a bound: one row) can
    change."""
    if subject is None:
        return df, row_bound
    return subject.apply(df, keys), subject.sensitivity(row_bound, mechanism)


def _noise(mechanism: str, sensitivity: float, epsilon: float, seed, stream: str,
           keys: Sequence[str], delta: float) -> Column:
    if mechanism == "laplace":
        return laplace_noise(laplace_scale(sensitivity, epsilon), seed, stream, *keys)
    if mechanism == "gaussian":
        return gaussian_noise(gaussian_sigma(sensitivity, epsilon, delta), seed, stream, *keys)
    raise ValueError("mechanism must be 'laplace' or 'gaussian'")


def dp_count(df: DataFrame, keys: Sequence[str], epsilon: float, seed, *,
             mechanism: str = "laplace", delta: float = DEFAULT_DELTA,
             stream: str = "dp_count", subject: SubjectBound | None = None) -> DataFrame:
    """Noisy row count per group, private per ``subject``; without one,
    every row counts as a subject of its own (sensitivity 1)."""
    keys = list(keys)
    df, sens = _bounded(df, keys, subject, 1.0, mechanism)
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    noisy = F.col("_n").cast("double") + _noise(mechanism, sens, epsilon, seed, stream, keys, delta)
    return agg.select(*keys, F.round(noisy, RELEASE_DECIMALS).alias("dp_count"))


def dp_sum(df: DataFrame, keys: Sequence[str], value_col: str, lower: float, upper: float,
           epsilon: float, seed, *, mechanism: str = "laplace", delta: float = DEFAULT_DELTA,
           stream: str = "dp_sum", subject: SubjectBound | None = None) -> DataFrame:
    """Noisy sum of values clipped to [lower, upper], private per
    ``subject`` (without one, per row)."""
    keys = list(keys)
    if not lower <= upper:
        raise ValueError("lower must be <= upper")
    df, sens = _bounded(df, keys, subject, max(abs(lower), abs(upper)), mechanism)
    clipped = F.least(F.greatest(F.col(value_col).cast("double"), F.lit(float(lower))), F.lit(float(upper)))
    agg = df.groupBy(*keys).agg(F.sum(clipped).alias("_s"))
    noisy = F.col("_s") + _noise(mechanism, sens, epsilon, seed, stream, keys, delta)
    return agg.select(*keys, F.round(noisy, RELEASE_DECIMALS).alias("dp_sum"))


def dp_mean(df: DataFrame, keys: Sequence[str], value_col: str, lower: float, upper: float,
            epsilon: float, seed, *, mechanism: str = "laplace", delta: float = DEFAULT_DELTA,
            stream: str = "dp_mean", subject: SubjectBound | None = None) -> DataFrame:
    """Noisy mean = noisy clipped sum / noisy count, ε split evenly, private
    per ``subject`` (without one, per row).

    One aggregation pass computes both the count and the clipped sum.
    """
    keys = list(keys)
    if not lower <= upper:
        raise ValueError("lower must be <= upper")
    half = epsilon / 2.0
    df, sens = _bounded(df, keys, subject, max(abs(lower), abs(upper)), mechanism)
    one = 1.0 if subject is None else subject.sensitivity(1.0, mechanism)
    clipped = F.least(F.greatest(F.col(value_col).cast("double"), F.lit(float(lower))), F.lit(float(upper)))
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(clipped).alias("_s"))
    n_noisy = F.col("_n").cast("double") + _noise(mechanism, one, half, seed, stream + ":n", keys, delta)
    s_noisy = F.col("_s") + _noise(mechanism, sens, half, seed, stream + ":s", keys, delta)
    return (agg.select(*keys, n_noisy.alias("_nn"), s_noisy.alias("_sn"))
            .select(*keys,
                    F.round(F.col("_nn"), RELEASE_DECIMALS).alias("dp_count"),
                    F.round(F.col("_sn") / F.greatest(F.col("_nn"), F.lit(1.0)), RELEASE_DECIMALS)
                    .alias("dp_mean")))


def noise_features(df: DataFrame, cols: Sequence[str], epsilon: float, seed, id_col: str,
                   sensitivity: float = 1.0, delta: float = DEFAULT_DELTA) -> DataFrame:
    """Gaussian noise on every cell of ``cols`` (one ``select``)."""
    sigma = gaussian_sigma(sensitivity, epsilon, delta)
    out = []
    for c in df.columns:
        if c in cols:
            out.append((F.col(c).cast("double") + gaussian_noise(sigma, seed, f"feat:{c}", id_col)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def flip_labels(df: DataFrame, label_col: str, epsilon: float, seed, id_col: str,
                out_col: str | None = None, stream: str = "flip") -> DataFrame:
    """Randomised response on a 0/1 label with p = clamp(1/(5ε), 0, 0.3)."""
    return df.withColumn(out_col or label_col, flipped_label(label_col, epsilon, seed, id_col, stream))


def flipped_label(label_col: str, epsilon: float, seed, id_col: str, stream: str = "flip") -> Column:
    """B6 as a Column."""
    u = keyed_uniform(seed, stream, id_col)
    y = F.col(label_col)
    return F.when(u < F.lit(flip_probability(epsilon)), F.lit(1) - y).otherwise(y).cast("int")


def dp_signal(counts: DataFrame, epsilon: float, seed, *, keys=("drug", "event"),
              system_col: str = "system", count_col: str = "n", sensitivity: float = 1.0,
              delta: float = DEFAULT_DELTA) -> DataFrame:
    """Federated signal count.

    Each reporting system adds Gaussian noise to its own count (one draw per
    (drug, event, system) cell), floors it at 0; the aggregator sums the
    noisy counts per (drug, event) and reports how many systems contributed.
    """
    keys = list(keys)
    sigma = gaussian_sigma(sensitivity, epsilon, delta)
    noisy = F.greatest(F.lit(0.0), F.col(count_col).cast("double")
                       + gaussian_noise(sigma, seed, "signal", *keys, system_col))
    return (counts.withColumn("_noisy", noisy)
            .groupBy(*keys)
            .agg(F.round(F.sum("_noisy"), 1).alias("dp_aggregate_count"),
                 F.countDistinct(system_col).alias("systems_contributed"))
            .withColumn("epsilon_used", F.lit(float(epsilon))))
