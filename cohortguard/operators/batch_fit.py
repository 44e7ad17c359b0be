"""Many logistic regressions in one pass per step.

Utility curves, drop-column analyses and cross-validation fit dozens of small
models on the same rows.  Fitted one by one, each costs its own jobs; here all
of them advance together.  A Newton step is one aggregation: every task turns
its rows into the gradient and Hessian sums of all models by matrix products,
the sums of the tasks are added where they meet, and the driver solves one
(d+1) x (d+1) system per model.  Rows never reach the driver; its state is
models x (d+1) numbers.

Models may differ in their labels (noisy copies of a label), in the weight
they give a row (folds) and in the features they see (masks).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Rows turned into matrices at once (a task's memory: rows x (d+1)^2 numbers).
BLOCK_ROWS = 2000


def _design(df: DataFrame, features: Sequence[str], *extra: Column) -> DataFrame:
    """Rows as arrays: ``x`` (features and a one), then ``extra``.  Rows with a
    null or NaN feature take part in no model."""
    xs = [F.col(f).cast("double") for f in features]
    usable = F.lit(True)
    for x in xs:
        usable = usable & x.isNotNull() & ~F.isnan(x)
    return df.where(usable).select(F.array(*xs, F.lit(1.0)).alias("x"), *extra)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch[name].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK_ROWS):
            yield batch.slice(at, BLOCK_ROWS)


def _sigmoid(eta: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -eta))


def _step_sums(rows: DataFrame, coef: np.ndarray) -> dict[int, np.ndarray]:
    """Per model: the loss, the gradient and the Hessian over all rows, flat."""
    m, p = coef.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, grad, hess = np.zeros(m), np.zeros((m, p)), np.zeros((m, p * p))
        for b in _blocks(batches):
            x, y, w = _matrix(b, "x"), _matrix(b, "y"), _matrix(b, "w")
            eta = x @ coef.T
            mean = _sigmoid(eta)
            grad += (w * (mean - y)).T @ x
            hess += (w * mean * (1 - mean)).T @ (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
            loss += (w * (np.logaddexp(0.0, eta) - y * eta)).sum(axis=0)
        flat = np.hstack([loss[:, None], grad, hess])
        yield pa.RecordBatch.from_arrays([pa.array(range(m), pa.int32()), pa.array(list(flat))], names=["model", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, row in zip(b["model"].to_pylist(), _matrix(b, "sums")):
                total[k] = total[k] + row if k in total else row.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array(list(total.values()), pa.list_(pa.float64()))], names=["model", "sums"])

    kind = "model int, sums array<double>"
    found = rows.mapInArrow(sums, kind).repartition("model").mapInArrow(added, kind).collect()
    return {r.model: np.array(r.sums) for r in found}


def fit_many(df: DataFrame, features: Sequence[str], labels: Sequence[Column], weights: Sequence[Column] | None = None,
             masks: Sequence[Sequence[bool]] | None = None, penalty: float = 1.0, max_steps: int = 50,
             tolerance: float = 1e-9) -> np.ndarray:
    """Coefficients (models x (d+1), intercept last) of L2-penalised logistic
    regressions; the intercept is not penalised.

    ``labels`` and ``weights`` hold one Column, for all models, or one per
    model; ``masks`` tells per model which features it sees.  A model whose
    step does not lower its loss halves it, so separable labels converge too.
    Rows with a null feature, label or weight are left out; without rows the
    coefficients are zero.
    """
    m = max(len(labels), len(weights or ()), len(masks or ()))
    d = len(features)
    for some in (labels, weights, masks):
        if some is not None and len(some) not in (1, m):
            raise ValueError("one label, weight or mask for all models, or one for each")
    keep = np.ones((m, d + 1), bool)
    if masks is not None:
        keep[:, :d] = np.array(masks, bool)
    known = F.lit(True)
    for c in [*labels, *(weights or ())]:
        known = known & c.isNotNull()
    # drawn labels and weights are made once, not at every step
    rows = materialize(_design(df.where(known), features, F.array(*[c.cast("double") for c in labels]).alias("y"),
                               F.array(*[c.cast("double") for c in (weights or [F.lit(1.0)])]).alias("w")))
    ridge = np.full(d + 1, float(penalty))
    ridge[-1] = 0.0
    coef, before = np.zeros((m, d + 1)), np.zeros((m, d + 1))
    least, open_ = np.full(m, np.inf), np.ones(m, bool)
    for _ in range(max_steps):
        sums = _step_sums(rows, coef)
        for k in np.flatnonzero(open_):
            flat = sums.get(int(k), np.zeros(1 + (d + 1) * (d + 2)))
            loss = flat[0] + (ridge * coef[k] ** 2).sum() / 2
            if loss > least[k] * (1 + 1e-12) + 1e-12:
                coef[k] = (coef[k] + before[k]) / 2
                continue
            free = keep[k]
            grad = (flat[1:d + 2] + ridge * coef[k])[free]
            hess = (flat[d + 2:].reshape(d + 1, d + 1) + np.diag(ridge))[np.ix_(free, free)]
            step = np.linalg.solve(hess + 1e-9 * np.eye(int(free.sum())), grad)
            least[k], before[k] = loss, coef[k]
            coef[k, free] -= step
            open_[k] = np.abs(step).max(initial=0) > tolerance
        if not open_.any():
            break
    return coef


def model_scores(df: DataFrame, features: Sequence[str], label: str, coef: np.ndarray,
                 chosen: Sequence[Column] | None = None, decimals: int = 9) -> DataFrame:
    """(model, label, score) of every row under every model, or under those
    whose ``chosen`` Column is true for the row.  Scores are log odds, rounded
    so that equal rows tie whatever the order of sums."""
    m, some = len(coef), bool(chosen)
    pick = F.array(*[c.cast("boolean") for c in chosen]) if chosen else F.lit(None).cast("array<boolean>")
    rows = _design(df.where(F.col(label).isNotNull()), features, F.col(label).cast("int").alias("label"), pick.alias("chosen"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            score = np.round(_matrix(b, "x") @ coef.T, decimals) + 0.0
            wanted = _matrix(b, "chosen") if some else np.ones(score.shape, bool)
            row, model = np.nonzero(wanted)
            yield pa.RecordBatch.from_arrays([pa.array(model, pa.int32()), b["label"].take(pa.array(row)),
                                              pa.array(score[row, model])], names=["model", "label", "score"])

    return rows.mapInArrow(run, "model int, label int, score double") if m else df.sparkSession.createDataFrame(
        [], "model int, label int, score double")
