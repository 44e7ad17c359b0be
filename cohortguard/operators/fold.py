"""Ordered per-key folds that stream through sorted partitions.

A hash chain (each record hashes its predecessor's hash) and a budget gate
(an operation is admitted only if it still fits, and a refused operation
consumes nothing) are sequential by definition: record *i* cannot be decided
before record *i − 1*.  Spark has no built-in for such a "skip fold", so we
run it the way a Spark user runs any per-key sequential logic:

1. hash-partition by the key (one shuffle; each key lives in one task),
2. sort within partitions by (key, order) — an external, spillable sort,
3. ``mapInPandas`` walks the Arrow batches in order and carries the fold
   state from one batch to the next.

Nothing collects a group: a task holds one Arrow batch plus a constant-size
state, so even a key holding a third of all rows streams through in
``spark.sql.execution.arrow.maxRecordsPerBatch`` chunks and spills through
the sort rather than exhausting memory.  The vectorised kernels below decide
the long "everything still fits" prefix of a key with one NumPy ``cumsum``
and loop only over rows that could still be admitted afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame


def ordered_fold(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                 init: Callable[[pd.Series], object],
                 step: Callable[[object, pd.DataFrame], tuple[object, pd.DataFrame]],
                 schema, num_partitions: int | None = None) -> DataFrame:
    """Fold ``step`` over each key's rows in ``order``.

    ``init(first_row)`` builds the state when a new key starts; ``step(state,
    segment)`` consumes a contiguous, ordered slice of one key's rows and
    returns the new state and the output rows for the slice.  Null keys are
    one key.
    """
    keys = list(keys)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    prepared = df.repartition(n, *keys).sortWithinPartitions(*keys, *order)

    def run(batches):
        current = None
        state = None
        for pdf in batches:
            if pdf.empty:
                continue
            pdf = pdf.reset_index(drop=True)
            change = np.zeros(len(pdf), dtype=bool)
            change[0] = True
            for k in keys:
                v, null = pdf[k].to_numpy(), pdf[k].isna().to_numpy()
                change[1:] |= (v[1:] != v[:-1]) & ~(null[1:] & null[:-1])  # nulls are one key
            starts = np.flatnonzero(change)
            ends = np.append(starts[1:], len(pdf))
            outs = []
            for s, e in zip(starts, ends):
                key = tuple(None if pd.isna(x) else x for x in (pdf[k].iat[s] for k in keys))
                if key != current:
                    current = key
                    state = init(pdf.iloc[s])
                state, out = step(state, pdf.iloc[s:e])
                outs.append(out)
            yield pd.concat(outs, ignore_index=True) if len(outs) > 1 else outs[0]

    return prepared.mapInPandas(run, schema)


def greedy_admit(cost: np.ndarray, used: int, total: int,
                 refuse_when_exhausted: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """Admit costs in order while they fit; a refused cost consumes nothing.

    Returns ``(admitted, used_after, used)`` where ``used_after[i]`` is the
    amount consumed once row *i* has been decided.  With
    ``refuse_when_exhausted`` every row is refused once ``used >= total``
    (even a zero cost).  Negative costs are always refused.
    """
    cost = np.asarray(cost, dtype=np.int64)
    n = len(cost)
    admitted = np.zeros(n, dtype=bool)
    start_used = used
    j = 0
    if not (refuse_when_exhausted and used >= total) and n:
        after = used + np.cumsum(cost)
        bad = (after > total) | (cost < 0)
        if refuse_when_exhausted:
            bad |= (after - cost) >= total
        j = int(np.argmax(bad)) if bad.any() else n
        admitted[:j] = True
        if j:
            used = int(after[j - 1])
    # After the first refusal only rows that still fit can change the state.
    if j < n:
        live = np.arange(j, n)
        live = live[cost[live] >= 0]
        while len(live) and not (refuse_when_exhausted and used >= total):
            live = live[cost[live] <= total - used]
            after = used + np.cumsum(cost[live])
            bad = after > total
            if refuse_when_exhausted:
                bad |= (after - cost[live]) >= total
            k = int(np.argmax(bad)) if bad.any() else len(live)
            admitted[live[:k]] = True
            used = int(after[k - 1]) if k else used
            live = live[k + 1:]  # the first that does not fit is refused
    # used_after: running consumption, carried forward over refused rows.
    run = np.where(admitted, cost, 0)
    used_after = start_used + np.cumsum(run)
    return admitted, used_after.astype(np.int64), used


def greedy_admit_groups(cost: np.ndarray, starts: np.ndarray, used: np.ndarray, total: int,
                        refuse_when_exhausted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`greedy_admit` for many groups that lie one after the other.

    Group ``g`` begins at row ``starts[g]`` with ``used[g]`` consumed.  Groups
    whose rows all fit, or of which no row can fit, are decided together; only
    the others are looped over.  Returns ``(admitted, used_after, used)``.
    """
    cost, used = np.asarray(cost, dtype=np.int64), np.asarray(used, dtype=np.int64)
    n, g = len(cost), len(starts)
    sizes = np.diff(np.append(starts, n))
    group = np.repeat(np.arange(g), sizes)
    plain = np.where(cost < 0, 0, cost)
    run = np.cumsum(plain)
    run += np.repeat(used - (run[starts] - plain[starts]), sizes) if g else 0
    bad = (cost < 0) | (run > total)
    can = (cost >= 0) & (cost <= total - used[group])
    if refuse_when_exhausted:
        bad |= (run - plain) >= total
        can &= used[group] < total
    some_bad = np.bincount(group[bad], minlength=g) > 0
    some_can = np.bincount(group[can], minlength=g) > 0
    admitted = ~some_bad[group]
    after = np.where(admitted, run, used[group])
    left = used.copy()
    whole = np.flatnonzero(~some_bad)
    left[whole] = run[starts[whole] + sizes[whole] - 1]
    for k in np.flatnonzero(some_bad & some_can):
        at = slice(int(starts[k]), int(starts[k] + sizes[k]))
        admitted[at], after[at], left[k] = greedy_admit(cost[at], int(used[k]), total, refuse_when_exhausted)
    return admitted, after, left
