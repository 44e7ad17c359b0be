"""Privacy-budget accounting: ordered gate, greedy allocation, status.

Budgets and charges are ``BIGINT`` micro-epsilon (1 ε = 1,000,000), so
admission decisions are exact and identical in every engine.

Two physical paths give the same answer:

* **fold** — hash-partition by budget, sort, stream through a constant-size
  state (:mod:`.fold`).  One task per budget: right for the many ordinary
  budgets.
* **split** — for budgets holding more than ``hot_rows`` operations.  The
  gate is decided in rounds of distributed prefix sums (:mod:`.prefix`),
  so a budget holding a third of all rows is spread over every task:

  1. with ``used`` consumed so far, an operation whose cost exceeds
     ``total − used`` can never be admitted (``used`` only grows) — it is
     *dead*; every other remaining operation is *live*;
  2. the exclusive prefix sum of live costs tells, for every live row,
     whether it still fits if all live rows before it were admitted; the
     rows that fit form a prefix, so everything before the first row that
     does not fit is final (live → admitted, dead → refused), that row is
     refused, and ``used`` grows by the live costs before it;
  3. the refused row's cost now exceeds ``total − used``; rows that this makes
     dead are refused at once, and rounds go on while a budget has more than
     ``fold_rows`` rows left; what a round leaves of the others is folded.
     Each round kills a cost value, so there are at most as many rounds as
     distinct costs in a budget, plus one; far fewer in practice, as what is
     left of a budget shrinks with every round.
"""

from __future__ import annotations

import datetime
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, sized_broadcast
from .fold import greedy_admit, ordered_fold
from .prefix import buckets_for, exclusive_prefix

MICRO = 1_000_000

# A budget with more operations than this is decided by the split path.
HOT_ROWS = 2_000_000


def to_micro(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * F.lit(MICRO)).cast("long")


# --------------------------------------------------------------------------
# Hot-budget split
# --------------------------------------------------------------------------

def hot_keys(df: DataFrame, key: str, max_rows: int) -> DataFrame:
    """Keys holding more than ``max_rows`` rows (a partially aggregated count;
    at most ``rows / max_rows`` keys, so the result is size-bounded)."""
    return df.groupBy(key).count().where(F.col("count") > F.lit(max_rows)).select(key)


def order_number(df: DataFrame, col: str) -> Column:
    """A number that never falls as ``col`` grows, for range bucketing (exact for
    integers, dates and microsecond timestamps; texts by their first bytes, so
    ``col`` itself must break ties)."""
    dt = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dt, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit(datetime.datetime(1970, 1, 1)).cast("timestamp_ntz"), c)
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dt, T.DateType):
        return F.unix_date(c)
    if isinstance(dt, T.NumericType):
        return c
    if isinstance(dt, T.StringType):
        return F.conv(F.rpad(F.substring(F.hex(c.cast("binary")), 1, 14), 14, "0"), 16, 10).cast("long")
    raise TypeError(f"order column {col} must be numeric, text, date or timestamp, not {dt}")


def _differs(rows: pa.Table, columns) -> np.ndarray:
    """Where a row differs from the one before it (NaN and null are values)."""
    out = np.zeros(rows.num_rows, bool)
    out[:1] = True
    for c in columns:
        code = rows[c].combine_chunks().dictionary_encode("encode").indices.to_numpy()
        out[1:] |= code[1:] != code[:-1]
    return out


def _fold_rest(rest: DataFrame, budget_col: str, order_cols, cost_col: str, refuse_when_exhausted: bool) -> DataFrame:
    """Decide what a round left of budgets, one task per budget, from ``_used``
    on.  Columns pass as they are.  As in a round, a refused row takes rows
    equal to it in order and cost with it."""
    schema = T.StructType([*rest.schema.fields, T.StructField("_admitted", T.BooleanType(), False)])
    place = [budget_col, *order_cols, cost_col]

    def run(batches):
        held, last, used = None, None, 0
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                rows, held = held, None
            else:
                rows = pa.Table.from_batches([batch])
                rows = pa.concat_tables([held, rows]) if held is not None else rows
                cut = int(np.flatnonzero(_differs(rows, place))[-1]) if rows.num_rows else 0
                rows, held = rows.slice(0, cut), rows.slice(cut)  # equal rows stay together
            if rows is None or not rows.num_rows:
                continue
            starts = np.flatnonzero(_differs(rows, [budget_col]))
            cost, total, before = (rows[c].to_numpy() for c in (cost_col, "total_micro", "_used"))
            keys = rows[budget_col]
            admitted = np.zeros(len(cost), bool)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(cost)]):
                k = keys[a].as_py()
                if k != last and (k == k or last == last):  # NaN is one key
                    last, used = k, int(before[a])
                admitted[a:b], _, used = greedy_admit(cost[a:b], used, int(total[a]), refuse_when_exhausted)
            same = np.cumsum(_differs(rows, place)) - 1
            admitted &= (np.bincount(same, ~admitted) == 0)[same]
            yield from rows.append_column("_admitted", pa.array(admitted)).combine_chunks().to_batches()

    return rest.repartition(budget_col).sortWithinPartitions(budget_col, *order_cols, cost_col).mapInArrow(run, schema)


def split_admit(rows: DataFrame, budget_col: str, order_col: str, tie_cols, cost_col: str,
                refuse_when_exhausted: bool, fold_rows: int = HOT_ROWS) -> DataFrame:
    """Skip-fold decisions for hot budgets by rounds of prefix sums.

    ``rows``: ``budget_col``, numeric ``order_col`` (+ ``tie_cols``, unique per
    budget), ``cost_col``, ``total_micro`` and ``_used0`` (consumed before
    these rows).  Adds ``_admitted``; a null cost is refused.  Each round's state is checkpointed, so
    lineage stays one round long and a lost executor recomputes one round.
    Budgets of which a round leaves at most ``fold_rows`` rows are folded.
    """
    tie_cols = list(tie_cols)
    total, cost = F.col("total_micro"), F.col(cost_col)
    pending = rows.withColumn("_k", F.struct(order_col, *tie_cols)).withColumn("_used", F.col("_used0"))
    work = [c for c in pending.columns]
    decided = [c for c in work if c != "_k"]
    parts = []

    def alive(used: Column) -> Column:
        live = (cost >= 0) & (cost <= total - used)
        return F.coalesce(live & (used < total) if refuse_when_exhausted else live, F.lit(False))

    n_buckets = buckets_for(rows, [budget_col])
    while True:
        p = (pending.withColumn("_live", alive(F.col("_used")))
             .withColumn("_lc", F.when(F.col("_live"), cost).otherwise(F.lit(0)).cast("long")))
        p = materialize(exclusive_prefix(p, order_col, ["_lc"], [budget_col], tie_cols, n_buckets))
        before = F.col("_used") + F.col("_lc_before")
        fits = before + cost <= total
        if refuse_when_exhausted:
            fits = fits & (before < total)
        first_bad = (p.where(F.col("_live") & ~fits).groupBy(budget_col)
                     .agg(F.min(F.struct("_k", "_lc_before")).alias("_fb")))
        j = p.join(first_bad, budget_col, "left")
        used = F.col("_used") + F.col("_fb._lc_before")
        still_open = F.coalesce((F.col("_k") > F.col("_fb._k")) & alive(used), F.lit(False))
        parts.append(j.where(~still_open).select(
            *decided, (F.col("_live") & (F.col("_fb").isNull() | (F.col("_k") < F.col("_fb._k")))).alias("_admitted")))
        pending = materialize(j.where(still_open).withColumn("_used", used).select(*work))
        rest, pending = _split_hot(pending, budget_col, fold_rows)
        parts.append(_fold_rest(rest.drop("_k"), budget_col, [order_col, *tie_cols], cost_col, refuse_when_exhausted))
        if pending is None:
            break
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("_used")


def _split_hot(ops: DataFrame, budget_col: str, hot_rows: int | None):
    """(cold ops, hot ops) or (ops, None) when no budget is hot."""
    if hot_rows is None:
        return ops, None
    hot = materialize(hot_keys(ops, budget_col, hot_rows))
    if hot.isEmpty():
        return ops, None
    hot = sized_broadcast(hot)
    return ops.join(hot, budget_col, "left_anti"), ops.join(hot, budget_col, "left_semi")


# --------------------------------------------------------------------------
# E4 — ordered gate
# --------------------------------------------------------------------------

def consume_budget(ops: DataFrame, budgets: DataFrame | int, order=("seq",),
                   budget_col: str = "budget_id", cost_col: str = "epsilon_micro",
                   num_partitions: int | None = None, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Admit each operation in ``order`` if it still fits its budget.

    An admitted operation adds its cost; a refused one consumes nothing, and
    once a budget is exhausted every later operation (even a free one) is
    refused.  Negative costs are refused.  ``budgets`` is a DataFrame
    ``(budget_id, total_micro)`` or one total for every budget.

    Adds ``allowed BOOLEAN`` and ``cumulative_micro BIGINT`` (consumption
    after the row was decided).  Not a running sum — a refused row is
    skipped — so it runs as a streaming fold per budget, or, for budgets
    with more than ``hot_rows`` operations, by the split path (module doc).
    ``order`` must be unique within a budget.
    """
    if isinstance(budgets, DataFrame):
        ops = ops.join(budgets.select(F.col("budget_id").alias(budget_col), "total_micro"),
                       budget_col, "inner")
    else:
        ops = ops.withColumn("total_micro", F.lit(int(budgets)).cast("long"))

    schema = T.StructType(ops.schema.fields + [
        T.StructField("allowed", T.BooleanType(), False),
        T.StructField("cumulative_micro", T.LongType(), False),
    ])

    def init(first):
        return 0

    def step(used, seg: pd.DataFrame):
        total = int(seg["total_micro"].iat[0])
        cost = seg[cost_col].to_numpy(dtype=np.int64)
        admitted, after, used = greedy_admit(cost, used, total, refuse_when_exhausted=True)
        out = seg.copy()
        out["allowed"] = admitted
        out["cumulative_micro"] = after
        return used, out

    cold, hot = _split_hot(ops, budget_col, hot_rows)
    folded = ordered_fold(cold, [budget_col], list(order), init, step, schema,
                          num_partitions=num_partitions)
    if hot is None:
        return folded
    order = list(order)
    h = hot.withColumn("_o", order_number(hot, order[0])).withColumn("_used0", F.lit(0).cast("long"))
    dec = split_admit(h, budget_col, "_o", order, cost_col, True)
    dec = dec.withColumn("_ac", F.when(F.col("_admitted"), F.col(cost_col)).otherwise(F.lit(0)).cast("long"))
    dec = exclusive_prefix(dec, "_o", ["_ac"], [budget_col], order, buckets_for(hot, [budget_col]))
    split = dec.select(*ops.columns, F.col("_admitted").alias("allowed"),
                       (F.col("_used0") + F.col("_ac_before") + F.col("_ac")).alias("cumulative_micro"))
    return folded.unionByName(split)


def budget_status(charged: DataFrame, budget_col: str = "budget_id",
                  cost_col: str = "epsilon_micro") -> DataFrame:
    """Consumed, remaining, percent and state per budget (from E4 output)."""
    consumed = F.sum(F.when(F.col("allowed"), F.col(cost_col)).otherwise(0)).cast("long")
    return (charged.groupBy(budget_col)
            .agg(F.first("total_micro").alias("total_micro"),
                 consumed.alias("consumed_micro"),
                 F.sum(F.col("allowed").cast("int")).cast("long").alias("n_allowed"),
                 F.sum((~F.col("allowed")).cast("int")).cast("long").alias("n_blocked"))
            .withColumn("remaining_micro", F.greatest(F.col("total_micro") - F.col("consumed_micro"), F.lit(0)))
            .withColumn("pct_consumed", F.try_divide(F.col("consumed_micro") * F.lit(100.0),
                                                     F.col("total_micro")))
            .withColumn("exhausted", F.col("consumed_micro") >= F.col("total_micro"))
            .withColumn("status", F.when(F.col("exhausted"), "EXHAUSTED").otherwise("ACTIVE")))


# --------------------------------------------------------------------------
# E5 — greedy allocation
# --------------------------------------------------------------------------

def allocate_budget(ops: DataFrame, budgets: DataFrame | int, budget_col: str = "budget_id",
                    num_partitions: int | None = None, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """E5: greedy allocation per budget.

    ``ops``: ``budget_id, op_id, seq, epsilon_micro, utility_value,
    priority_tier, can_be_deferred``.  Walks tier 1 in input order, then
    tiers 2–3 by utility density; an op that fits is ALLOCATED, otherwise
    DEFERRED when it can wait and BLOCKED when it cannot.  Epsilon must be
    > 0 (else the op is BLOCKED).  Adds ``status``, ``alloc_rank`` and
    ``remaining_micro`` (budget left after the op).  ``seq`` must be unique
    within a budget.  Budgets with more than ``hot_rows`` ops take the split
    path in two phases (tier 1 by ``seq``, then the rest by density).
    """
    if isinstance(budgets, DataFrame):
        ops = ops.join(budgets.select(F.col("budget_id").alias(budget_col), "total_micro"),
                       budget_col, "inner")
    else:
        ops = ops.withColumn("total_micro", F.lit(int(budgets)).cast("long"))
    later = F.col("priority_tier") > 1
    density = F.try_divide(F.col("utility_value").cast("double"), F.col("epsilon_micro").cast("double"))
    ops = (ops.withColumn("_later", later.cast("int"))
           .withColumn("_neg_density", F.when(later, -density).otherwise(F.lit(0.0))))

    schema = T.StructType(ops.schema.fields + [
        T.StructField("status", T.StringType(), False),
        T.StructField("alloc_rank", T.LongType(), False),
        T.StructField("remaining_micro", T.LongType(), False),
    ])

    def init(first):
        return (0, 0)

    def step(state, seg: pd.DataFrame):
        used, rank = state
        total = int(seg["total_micro"].iat[0])
        cost = seg["epsilon_micro"].to_numpy(dtype=np.int64)
        cost = np.where(cost > 0, cost, total + 1)  # ε ≤ 0 can never be allocated
        admitted, after, used = greedy_admit(cost, used, total, refuse_when_exhausted=False)
        defer = seg["can_be_deferred"].to_numpy(dtype=bool)
        out = seg.copy()
        out["status"] = np.where(admitted, "ALLOCATED", np.where(defer, "DEFERRED", "BLOCKED"))
        n = len(seg)
        out["alloc_rank"] = np.arange(rank + 1, rank + n + 1, dtype=np.int64)
        out["remaining_micro"] = total - after
        return (used, rank + n), out

    cold, hot = _split_hot(ops, budget_col, hot_rows)
    res = ordered_fold(cold, [budget_col], ["_later", "_neg_density", "seq"], init, step, schema,
                       num_partitions=num_partitions)
    if hot is not None:
        res = res.unionByName(_allocate_split(hot, budget_col))
    return res.drop("_later", "_neg_density")


def _allocate_split(hot: DataFrame, budget_col: str) -> DataFrame:
    """E5 for hot budgets: phase A (tier 1, by seq), then phase B (later
    tiers, by density, then seq) starting from what phase A consumed."""
    cols = hot.columns
    total = F.col("total_micro")
    h = hot.withColumn("_cost", F.when(F.col("epsilon_micro") > 0, F.col("epsilon_micro"))
                       .otherwise(total + 1).cast("long"))
    a = split_admit(h.where(F.col("_later") == 0).withColumn("_used0", F.lit(0).cast("long")),
                    budget_col, "seq", [], "_cost", False)
    a = materialize(a.withColumn("_ac", F.when(F.col("_admitted"), F.col("_cost")).otherwise(F.lit(0)).cast("long"))
                    .withColumn("_one", F.lit(1).cast("long")))
    phase_a = (a.groupBy(budget_col)
               .agg(F.sum("_ac").cast("long").alias("_used0"), F.count(F.lit(1)).alias("_n_a")))
    b = (h.where(F.col("_later") == 1).join(phase_a, budget_col, "left")
         .fillna(0, ["_used0", "_n_a"]))
    b = split_admit(b, budget_col, "_neg_density", ["seq"], "_cost", False)
    b = (b.withColumn("_ac", F.when(F.col("_admitted"), F.col("_cost")).otherwise(F.lit(0)).cast("long"))
         .withColumn("_one", F.lit(1).cast("long")))
    n_buckets = buckets_for(hot, [budget_col])
    a = exclusive_prefix(a.withColumn("_n_a", F.lit(0).cast("long")), "seq", ["_ac", "_one"], [budget_col],
                         n_buckets=n_buckets)
    b = exclusive_prefix(b, "_neg_density", ["_ac", "_one"], [budget_col], ["seq"], n_buckets)

    def finish(df):
        used_after = F.col("_used0") + F.col("_ac_before") + F.col("_ac")
        status = (F.when(F.col("_admitted"), F.lit("ALLOCATED"))
                  .when(F.col("can_be_deferred"), F.lit("DEFERRED")).otherwise(F.lit("BLOCKED")))
        return df.select(*cols, status.alias("status"),
                         (F.col("_n_a") + F.col("_one_before") + 1).cast("long").alias("alloc_rank"),
                         (total - used_after).alias("remaining_micro"))
    return finish(a).unionByName(finish(b))


def allocation_summary(allocated: DataFrame, budget_col: str = "budget_id") -> DataFrame:
    """E5 totals: ε used, utility achieved, utilisation %, counts by status."""
    is_alloc = F.col("status") == "ALLOCATED"
    used = F.sum(F.when(is_alloc, F.col("epsilon_micro")).otherwise(0)).cast("long")
    return (allocated.groupBy(budget_col)
            .agg(F.first("total_micro").alias("total_micro"),
                 used.alias("used_micro"),
                 F.round(F.sum(F.when(is_alloc, F.col("utility_value")).otherwise(0.0)), 2).alias("utility_achieved"),
                 F.sum(is_alloc.cast("int")).cast("long").alias("n_allocated"),
                 F.sum((F.col("status") == "DEFERRED").cast("int")).cast("long").alias("n_deferred"),
                 F.sum((F.col("status") == "BLOCKED").cast("int")).cast("long").alias("n_blocked"))
            .withColumn("utilization_pct",
                        F.round(F.try_divide(F.col("used_micro") * F.lit(100.0), F.col("total_micro")), 1)))
