"""Privacy-risk and data-quality metrics as aggregations.

All of these are partial/final aggregates (map-side combine before the
shuffle) or windows over pre-aggregated tables; none collects rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.prf import keyed_uniform
from .prefix import exclusive_prefix


# --------------------------------------------------------------------------
# D1 / D2 — k-anonymity
# --------------------------------------------------------------------------

def equivalence_classes(df: DataFrame, qi: Sequence[str], nulls: str = "drop") -> DataFrame:
    """Size of every equivalence class of the quasi-identifiers ``qi``.

    ``nulls='drop'`` ignores rows with a null quasi-identifier (as a pandas
    group-by does); ``nulls='group'`` keeps null as its own value.
    """
    qi = list(qi)
    if nulls == "drop":
        df = df.dropna(subset=qi)
    elif nulls != "group":
        raise ValueError("nulls must be 'drop' or 'group'")
    return df.groupBy(*qi).agg(F.count(F.lit(1)).alias("class_size"))


def k_anonymity(df: DataFrame, qi: Sequence[str], nulls: str = "drop") -> DataFrame:
    """k = smallest equivalence class; also class and row counts."""
    return (equivalence_classes(df, qi, nulls)
            .agg(F.min("class_size").alias("k"),
                 F.count(F.lit(1)).alias("n_classes"),
                 F.sum("class_size").cast("long").alias("n_rows")))


def k_violations(df: DataFrame, qi: Sequence[str], k: int = 5, nulls: str = "drop") -> DataFrame:
    """Equivalence classes smaller than ``k`` (their rows are at risk)."""
    return equivalence_classes(df, qi, nulls).where(F.col("class_size") < k)


def k_violation_summary(df: DataFrame, qi: Sequence[str], k: int = 5, nulls: str = "drop") -> DataFrame:
    small = F.col("class_size") < k
    return (equivalence_classes(df, qi, nulls)
            .agg(F.sum(small.cast("int")).cast("long").alias("n_violating_classes"),
                 F.sum(F.when(small, F.col("class_size")).otherwise(0)).cast("long").alias("n_rows_at_risk"),
                 F.sum(F.when(~small, F.col("class_size")).otherwise(0)).cast("long").alias("n_rows_safe"),
                 F.lit(k).alias("k_target")))


# --------------------------------------------------------------------------
# B13 — re-identification risk score
# --------------------------------------------------------------------------

def reidentification_risk(mia_auc, k, max_k: int = 50) -> Column:
    """60·max(0,(auc−.5)/.5) + 40·max(0, 1 − min(k, max_k)/max_k), 1 decimal."""
    auc = F.col(mia_auc) if isinstance(mia_auc, str) else mia_auc
    kk = F.col(k) if isinstance(k, str) else k
    mia = F.greatest(F.lit(0.0), (auc.cast("double") - F.lit(0.5)) / F.lit(0.5)) * F.lit(60.0)
    krisk = F.greatest(F.lit(0.0), F.lit(1.0) - F.least(kk.cast("double"), F.lit(float(max_k)))
                       / F.lit(float(max_k))) * F.lit(40.0)
    return F.round(mia + krisk, 1)


# --------------------------------------------------------------------------
# D6 — exact ROC AUC with ties
# --------------------------------------------------------------------------

def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
            n_buckets: int = 64) -> DataFrame:
    """Exact area under the ROC curve (ties count one half).

    AUC = Σ_s pos(s) · (neg(< s) + neg(= s)/2) / (P·N), computed from the
    distinct-score table (one row per (group, score)); the running count of
    negatives uses a bucketed distributed prefix, so neither a global sort
    nor a hot group lands in one task.  Null when a group has one class.
    """
    by = list(by)
    per = (df.select(*by, F.col(score).cast("double").alias("_s"), F.col(label).cast("int").alias("_y"))
           .where(F.col("_s").isNotNull() & F.col("_y").isNotNull())
           .groupBy(*by, "_s")
           .agg(F.sum("_y").cast("long").alias("_pos"),
                F.sum(F.lit(1) - F.col("_y")).cast("long").alias("_neg")))
    pref = exclusive_prefix(per, "_s", ["_neg"], groups=by, n_buckets=n_buckets)
    contrib = F.col("_pos").cast("double") * (F.col("_neg_before").cast("double")
                                              + F.col("_neg").cast("double") / F.lit(2.0))
    agg = pref.groupBy(*by).agg(F.sum(contrib).alias("_num"),
                                F.sum("_pos").cast("long").alias("n_pos"),
                                F.sum("_neg").cast("long").alias("n_neg"))
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 F.col("_num") / (F.col("n_pos").cast("double") * F.col("n_neg").cast("double")))
    return agg.select(*by, auc.alias("auc"), "n_pos", "n_neg")


# --------------------------------------------------------------------------
# B7 / B8 — scaling and linear scores
# --------------------------------------------------------------------------

def moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One aggregation pass: count, mean, population and sample std per column."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__sdp"),
                 F.stddev_samp(c).alias(f"{c}__sds")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def standardize(df: DataFrame, cols: Sequence[str], stats: DataFrame | None = None) -> DataFrame:
    """(x − mean) / population std; a constant column divides by 1.

    ``stats`` (from :func:`moments`) may come from a different table, e.g.
    scale a test split with training moments.  The one-row statistics enter
    as scalar subqueries (Spark merges them into one aggregation), so the
    scaling itself is a narrow projection.
    """
    st = stats if stats is not None else moments(df, cols)
    out = []
    for c in df.columns:
        if c in cols:
            mean = st.select(f"{c}__mean").scalar()
            sd = st.select(f"{c}__sdp").scalar()
            sd = F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
            out.append(((F.col(c).cast("double") - mean) / sd).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def linear_score(cols: Sequence[str], weights: Sequence[float], bias: float = 0.0) -> Column:
    """X·w + b as one Column expression."""
    if len(cols) != len(weights):
        raise ValueError("one weight per column")
    expr = F.lit(float(bias))
    for c, w in zip(cols, weights):
        expr = expr + F.col(c).cast("double") * F.lit(float(w))
    return expr


def array_linear_score(arr_col: str, weights: Sequence[float], bias: float = 0.0) -> Column:
    """B8 for an ARRAY<DOUBLE> feature column."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    prods = F.zip_with(F.col(arr_col), w, lambda a, b: a * b)
    return F.aggregate(prods, F.lit(float(bias)), lambda acc, x: acc + x)


def score_error(df: DataFrame, a: str, b: str) -> DataFrame:
    """Largest absolute gap between two score columns."""
    return df.agg(F.max(F.abs(F.col(a) - F.col(b))).alias("max_error"))


# --------------------------------------------------------------------------
# D7 / D8 — synthetic data quality
# --------------------------------------------------------------------------

def marginal_fidelity(real: DataFrame, synth: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D7 per column: |mean_real − mean_synth| / (sd_real + 1e-9).

    One aggregation pass per table; the two one-row results are unpivoted
    with ``stack`` into one row per column.
    """
    def long(df, prefix):
        m = moments(df, cols)
        pairs = ", ".join(f"'{c}', `{c}__mean`, `{c}__sds`" for c in cols)
        return m.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, {prefix}_mean, {prefix}_sd)")
    r = long(real, "real")
    s = long(synth, "synth").select("column", "synth_mean")
    return (r.join(s, "column")
            .withColumn("std_gap", F.abs(F.col("real_mean") - F.col("synth_mean"))
                        / (F.coalesce(F.col("real_sd"), F.lit(0.0)) + F.lit(1e-9))))


def fidelity_score(per_column: DataFrame) -> DataFrame:
    """D7 total: max(0, 100 − 50 · mean standardized gap)."""
    return per_column.agg(F.greatest(F.lit(0.0), F.lit(100.0) - F.lit(50.0) * F.avg("std_gap"))
                          .alias("fidelity_score"))


def tstr_composite(fidelity, auc_tstr, auc_real, mia_advantage) -> list[Column]:
    """utility = min(100, 100·tstr/max(real, .51)), resistance =
    max(0, 100 − 200·advantage), overall = .3·fidelity + .5·utility + .2·resistance."""
    def c(x):
        return F.col(x) if isinstance(x, str) else x
    utility = F.round(F.least(F.lit(100.0), F.lit(100.0) * c(auc_tstr)
                              / F.greatest(c(auc_real), F.lit(0.51))), 1)
    resistance = F.round(F.greatest(F.lit(0.0), F.lit(100.0) - c(mia_advantage) * F.lit(200.0)), 1)
    overall = F.round(F.lit(0.30) * c(fidelity) + F.lit(0.50) * utility + F.lit(0.20) * resistance, 1)
    return [utility.alias("utility_score"), resistance.alias("mia_resistance_score"),
            overall.alias("overall_tstr_score")]


# --------------------------------------------------------------------------
# A10 — exact stratified split
# --------------------------------------------------------------------------

#: Ranges of the keyed uniform that a selection counts.
SELECT_RANGES = 1 << 16


def mark_lowest(df: DataFrame, n: Column, seed, stream: str, id_col: str, out: str,
                by: str | None = None, ranges: int = SELECT_RANGES) -> DataFrame:
    """Add boolean ``out``: whether a row is among the lowest of its group by a
    keyed uniform of its id (ties by id); exactly as many as ``n`` says.

    ``n`` is an expression over ``_rows``, the rows of the group (all rows
    without ``by``; nulls of ``by`` are one group).  An order statistic by
    counting: one aggregation counts the rows of every range of the uniform,
    which tells the range that the last wanted row lies in.  Rows of lower
    ranges are in and rows of higher ones out, in a narrow step; only the rows
    of that one range, a share of 1 / ``ranges``, are ranked.  Nothing sorts or
    moves the table.  Rows with a null id come last.
    """
    u_, range_, group_, border_, some_, of_ = (f"_{uuid.uuid4().hex}" for _ in range(6))  # names no table has
    u = keyed_uniform(seed, stream, F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    place = F.when(F.col(id_col).isNull(), F.lit(ranges)).otherwise(F.floor(u * ranges)).cast("int")
    group = F.struct((F.col(by) if by else F.lit(0)).alias("g"))
    rows = df.withColumns({u_: u, range_: place, group_: group})
    counts = rows.groupBy(F.col(group_).alias(of_), F.col(range_).alias(border_)).agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(of_).orderBy(border_).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = (counts.withColumns({"_upto": F.sum("_c").over(upto), "_rows": F.sum("_c").over(Window.partitionBy(of_))})
             .withColumn("_n", n.cast("long")))
    # the range of the last wanted row, and how many of its rows are wanted
    border = (steps.where((F.col("_upto") >= F.col("_n")) & (F.col("_upto") - F.col("_c") < F.col("_n")))
              .select(of_, border_, (F.col("_n") - F.col("_upto") + F.col("_c")).alias(some_)))
    known = rows.join(border, F.col(group_).eqNullSafe(F.col(of_)), "left")
    last = F.coalesce(F.col(range_) == F.col(border_), F.lit(False))
    clear = known.where(~last).withColumn(out, F.coalesce(F.col(range_) < F.col(border_), F.lit(False)))
    rank = F.row_number().over(Window.partitionBy(group_).orderBy(u_, id_col))
    tied = known.where(last).withColumn(out, rank <= F.col(some_))
    return clear.unionByName(tied).select(*df.columns, out)


def split_train_test(df: DataFrame, id_col: str, train_frac: float, seed,
                     stratify: str | None = None) -> DataFrame:
    """A10: add ``is_train``; exactly round(n · train_frac) rows, of each class
    of ``stratify`` where one is given.

    The rows lowest by a keyed uniform of the id (ties by id) are the training
    rows; see :func:`mark_lowest` for how they are found without a sort.
    """
    n = F.round(F.col("_rows").cast("double") * F.lit(float(train_frac)))
    return mark_lowest(df, n, seed, "split", id_col, "is_train", stratify)


def stratified_folds(df: DataFrame, id_col: str, label: str, folds: int, seed) -> DataFrame:
    """Add ``fold`` 0 .. folds − 1: the rows of each class are dealt round
    robin in the order of a keyed uniform of the id (ties by id), so every
    fold's class counts differ by at most one."""
    ranked = exclusive_prefix(df.withColumn("_u", keyed_uniform(seed, "fold", id_col)).withColumn("_one", F.lit(1)),
                              "_u", ["_one"], groups=[label], tie_cols=[id_col])
    return (ranked.withColumn("fold", F.pmod("_one_before", F.lit(folds)).cast("int"))
            .drop("_u", "_one", "_one_before"))


# --------------------------------------------------------------------------
# D24 — dataset profile
# --------------------------------------------------------------------------

#: Shares of the rows whose quantiles a profile states.
QUANTILES = (0.25, 0.5, 0.75)
#: A stated quantile's rank is off by at most 1 / this of the rows.
RANK_ACCURACY = 10_000


def profile(df: DataFrame, numeric: Sequence[str], label: str | None = None,
            quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Long-form profile (metric, column, value) from one aggregation pass.

    Row count, label prevalence, and per column: nulls, mean, sample std, min,
    max and quantiles (``q25`` …).  Quantiles are values of the column, from a
    mergeable sketch with a rank error of at most ``1 / RANK_ACCURACY`` of the
    rows; nulls have no part in them.  Without rows, counts are zero and the
    rest is null.
    """
    aggs = [F.count(F.lit(1)).cast("double").alias("rows||")]
    if label:
        aggs.append(F.avg(F.col(label).cast("double")).alias(f"prevalence||{label}"))
    for c in numeric:
        aggs += [F.coalesce(F.sum(F.col(c).isNull().cast("int")), F.lit(0)).cast("double").alias(f"nulls||{c}"),
                 F.avg(c).cast("double").alias(f"mean||{c}"),
                 F.stddev_samp(c).cast("double").alias(f"std||{c}"),
                 F.min(c).cast("double").alias(f"min||{c}"),
                 F.max(c).cast("double").alias(f"max||{c}")]
        if quantiles:
            sketch = F.percentile_approx(c, list(quantiles), RANK_ACCURACY)
            aggs += [sketch[i].cast("double").alias(f"q{100 * q:g}||{c}") for i, q in enumerate(quantiles)]
    one = df.agg(*aggs)
    names = [a for a in one.columns]
    pairs = ", ".join(f"'{n.split('||')[0]}', '{n.split('||')[1]}', `{n}`" for n in names)
    return one.selectExpr(f"stack({len(names)}, {pairs}) AS (metric, column, value)")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, n, share)``, how often each value of the columns
    occurs; null is a value.

    All columns in one pass: a row becomes one (column, value) pair for each,
    and equal pairs are added up before anything moves, so a value that a third
    of the rows share costs one row a task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = (df.select(F.explode(pairs).alias("p")).groupBy("p.column", "p.value").agg(F.count(F.lit(1)).alias("n")))
    return counts.withColumn("share", F.col("n") / df.agg(F.count(F.lit(1))).scalar())
