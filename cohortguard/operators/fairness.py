"""Group fairness metrics.

Per-group rates come from one conditional aggregation (partial aggregates
combine map-side, so a dominant group costs nothing extra); the gap is
max − min over groups, which equals the absolute difference for two groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = 1e-10


def group_rates(df: DataFrame, y_pred: str, group: str, y_true: str | None = None) -> DataFrame:
    """Positive rate (and TPR/FPR when ``y_true`` is given) per group."""
    p = F.col(y_pred).cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(p).alias("positive_rate")]
    if y_true is not None:
        t = F.col(y_true).cast("int")
        q = F.col(y_pred).cast("int")
        tp = F.sum(((t == 1) & (q == 1)).cast("long"))
        fn = F.sum(((t == 1) & (q == 0)).cast("long"))
        fp = F.sum(((t == 0) & (q == 1)).cast("long"))
        tn = F.sum(((t == 0) & (q == 0)).cast("long"))
        aggs += [(tp / (tp + fn + F.lit(EPS))).alias("tpr"), (fp / (fp + tn + F.lit(EPS))).alias("fpr")]
    return df.groupBy(group).agg(*aggs)


def demographic_parity_difference(df: DataFrame, y_pred: str, group: str) -> DataFrame:
    """D3: max − min positive rate over groups."""
    r = group_rates(df, y_pred, group)
    return r.agg((F.max("positive_rate") - F.min("positive_rate")).alias("demographic_parity_difference"),
                 F.max("positive_rate").alias("max_rate"), F.min("positive_rate").alias("min_rate"),
                 F.count(F.lit(1)).alias("n_groups"))


def equalized_odds_difference(df: DataFrame, y_true: str, y_pred: str, group: str) -> DataFrame:
    """Max − min of TPR and of FPR over groups (1e-10 guards empty cells)."""
    r = group_rates(df, y_pred, group, y_true)
    return r.agg((F.max("tpr") - F.min("tpr")).alias("tpr_difference"),
                 (F.max("fpr") - F.min("fpr")).alias("fpr_difference"),
                 F.count(F.lit(1)).alias("n_groups"))


def disparate_impact_ratio(df: DataFrame, y_pred: str, group: str, threshold: float = 0.8) -> DataFrame:
    """Min rate / (max rate + 1e-10) and the four-fifths flag."""
    r = group_rates(df, y_pred, group)
    ratio = F.min("positive_rate") / (F.max("positive_rate") + F.lit(EPS))
    return (r.agg(ratio.alias("disparate_impact_ratio"), F.count(F.lit(1)).alias("n_groups"))
            .withColumn("passes_four_fifths", F.col("disparate_impact_ratio") >= F.lit(threshold)))
