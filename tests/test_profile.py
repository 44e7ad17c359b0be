"""Profile quantiles and value counts."""

import random

from pyspark.sql import functions as F

from cohortguard.operators import metrics as M


def test_quantiles_are_within_the_stated_rank_error(spark):
    rng = random.Random(1)
    values = [rng.gauss(0, 1) if i % 3 else 0.5 for i in range(60_000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 50, "v double").repartition(7)
    got = {r.metric: r.value for r in M.profile(df, ["v"], quantiles=(0.01, 0.25, 0.5, 0.999)).collect()}
    assert got["nulls"] == 50 and got["rows"] == 60_050
    for q in (0.01, 0.25, 0.5, 0.999):
        v = got[f"q{100 * q:g}"]
        below, upto = sum(x < v for x in values), sum(x <= v for x in values)
        slack = len(values) / M.RANK_ACCURACY + 1
        assert below - slack <= q * len(values) <= upto + slack


def test_profile_without_rows(spark):
    got = {r.metric: r.value for r in M.profile(spark.createDataFrame([], "v double"), ["v"]).collect()}
    assert got["rows"] == 0 and got["nulls"] == 0 and got["mean"] is None and got["q50"] is None


def test_value_counts_of_a_hot_value_and_nulls(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 50)).alias("a"),
                                 F.when(F.col("id") < 100, None).otherwise(F.col("id") % 2).alias("column"))
    got = {(r["column"], r.value): (r.n, r.share) for r in M.value_counts(df, ["a", "column"]).collect()}
    assert got["a", "hot"] == (300, 300 / 900) and got["column", None] == (100, 100 / 900)
    assert sum(n for (c, _), (n, _) in got.items() if c == "a") == 900
    assert M.value_counts(df.limit(0), ["a"]).count() == 0
