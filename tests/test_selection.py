"""Exact selection by counting."""

import pytest
from pyspark.sql import functions as F

from cohortguard.functions.prf import keyed_uniform
from cohortguard.operators import metrics as M


@pytest.mark.parametrize("ranges", [1, 2, 7, 1 << 16])
@pytest.mark.parametrize("frac", [0.0, 0.3, 0.7, 1.0])
def test_split_takes_the_lowest_exactly(spark, ranges, frac):
    df = spark.range(501).select(F.col("id"), (F.col("id") % 3).alias("c"), F.lit(1).alias("_group")).repartition(4)
    n = F.round(F.col("_rows") * F.lit(frac))
    got = {r.id for r in M.mark_lowest(df, n, 5, "split", "id", "t", ranges=ranges).where("t").collect()}
    order = [r.id for r in df.orderBy(keyed_uniform(5, "split", "id"), "id").collect()]
    assert got == set(order[:round(501 * frac)])


def test_split_per_class_with_nulls_and_hot_classes(spark):
    rows = [(i, "hot" if i % 3 else None if i % 2 else "rare") for i in range(400)] + [(None, "hot"), (7, "hot"), (7, "hot")]
    df = spark.createDataFrame(rows, "id long, c string")
    out = M.split_train_test(df, "id", 0.7, 1, stratify="c")
    counts = {r.c: (r.n, r.t) for r in out.groupBy("c").agg(F.count("*").alias("n"), F.sum(F.col("is_train").cast("int")).alias("t")).collect()}
    assert out.columns == ["id", "c", "is_train"] and sum(n for n, _ in counts.values()) == len(rows)
    assert all(t == int(n * 0.7 + 0.5) for n, t in counts.values())
    assert M.split_train_test(df.limit(0), "id", 0.7, 1).count() == 0


def test_unstratified_split_is_exact(spark):
    df = spark.range(1000)
    assert M.split_train_test(df, "id", 0.7, 3).where("is_train").count() == 700


def test_selection_moves_only_the_border_range(spark):
    plan = M.split_train_test(spark.range(1000), "id", 0.7, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort " not in plan and plan.count("Window") <= 6
