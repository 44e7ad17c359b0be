"""Contribution bounds per subject."""

import math

import pytest

from cohortguard.operators import dp as DP

BOUND = DP.SubjectBound("subject", "id", max_groups=2, max_rows=3)


def rows(spark, more=()):
    base = [(i, i % 20, "abcd"[i % 4], float(i % 9)) for i in range(200)]
    return spark.createDataFrame([*base, *more], "id long, subject long, g string, v double")


def test_bounds_hold_whatever_a_subject_has(spark):
    heavy = [(1000 + i, 99, "abcd"[i % 4], 9.0) for i in range(500)] + [(5000 + i, None, "a", 1.0) for i in range(9)]
    kept = BOUND.apply(rows(spark, heavy), ["g"])
    per = kept.groupBy("subject", "g").count().collect()
    assert max(r["count"] for r in per) == 3
    groups = {}
    for r in per:
        groups.setdefault(r.subject, set()).add(r.g)
    assert max(map(len, groups.values())) == 2 and len(groups[99]) == 2 and groups[None] == {"a"}
    assert len(groups) == 22  # nobody is left out
    assert kept.columns == ["id", "subject", "g", "v"]


@pytest.mark.parametrize("mechanism", ["laplace", "gaussian"])
def test_a_subject_moves_a_release_by_the_stated_amount_at_most(spark, mechanism):
    heavy = [(1000 + i, 99, "abcd"[i % 4], 50.0) for i in range(25)]

    def cells(df, f, col):
        return {r.g: r[col] for r in f(df).collect()}
    for f, col, bound in (
            (lambda d: DP.dp_count(d, ["g"], 1.0, 1, mechanism=mechanism, subject=BOUND), "dp_count", 1.0),
            (lambda d: DP.dp_sum(d, ["g"], "v", 0.0, 9.0, 1.0, 1, mechanism=mechanism, subject=BOUND), "dp_sum", 9.0)):
        a, b = cells(rows(spark), f, col), cells(rows(spark, heavy), f, col)  # the same noise in both
        moved = [abs(a[g] - b[g]) for g in a]
        size = sum(moved) if mechanism == "laplace" else math.sqrt(sum(m * m for m in moved))
        assert 0 < size <= BOUND.sensitivity(bound, mechanism) + 1e-6


def test_the_choice_does_not_depend_on_partitions(spark):
    df = rows(spark, [(1000 + i, 99, "abcd"[i % 4], 1.0) for i in range(50)])
    picks = [sorted(r.id for r in BOUND.apply(df.repartition(n), ["g"]).collect()) for n in (1, 5)]
    assert picks[0] == picks[1]
    assert BOUND.apply(df.limit(0), ["g"]).count() == 0
    with pytest.raises(ValueError):
        DP.SubjectBound("subject", "id", 0, 1)


def test_map_side_limits(spark):
    plan = BOUND.apply(rows(spark), ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
