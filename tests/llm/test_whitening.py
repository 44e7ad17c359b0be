"""Whitening against numpy's eigenvectors, and its eigensolver on hard matrices."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortguard.llm.queries import op13_embedding_whitening
from cohortguard.llm.whitening import fit_whitener, integer_vectors, leading_eigenvectors, polar, whiten


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))
    return (q * values) @ q.T


@pytest.mark.parametrize("values", [
    [5.0], [3.0, 3.0, 3.0], [1.0, 2.0, 3.0], [9.0, 4.0, 1.0, 0.0, 0.0], [-2.0, -1.0, 0.0, 1.0, 2.0],
    [1e8, 1.0, 1e-8], [7.0, 7.0, 1.0, 1.0], list(range(1, 41)), [1 + 1e-9 * k for k in range(6)]])
def test_eigenvectors(values):
    a = symmetric(values)
    got, vectors = leading_eigenvectors(a, 4)
    want = np.sort(values)[::-1][:4]
    scale = max(map(abs, values))
    assert np.allclose(got, want, atol=1e-13 * scale * len(values), rtol=0)
    assert np.allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-13)
    assert np.linalg.norm(a @ vectors - vectors * got) <= 1e-12 * scale * len(values)


def test_polar_factor():
    a = symmetric([5.0, 1e-6, -1e-3, -4.0])
    sign = polar(a)
    assert np.allclose(sign @ sign, np.eye(4), atol=1e-9)
    assert np.allclose(sign @ a, a @ sign, atol=1e-9) and round(np.trace(sign)) == 0
    assert polar(np.zeros((2, 2)) + 1) is None or abs(np.trace(polar(np.ones((2, 2))))) <= 2


def brute(vectors, components=4):
    """(vec_id, component) -> (n, deviation, |whitened|, explained)."""
    rows = []
    for i, v in vectors:
        if v and all(c is not None and math.isfinite(c) for c in v):
            rows.append((i, tuple(math.floor(256 * float(c)) for c in v)))
    fit = sorted({x for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    out = []
    for i, x in rows:
        d = [n * a - s for a, s in zip(x, sums)]
        for k in range(len(e)):
            out.append((i, k + 1, n, sum(v * v for v in d), abs(np.array(d) / n @ u[:, k]) / math.sqrt(e[k]),
                        e[k] / np.trace(cov)))
    return out


def check(got, want):
    got = sorted((r.vec_id if r.vec_id is not None else -1, r.component, r.n, int(r.deviation), abs(r.whitened), r.explained)
                 for r in got)
    want = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in want)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-7, atol=1e-9)


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def test_against_numpy(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 12)) * np.geomspace(9, 0.2, 12)
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(200)]  # a hot vector
    rows += [(7, rows[7][1], 0), (None, rows[3][1], 0), (2000, None, 0), (2001, [1.0] * 11 + [None], 0),
             (2002, [math.nan] * 12, 0), (2003, [math.inf] + [0.0] * 11, 0), (2004, [], 0), (2005, [-0.0] * 12, 0)]
    df = table(spark, rows).repartition(7)
    got = whiten(df).collect()
    check(got, brute([r[:2] for r in rows]))
    assert {r.identity_error for r in got}.pop() < 1e-9 and len({r.identity_error for r in got}) == 1
    clash = df.select("*", *[F.col("vec_id").alias(c) for c in ("id", "x", "v", "n", "component", "whitened", "dim")])
    check(whiten(clash).collect(), brute([r[:2] for r in rows]))


def test_whole_table(spark):
    from tests.conftest import SF_ORACLE
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").collect()]
    got = op13_embedding_whitening(spark, SF_ORACLE).collect()
    check(got, brute(rows))
    assert got[0].identity_error < 1e-9


def test_odd_tables(spark):
    assert whiten(table(spark, [])).count() == 0
    assert whiten(table(spark, [(1, None, 0), (2, [], 0)])).count() == 0
    assert whiten(table(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).count() == 0  # no variance
    flat = whiten(table(spark, [(i, [float(i), 2.0 * i, 0.0], 0) for i in range(5)])).collect()
    assert {r.component for r in flat} == {1} and flat[0].explained == pytest.approx(1)
    mixed = whiten(table(spark, [(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [4.0, 5.0], 0), (4, [1.0], 0)])).collect()
    assert {r.vec_id for r in mixed} == {1, 2, 3}


def test_huge_entries_stay_exact(spark):
    rows = [(i, [float(2 ** 50 + i * 2 ** 40), float(i * i)], 0) for i in range(6)]
    check(whiten(table(spark, rows, "double"), components=1).collect(), brute([r[:2] for r in rows], 1))


def test_no_vector_counts_twice(spark):
    rows = [(i, [float(i % 3), float(i % 2)], 0) for i in range(60)]
    assert fit_whitener(integer_vectors(table(spark, rows), "embedding", "vec_id")).n == 6
