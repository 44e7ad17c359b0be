"""Property tests: invariants that must hold for any input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortguard.functions.noise import gaussian, laplace
from cohortguard.operators import budget as BG
from cohortguard.operators import dp as DP
from cohortguard.operators import federated as FD
from cohortguard.operators import ledger as L
from cohortguard.operators import metrics as M
from cohortguard.operators.fold import greedy_admit
from cohortguard.operators.prefix import buckets_for, exclusive_prefix
from cohortguard.plans import consent as PC
from cohortguard.sources import bindings as B

from .conftest import SF_SMALL


def _fold_reference(costs, total, refuse_when_exhausted=True):
    used, out = 0, []
    for c in costs:
        ok = c >= 0 and used + c <= total and (not refuse_when_exhausted or used < total)
        if ok:
            used += c
        out.append(ok)
    return out


@pytest.mark.parametrize("seed", range(30))
def test_greedy_admit_matches_sequential(seed):
    rng = np.random.default_rng(seed)
    costs = rng.integers(-2, 60, size=rng.integers(0, 80)).astype(np.int64)
    costs[rng.random(len(costs)) < 0.1] = 0
    total = int(rng.integers(0, 600))
    for strict in (True, False):
        adm, after, used = greedy_admit(costs, 0, total, strict)
        assert adm.tolist() == _fold_reference(costs.tolist(), total, strict)
        assert used == int(costs[adm].sum()) <= max(total, 0)


def test_hot_budget_with_text_order_equals_fold(spark):
    rng = np.random.default_rng(5)
    costs = rng.integers(1, 10**6, 5000).tolist()
    df = spark.createDataFrame([("b", f"op-{i:06d}", c) for i, c in enumerate(costs)],
                               "budget_id string, op string, epsilon_micro long")
    total = sum(costs) // 3
    hot, fold = (BG.consume_budget(df, total, order=("op",), hot_rows=h).select("op", "allowed", "cumulative_micro")
                 for h in (0, None))
    assert sorted(hot.collect()) == sorted(fold.collect())


@pytest.mark.parametrize("seed", [0, 1, 2, 3])
def test_split_admit_matches_sequential(spark, seed):
    """Prefix-sum rounds equal the sequential gate."""
    rng = np.random.default_rng(seed)
    rows, expect = [], {}
    for b in range(4):
        n = int(rng.integers(1, 120))
        costs = rng.choice([-1, 0, 3, 7, 20, 45], size=n) if b % 2 else rng.integers(-2, 60, size=n)
        total = int(rng.integers(0, 400))
        for strict in (True, False):
            for i, ok in enumerate(_fold_reference(costs.tolist(), total, strict)):
                expect[(strict, b, i)] = ok
        rows += [(b, i * 10 + int(rng.integers(0, 9)), int(c), total, 0) for i, c in enumerate(costs)]
    df = spark.createDataFrame(rows, "budget_id int, seq long, cost long, total_micro long, _used0 long")
    for strict in (True, False):
        got = BG.split_admit(df, "budget_id", "seq", [], "cost", strict).collect()
        assert len(got) == len(rows)
        assert {(strict, r.budget_id, r.seq // 10): r._admitted for r in got} == \
            {k: v for k, v in expect.items() if k[0] == strict}


@pytest.mark.parametrize("fold_rows, rounds", [(BG.HOT_ROWS, 1), (30, None), (0, None)])
def test_split_admit_folds_what_a_round_leaves(spark, monkeypatch, fold_rows, rounds):
    """one round for budgets of few rows, however many distinct costs they have."""
    rng = np.random.default_rng(8)
    costs = {b: rng.integers(1, 10**4, 60) for b in ("a", "b", "c")}
    rows = [(b, i, int(c), 40_000, 0) for b in costs for i, c in enumerate(costs[b])]
    expect = {(b, i): ok for b in costs for i, ok in enumerate(_fold_reference(costs[b].tolist(), 40_000))}
    calls, plain = [], BG.exclusive_prefix
    monkeypatch.setattr(BG, "exclusive_prefix", lambda *a, **k: calls.append(1) or plain(*a, **k))
    df = spark.createDataFrame(rows, "budget_id string, seq long, cost long, total_micro long, _used0 long")
    got = BG.split_admit(df, "budget_id", "seq", [], "cost", True, fold_rows).collect()
    assert {(r.budget_id, r.seq): r._admitted for r in got} == expect
    assert len(calls) == rounds if rounds else len(calls) > 1


def test_rows_that_come_twice_are_decided_alike_by_rounds_and_fold(spark):
    rng = np.random.default_rng(9)
    rows = [("b", i, int(c), 900, 0) for i, c in enumerate(rng.integers(1, 60, 90))] * 2
    df = spark.createDataFrame(rows, "budget_id string, seq long, cost long, total_micro long, _used0 long")
    found = [sorted(map(tuple, BG.split_admit(df, "budget_id", "seq", [], "cost", True, n).select("seq", "cost", "_admitted").collect()))
             for n in (0, BG.HOT_ROWS)]
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_prefix_ranges_follow_the_largest_group(spark):
    df = spark.createDataFrame([(g, float(o), g + o) for g in range(3) for o in range(20 * (g + 1))], "g int, o double, v int")
    assert [buckets_for(df, ["g"], rows) for rows in (100, 60, 59, 10, 1)] == [1, 1, 2, 6, 60]
    few, many = (exclusive_prefix(df, "o", ["v"], ["g"], n_buckets=n).collect() for n in (1, 16))
    assert sorted(few) == sorted(many)


def test_budget_partition_independent(spark):
    ops = B.budget_ops(spark, SF_SMALL)
    a = {(r.op_id, r.allowed) for r in BG.consume_budget(ops, B.BUDGET_TOTAL_MICRO, order=("ts", "op_id"),
                                                          num_partitions=1).collect()}
    b = {(r.op_id, r.allowed) for r in BG.consume_budget(ops, B.BUDGET_TOTAL_MICRO, order=("ts", "op_id"),
                                                          num_partitions=13).collect()}
    assert a == b
    st = BG.budget_status(BG.consume_budget(ops, B.BUDGET_TOTAL_MICRO, order=("ts", "op_id")))
    assert st.where(F.col("consumed_micro") > F.col("total_micro")).count() == 0


def test_chain_verifies_and_detects_tampering(spark):
    ledger = PC.built_ledger(spark, SF_SMALL).cache()
    ok = L.verify_chain(ledger).collect()
    assert ok and all(r.intact for r in ok)
    # Tamper with one record's action: that shard must report that seq.
    victim = ledger.orderBy("ledger_id", "seq").where("seq = 3").first()
    tampered = ledger.withColumn(
        "action", F.when((F.col("ledger_id") == victim.ledger_id) & (F.col("seq") == 3),
                         F.lit("TAMPERED")).otherwise(F.col("action")))
    res = {r.ledger_id: r for r in L.verify_chain(tampered).collect()}
    assert res[victim.ledger_id].first_bad_seq == 3 and not res[victim.ledger_id].intact
    assert sum(1 for r in res.values() if not r.intact) == 1
    # Deleting a record breaks the next link.
    deleted = ledger.where(~((F.col("ledger_id") == victim.ledger_id) & (F.col("seq") == 3)))
    res = {r.ledger_id: r for r in L.verify_chain(deleted).collect()}
    assert res[victim.ledger_id].first_bad_seq == 4
    ledger.unpersist()


def test_append_continues_existing_chain(spark):
    acc = PC.accepted(spark, SF_SMALL)
    first = acc.where(F.col("request_seq") < 3000)
    second = acc.where(F.col("request_seq") >= 3000)
    l1 = L.append_records(first, order=("timestamp", "request_seq")).cache()
    l2 = L.append_records(second, ledger=l1, order=("timestamp", "request_seq"))
    both = l1.unionByName(l2)
    assert all(r.intact for r in L.verify_chain(both).collect())
    l1.unpersist()


def test_consent_grant_withdraw(spark):
    reqs = spark.createDataFrame(
        [("L0", "r1", "p1", "UC", "GRANT", 1), ("L0", "r2", "p1", "UC", "WITHDRAW", 2),
         ("L0", "r3", "p2", "UC", "GRANT", 3)],
        "ledger_id string, record_id string, patient_pseudonym string, use_case_id string, action string, seq long")
    st = {r.patient_pseudonym: r.consented for r in L.consent_status(reqs).collect()}
    assert st == {"p1": False, "p2": True}


def test_validate_use_cases_asymmetry(spark):
    reqs = spark.createDataFrame([("r1", "UCX", "GRANT"), ("r2", "UCX", "WITHDRAW"), ("r3", "UC0", "GRANT")],
                                 "record_id string, use_case_id string, action string")
    reg = spark.createDataFrame([("UC0", "d")], "use_case_id string, description string")
    got = {r.record_id: r.accepted for r in L.validate_use_cases(reqs, reg).collect()}
    assert got == {"r1": False, "r2": True, "r3": True}


def test_shares_sum_exactly(spark):
    s = B.order_secrets(spark, SF_SMALL)
    sh = FD.secret_share(s, "row_id", "secret", 3, 11, keep=["key"])
    back = sh.groupBy("row_id").agg(F.sum("share").alias("s"), F.count(F.lit(1)).alias("n"))
    bad = back.join(s, "row_id").where((F.col("s") != F.col("secret")) | (F.col("n") != 3))
    assert bad.count() == 0


def test_lower_epsilon_more_noise(spark):
    df = spark.range(4000).withColumn("x", F.lit(0.0))
    def mean_abs(eps, fn):
        return df.select(F.avg(F.abs(fn("x", 1.0, eps, 5, "t", "id"))).alias("m")).first().m
    assert mean_abs(0.1, laplace) > mean_abs(10.0, laplace)
    assert mean_abs(0.1, gaussian) > mean_abs(10.0, gaussian)
    # Empirical Laplace scale: E|X| = b.
    assert mean_abs(1.0, laplace) == pytest.approx(1.0, rel=0.1)


def test_noise_is_keyed_and_reproducible(spark):
    df = spark.range(100)
    a = df.select("id", laplace(F.lit(0.0), 1.0, 1.0, 9, "s", "id").alias("n")).repartition(7)
    b = df.select("id", laplace(F.lit(0.0), 1.0, 1.0, 9, "s", "id").alias("n")).coalesce(1)
    assert sorted(a.collect()) == sorted(b.collect())


def test_k_violations_partition_rows(spark):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    qi = ["c_nationkey", "c_mktsegment"]
    s = M.k_violation_summary(c, qi, 5).first()
    assert s.n_rows_at_risk + s.n_rows_safe == c.dropna(subset=qi).count()


def test_k_anonymity_null_policy(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "x int, y string")
    assert M.k_anonymity(df, ["x", "y"], nulls="drop").first().k == 2
    assert M.k_anonymity(df, ["x", "y"], nulls="group").first().k == 1


def test_auc_matches_bruteforce(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.normal(size=400) + y, 1)  # many ties
    df = spark.createDataFrame([(int(a), float(b), int(i % 3)) for i, (a, b) in enumerate(zip(y, s))],
                               "y int, s double, g int")
    pos, neg = s[y == 1], s[y == 0]
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert M.roc_auc(df, "y", "s", n_buckets=8).first().auc == pytest.approx(brute, abs=1e-12)
    one_class = df.where("y = 1")
    assert M.roc_auc(one_class, "y", "s").first().auc is None
    by = {r.g: r.auc for r in M.roc_auc(df, "y", "s", by=["g"], n_buckets=4).collect()}
    for g in range(3):
        m = np.arange(400) % 3 == g
        p, n = s[m & (y == 1)], s[m & (y == 0)]
        b = ((p[:, None] > n[None, :]).sum() + 0.5 * (p[:, None] == n[None, :]).sum()) / (len(p) * len(n))
        assert by[g] == pytest.approx(b, abs=1e-12)


def test_stratified_split_exact(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") % 7 == 0).cast("int"))
    s = M.split_train_test(df, "id", 0.75, 1, stratify="label")
    counts = {(r.label, r.is_train): r["count"] for r in s.groupBy("label", "is_train").count().collect()}
    n1 = 143
    assert counts[(1, True)] == round(n1 * 0.75) and counts[(0, True)] == round((1000 - n1) * 0.75)


def test_dp_mean_bounds_and_flip_rate(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 2).withColumn("v", F.col("id").cast("double"))
    r = DP.dp_mean(df, ["g"], "v", 0.0, 100.0, 10.0, 1).collect()
    assert all(0 <= x.dp_mean <= 100.5 for x in r)
    lab = spark.range(20000).withColumn("y", F.lit(0))
    rate = DP.flip_labels(lab, "y", 1.0, 3, "id").agg(F.avg("y")).first()[0]
    assert rate == pytest.approx(0.2, abs=0.02)


def test_fedavg_of_site_means_is_global_mean(spark):
    v = B.site_vectors(spark, SF_SMALL)
    fed = FD.fedavg_long(FD.local_means(v)).orderBy("pos").collect()
    glob = (v.select(F.posexplode("w").alias("pos", "value")).groupBy("pos").agg(F.avg("value").alias("m"))
            .orderBy("pos").collect())
    assert [round(a.value, 9) for a in fed] == [round(b.m, 9) for b in glob]


def _local_newton(x, y, w, steps):
    """One site's steps in plain numpy (C = 1, intercept last)."""
    xb = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.append(np.ones(x.shape[1]), 0.0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-xb @ w))
        w = w - np.linalg.solve((xb * (p * (1 - p))[:, None]).T @ xb + np.diag(ridge), xb.T @ (p - y) + ridge * w)
    return w


def _sites(spark):
    rng = np.random.default_rng(6)
    rows = []
    for site, n in (("hot", 300), ("b", 60), ("c", 40), (None, 5)):
        for _ in range(n):
            y = int(rng.random() < 0.4)
            rows.append((site, y, *map(float, rng.standard_normal(3) + 0.8 * y)))
    rows += [("b", 1, None, 0.0, 0.0), ("hot", 0, float("nan"), 1.0, 1.0), ("c", None, 1.0, 1.0, 1.0), ("lone", 1, 0.1, 0.2, 0.3)]
    return spark.createDataFrame(rows, "site_id string, label int, f0 double, f1 double, f2 double").repartition(6), rows


def _usable(rows, site):
    kept = [r for r in rows if r[0] == site and r[1] is not None and all(v is not None and v == v for v in r[2:])]
    return np.array([r[2:] for r in kept]), np.array([r[1] for r in kept])


def test_site_models_equal_local_fits(spark):
    """the batched steps equal each site's own, for sites of any size and
    with null features."""
    from cohortguard.operators import models as ML
    data, rows = _sites(spark)
    start = [0.1, -0.2, 0.0, 0.3]
    got = {r.site_id: r for r in ML.train_sites(data, ["f0", "f1", "f2"], "label", start, steps=3).collect()}
    assert set(got) == {"hot", "b", "c", "lone"} and got["lone"].local_auc is None
    for s in ("hot", "b", "c"):
        x, y = _usable(rows, s)
        assert got[s].n == len(y) and np.allclose(got[s].w, _local_newton(x, y, np.array(start), 3), atol=1e-8)
        assert 0 <= got[s].local_auc <= 1


def test_federated_rounds_equal_plain_fedavg(spark):
    """F8: rounds of local steps and averages by size; sites below the gate
    decline; no site at all gives AUC 0."""
    from cohortguard.operators import models as ML
    feats = ["f0", "f1", "f2"]
    data, rows = _sites(spark)
    data = data.where("site_id is not null and label is not null and f0 is not null and not isnan(f0)")
    logs = ML.federated_train(data, data, feats, "label", rounds=3, min_n=50, local_steps=2).orderBy("round_number").collect()
    assert [r.participating_sites for r in logs] == [["b", "hot"]] * 3
    assert [r.sites_declined for r in logs] == [["c", "lone"]] * 3
    parts = {s: _usable(rows, s) for s in ("hot", "b", "c", "lone")}
    pool = np.vstack([parts[s][0] for s in parts])
    mean, sd = pool.mean(axis=0), pool.std(axis=0)
    w = np.zeros(4)
    for log in logs:
        local = {s: _local_newton((parts[s][0] - mean) / sd, parts[s][1], w, 2) for s in ("hot", "b")}
        size = {s: len(parts[s][1]) for s in local}
        w = sum(size[s] * local[s] for s in local) / sum(size.values())
        assert np.allclose(log.global_weights, w, atol=1e-8) and log.global_auc > 0.6
    none = ML.federated_train(data, data, feats, "label", rounds=1, min_n=10_000).first()
    assert none.participating_sites == [] and none.global_auc == 0 and none.global_weights is None


def test_prefix_matches_window_with_hot_group(spark):
    """Bucketed prefix (lazy bounds) equals a plain running sum, with one
    group holding most rows and the group totals attached."""
    from cohortguard.operators.prefix import exclusive_prefix
    rng = np.random.default_rng(5)
    rows = [(0 if rng.random() < 0.7 else int(rng.integers(1, 6)), i, int(rng.integers(0, 9)))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, o long, v long")
    got = {(r.g, r.o): (r.v_before, r.v_total)
           for r in exclusive_prefix(df, "o", ["v"], groups=["g"], n_buckets=16, with_totals=True).collect()}
    run, tot = {}, {}
    for g, _o, v in rows:
        tot[g] = tot.get(g, 0) + v
    for g, o, v in sorted(rows, key=lambda r: r[1]):
        assert got[(g, o)] == (run.get(g, 0), tot[g])
        run[g] = run.get(g, 0) + v


def test_with_dimension_pairs_and_bounds(spark):
    from cohortguard.operators.common import with_dimension
    left = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    dim = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "q string, w double")
    out = sorted(tuple(r) for r in with_dimension(left, dim).collect())
    assert out == [(p, q, w) for p in (1, 2, 3) for q, w in (("a", 1.0), ("b", 2.0))]
    with pytest.raises(Exception, match="more than 1 rows"):
        with_dimension(left, dim, max_rows=1).collect()
