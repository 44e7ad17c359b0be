"""Streams over several micro-batches, with rows out of order, against batch operators."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from cohortguard.operators.budget import consume_budget
from cohortguard.operators.fold import greedy_admit, greedy_admit_groups
from cohortguard.operators.ledger import consent_status
from cohortguard.streaming import operators as S
from cohortguard.streaming import runner as R

T0 = dt.datetime(2024, 1, 1)


def stream_of(spark, tmp_path, rows, schema, cuts):
    """Write ``rows`` as one file per micro-batch, in order, and stream them."""
    for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        spark.createDataFrame(rows[a:b], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"b{k}"))
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
            .parquet(str(tmp_path)))


OPS = "budget_id long, op_id long, ts timestamp, epsilon_micro long"


def test_gate_equals_the_batch_gate_over_micro_batches(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.randrange(4), i, T0 + dt.timedelta(minutes=i // 3), rng.choice([0, 5, 9, 30, -1])) for i in range(400)]
    late = rows[:]
    for _ in range(150):  # out of order, within the delay
        i = rng.randrange(380)
        j = i + rng.randrange(20)
        late[i], late[j] = late[j], late[i]
    last = (9, 10_000, T0 + dt.timedelta(days=2), 1)  # closes every slice before it
    stream = stream_of(spark, tmp_path, [*late, last], OPS, [130, 260, 400])
    got = R.run_append(S.stream_budget_gate(stream, 500, delay="1 hour", slice_ms=600_000, block_rows=7), "t-gate")
    want = consume_budget(spark.createDataFrame(rows, OPS), 500, order=("ts", "op_id"))
    cols = ["budget_id", "op_id", "ts", "epsilon_micro", "allowed", "cumulative_micro"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


REQUESTS = "patient_pseudonym string, use_case_id string, timestamp timestamp, request_seq long, action string, expiry_date date"


def test_consent_equals_the_batch_status_with_expiry(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        at = T0 + dt.timedelta(hours=i // 2)
        expiry = rng.choice([None, None, (at + dt.timedelta(days=rng.randrange(0, 4))).date(), dt.date(2030, 1, 1)])
        rows.append((f"p{rng.randrange(12)}", f"u{rng.randrange(2)}", at, i, rng.choice(["GRANT", "GRANT", "WITHDRAW"]), expiry))
    late = rows[:]
    for _ in range(100):
        i = rng.randrange(290)
        j = i + rng.randrange(10)
        late[i], late[j] = late[j], late[i]
    end = ("zz", "u0", T0 + dt.timedelta(days=12), 999, "GRANT", None)  # moves the watermark to day 11
    stream = stream_of(spark, tmp_path, [*late, end], REQUESTS, [90, 200, 300])
    got = R.run_update(S.stream_consent_status(stream, delay="1 day"), "t-consent", ["patient_pseudonym", "use_case_id"])
    want = consent_status(spark.createDataFrame([*rows, end], REQUESTS), enforce_expiry=True, as_of="2024-01-12",
                          order=F.struct("timestamp", "request_seq"))
    cols = ["patient_pseudonym", "use_case_id", "last_action", "consented", "n_actions"]
    got, want = (sorted(map(tuple, d.select(cols).collect())) for d in (got, want))
    assert got == want
    assert any(r[2] == "GRANT" and not r[3] for r in got) and any(r[3] for r in got)


def test_late_audit_rows_are_dropped(spark, tmp_path):
    rows = [(T0 + dt.timedelta(hours=h), "A") for h in (1, 30, 60, 61)] + [(T0 + dt.timedelta(hours=2), "A"), (T0 + dt.timedelta(hours=100), "A")]
    stream = stream_of(spark, tmp_path, rows, "timestamp timestamp, event_type string", [3, 4])
    got = {r.window_start.day: r.n_events for r in R.run_append(S.stream_audit_counts(stream), "t-audit").collect()}
    assert got == {1: 1, 2: 1, 3: 2}  # the row of day 1 in the third batch came too late


def test_gate_of_many_budgets_in_few_state_keys(spark, tmp_path):
    """calls to the state grow with blocks of rows, not with budgets; texts and null are budgets too."""
    rng = random.Random(5)
    names = [None, "", *(f"b{i}" for i in range(60))]
    schema = OPS.replace("budget_id long", "budget_id string")
    rows = [(rng.choice(names), i, T0 + dt.timedelta(minutes=i // 5), rng.choice([0, 5, 9, 30, -1])) for i in range(600)]
    last = ("z", 10_000, T0 + dt.timedelta(days=2), 1)
    stream = stream_of(spark, tmp_path, [*rows, last], schema, [250, 600])
    got = R.run_append(S.stream_budget_gate(stream, 100, slice_ms=1_800_000, block_rows=5, buckets=3), "t-buckets")
    want = consume_budget(spark.createDataFrame(rows, schema), 100, order=("ts", "op_id"))
    cols = ["budget_id", "op_id", "ts", "epsilon_micro", "allowed", "cumulative_micro"]
    got, want = ({r.op_id: tuple(r) for r in d.select(cols).collect()} for d in (got, want))
    assert got == want


def test_gate_of_groups_equals_the_gate_of_each():
    rng = np.random.default_rng(1)
    for k in range(300):
        sizes = rng.integers(1, 8, rng.integers(1, 6))
        starts, cost = np.cumsum(sizes) - sizes, rng.choice([-1, 0, 1, 5, 9, 30], sizes.sum())
        used = rng.integers(0, 60, len(sizes))
        admitted, after, left = greedy_admit_groups(cost, starts, used, 50, bool(k % 2))
        for g, (a, n) in enumerate(zip(starts, sizes)):
            one = greedy_admit(cost[a:a + n], int(used[g]), 50, bool(k % 2))
            assert (admitted[a:a + n].tolist(), after[a:a + n].tolist(), left[g]) == (one[0].tolist(), one[1].tolist(), one[2])
