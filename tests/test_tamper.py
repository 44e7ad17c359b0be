"""Tampering, time zones, escapes and null keys."""

import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortguard.functions.hashing import iso_utc, json_string, record_hash, record_hash_py
from cohortguard.operators import ledger as L
from cohortguard.operators.fold import greedy_admit, ordered_fold


@pytest.fixture()
def chain(spark):
    """An intact chain of five records in one shard."""
    rows, prev = [], L.GENESIS_HASH
    for seq in range(1, 6):
        at = dt.datetime(2024, 3, 10, 6, 59, 59, seq)
        fields = {"action": "grant", "patient_pseudonym": f"p{seq}", "previous_record_hash": prev,
                  "record_id": f"r\u00e9{seq}\n", "timestamp": at.strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
                  "use_case_id": "u", "version": "1"}
        own = record_hash_py(fields)
        rows.append(("s", seq, fields["record_id"], fields["patient_pseudonym"], "u", "d", "grant",
                     at.replace(tzinfo=dt.timezone.utc), None, "1", prev, own))
        prev = own
    return spark.createDataFrame(rows, "ledger_id string, seq long, record_id string, patient_pseudonym string, "
                                 "use_case_id string, use_case_description string, action string, timestamp timestamp, "
                                 "expiry_date date, version string, previous_record_hash string, record_hash string")


def verdict(ledger):
    return L.verify_chain(ledger).first()


def test_intact_in_any_time_zone(spark, chain):
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert verdict(chain).intact
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("change", [
    lambda d: d.withColumn("action", F.when(F.col("seq") != 3, F.col("action"))),
    lambda d: d.withColumn("record_hash", F.when(F.col("seq") != 5, F.col("record_hash"))),
    lambda d: d.unionByName(d.where("seq = 5")),
    lambda d: d.unionByName(d.where("seq = 2")),
    lambda d: d.where("seq <> 3"),
    lambda d: d.where("seq <> 1"),
    lambda d: d.withColumn("seq", F.when(F.col("seq") == 2, 3).when(F.col("seq") == 3, 2).otherwise(F.col("seq"))),
    lambda d: d.withColumn("seq", F.when(F.col("seq") != 4, F.col("seq"))),
    lambda d: d.withColumn("version", F.lit("2")),
])
def test_tampering_shows(chain, change):
    assert not verdict(change(chain)).intact
    flags = L.verify_records(change(chain)).select("link_ok", "hash_ok").collect()
    assert all(r.link_ok is not None and r.hash_ok is not None for r in flags)


def test_json_text_equals_the_python_dump(spark):
    texts = ["", "a\"b", "back\\slash", "new\nline\ttab\x01\x7f", "\u00e9\u65e5", "\U0001f389", "\\\n\""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.j, r.h) for r in df.select("t", json_string("t").alias("j"), record_hash({"k": F.col("t")}).alias("h")).collect()}
    assert got == {t: (json.dumps(t), record_hash_py({"k": t})) for t in texts}


def test_iso_utc_before_the_epoch(spark):
    at = [dt.datetime(1969, 12, 31, 23, 59, 59, 1, dt.timezone.utc), dt.datetime(2024, 11, 3, 5, 30, 0, 0, dt.timezone.utc)]
    df = spark.createDataFrame([(a,) for a in at], "t timestamp").select(iso_utc("t").alias("s"))
    assert [r.s for r in df.collect()] == [a.strftime("%Y-%m-%dT%H:%M:%S.%fZ") for a in at]


def test_fold_takes_nulls_as_one_key(spark):
    rows = [(None, 1, 6), (None, 2, 6), (1, 1, 6), (1, 2, 4)]
    df = spark.createDataFrame(rows, "k long, o long, cost long")

    def step(used, seg):
        ok, _, used = greedy_admit(seg["cost"].to_numpy(), used, 10, True)
        return used, pd.DataFrame({"o": seg["o"], "ok": ok, "cost": seg["cost"]})

    out = ordered_fold(df, ["k"], ["o"], lambda _: 0, step, "o long, ok boolean, cost long").collect()
    assert sum(r.cost for r in out if r.ok) == 16  # 6 for the null key, 6 + 4 for the other


def test_greedy_admission_is_sequential():
    rng = np.random.default_rng(3)
    for stop in (True, False):
        for _ in range(200):
            cost, total = rng.integers(-1, 9, rng.integers(1, 40)), int(rng.integers(1, 60))
            used, want = 0, []
            for c in cost.tolist():
                ok = c >= 0 and used + c <= total and not (stop and used >= total)
                used += c if ok else 0
                want.append(ok)
            admitted, after, end = greedy_admit(cost, 0, total, stop)
            assert admitted.tolist() == want and end == used == after[-1]
