"""Federated, secure-aggregation and DP-release plans (T7, T8, T9, T4, events)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.noise import gaussian_noise_sql, gaussian_sigma, laplace_noise_sql, laplace_scale
from ..functions.prf import TWO_PI, keyed_uniform_sql
from ..operators import dp as DP
from ..operators import federated as FD
from ..sources import bindings as B
from ..sources.tables import read
from .registry import register

_D = 6
SEED = 4242
SIGNAL_EPS = 2.0
UPDATE_EPS = 1.0
FLIP_EPS = 1.0
RELEASE_EPS = 1.0
VALUE_LOWER, VALUE_UPPER = 0.0, 500.0

_VEC = """(SELECT 'site_' || CAST(label AS VARCHAR) AS site_id, vec_id AS device_id,
             unnest(range(0, len(embedding))) AS pos, CAST(unnest(embedding) AS DOUBLE) AS value
           FROM embeddings)"""


# B15 -----------------------------------------------------------------------------

@register("b15_site_gate", "B15", sql=f"""
SELECT 'site_' || CAST(label AS VARCHAR) AS site_id, count(*) AS n_patients,
       CASE WHEN count(*) >= {FD.MIN_SITE_PATIENTS} THEN 'PARTICIPATING' ELSE 'DECLINED' END AS status
FROM embeddings GROUP BY label""")
def b15_site_gate(spark, sf_dir):
    return FD.site_gate(B.site_vectors(spark, sf_dir))


# D11 -----------------------------------------------------------------------------

@register("d11_fedavg", "D11", "B15", sql=f"""
WITH v AS {_VEC},
sizes AS (SELECT site_id, count(DISTINCT device_id) AS n FROM v GROUP BY site_id),
local AS (SELECT v.site_id, pos, avg(value) AS value, any_value(s.n) AS n
          FROM v JOIN sizes s ON s.site_id = v.site_id WHERE s.n >= {FD.MIN_SITE_PATIENTS}
          GROUP BY v.site_id, pos)
SELECT pos, round(sum(n * value) / sum(n), {_D}) AS value, count(DISTINCT site_id) AS n_sites,
       CAST(sum(n) AS BIGINT) AS total_n
FROM local GROUP BY pos""")
def d11_fedavg(spark, sf_dir):
    means = FD.local_means(B.site_vectors(spark, sf_dir), min_n=FD.MIN_SITE_PATIENTS)
    avg = FD.fedavg_long(means)
    return avg.select("pos", F.round("value", _D).alias("value"), "n_sites", "total_n")


# D12 -----------------------------------------------------------------------------

def _updates(spark, sf_dir):
    return B.site_vectors(spark, sf_dir).withColumnRenamed("w", "gradient_update")


@register("d12_noise_updates", "D12", sql=f"""
SELECT device_id, pos,
       round(value + {gaussian_sigma(1.0, UPDATE_EPS)!r}::DOUBLE
             * (sqrt(-2.0::DOUBLE * ln({keyed_uniform_sql(SEED, 'upd:n1', 'device_id', 'pos')}))
                * cos({TWO_PI!r}::DOUBLE * {keyed_uniform_sql(SEED, 'upd:n2', 'device_id', 'pos')})),
             {_D}) AS value
FROM {_VEC} v""")
def d12_noise_updates(spark, sf_dir):
    noisy = FD.noise_updates(_updates(spark, sf_dir), UPDATE_EPS, SEED)
    return (noisy.select("device_id", F.posexplode("gradient_update").alias("pos", "value"))
            .select("device_id", "pos", F.round("value", _D).alias("value")))


# D13 -----------------------------------------------------------------------------

@register("d13_aggregate_updates", "D13", "D12", sql=f"""
SELECT site_id, pos, round(avg(value), {_D}) AS value, count(*) AS n_devices_contributed,
       count(*) * {UPDATE_EPS!r}::DOUBLE AS total_epsilon_consumed
FROM {_VEC} v GROUP BY site_id, pos""")
def d13_aggregate_updates(spark, sf_dir):
    u = _updates(spark, sf_dir).withColumn("epsilon_consumed", F.lit(UPDATE_EPS))
    agg = FD.aggregate_updates(u, by=["site_id"])
    return (agg.select("site_id", "n_devices_contributed", "total_epsilon_consumed",
                       F.posexplode("aggregated_gradient").alias("pos", "value"))
            .select("site_id", "pos", F.round("value", _D).alias("value"), "n_devices_contributed",
                    "total_epsilon_consumed"))


# D14 / D15 -----------------------------------------------------------------------

def _share_sql(p):
    u = keyed_uniform_sql(SEED, "share", "o_orderkey", str(p))
    return f"(CAST(floor({u} * {float(2 * FD.SHARE_RANGE + 1)!r}::DOUBLE) AS BIGINT) - {FD.SHARE_RANGE})"


_SHARES = f"""
SELECT o_orderpriority AS key, o_orderkey AS row_id, 'Party_1' AS party_id, {_share_sql(1)} AS share FROM orders
UNION ALL
SELECT o_orderpriority, o_orderkey, 'Party_2', {_share_sql(2)} FROM orders
UNION ALL
SELECT o_orderpriority, o_orderkey, 'Party_3',
       CAST(round(o_totalprice * 100) AS BIGINT) - {_share_sql(1)} - {_share_sql(2)} FROM orders"""


def _shares(spark, sf_dir):
    s = B.order_secrets(spark, sf_dir)
    return FD.secret_share(s, "row_id", "secret", B.N_SECRET_PARTIES, SEED, keep=["key"])


@register("d14_secret_share", "D14", sql=_SHARES)
def d14_secret_share(spark, sf_dir):
    return _shares(spark, sf_dir)


@register("d15_aggregate_shares", "D15", "D14", sql=f"""
WITH ps AS (SELECT key, party_id, sum(share) AS party_sum FROM ({_SHARES}) GROUP BY key, party_id),
rec AS (SELECT key, CAST(sum(party_sum) AS BIGINT) AS reconstructed_sum, count(*) AS n_parties
        FROM ps GROUP BY key),
plain AS (SELECT o_orderpriority AS key, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS plain_sum
          FROM orders GROUP BY o_orderpriority)
SELECT rec.key, reconstructed_sum, n_parties, plain_sum, reconstructed_sum = plain_sum AS exact_match
FROM rec JOIN plain ON rec.key = plain.key""")
def d15_aggregate_shares(spark, sf_dir):
    rec = FD.reconstruct(FD.party_sums(_shares(spark, sf_dir)))
    plain = B.order_secrets(spark, sf_dir).groupBy("key").agg(F.sum("secret").alias("plain_sum"))
    return (rec.join(plain, "key")
            .withColumn("exact_match", F.col("reconstructed_sum") == F.col("plain_sum")))


# D10 -----------------------------------------------------------------------------

@register("d10_dp_signal", "D10", "B4", sql=f"""
SELECT drug, event, round(sum(greatest(0.0::DOUBLE, CAST(n AS DOUBLE)
         + {gaussian_noise_sql(gaussian_sigma(1.0, SIGNAL_EPS), SEED, 'signal', 'drug', 'event', 'system')})), 1)
         AS dp_aggregate_count,
       count(DISTINCT system) AS systems_contributed, {SIGNAL_EPS!r}::DOUBLE AS epsilon_used
FROM (SELECT l_partkey % {B.N_SIGNAL_DRUGS} AS drug, l_returnflag AS event, l_suppkey % {B.N_SIGNAL_SYSTEMS} AS system,
             count(*) AS n FROM lineitem GROUP BY 1, 2, 3)
GROUP BY drug, event""")
def d10_dp_signal(spark, sf_dir):
    return DP.dp_signal(B.signal_counts(spark, sf_dir), SIGNAL_EPS, SEED)


# B6 ------------------------------------------------------------------------------

@register("b6_flip_labels", "B6", sql=f"""
SELECT id, label, CAST(CASE WHEN {keyed_uniform_sql(SEED, 'flip', 'id')} < {DP.flip_probability(FLIP_EPS)!r}::DOUBLE
                       THEN 1 - label ELSE label END AS INTEGER) AS noisy_label
FROM {B.COHORT_SQL} c""")
def b6_flip_labels(spark, sf_dir):
    c = B.customer_cohort(spark, sf_dir).select("id", "label")
    return DP.flip_labels(c, "label", FLIP_EPS, SEED, "id", out_col="noisy_label")


# D9 / B3 -------------------------------------------------------------------------

# a user counts in two event types at most, with five events in each
EVENT_SUBJECT = DP.SubjectBound("user_id", "event_id", max_groups=2, max_rows=5)
_BOUNDED_EVENTS = EVENT_SUBJECT.sql("events", "event_type")
_COUNT_SENS = EVENT_SUBJECT.sensitivity(1.0, "laplace")
_SUM_SENS = EVENT_SUBJECT.sensitivity(VALUE_UPPER, "gaussian")


@register("d9_dp_count_events", "D9", "B3", sql=f"""
SELECT event_type, round(CAST(count(*) AS DOUBLE)
       + {laplace_noise_sql(laplace_scale(_COUNT_SENS, RELEASE_EPS), SEED, 'ev_count', 'event_type')}, 6) AS dp_count
FROM {_BOUNDED_EVENTS} GROUP BY event_type""")
def d9_dp_count_events(spark, sf_dir):
    ev = read(spark, sf_dir, "events", "event_type", "user_id", "event_id")
    return DP.dp_count(ev, ["event_type"], RELEASE_EPS, SEED, stream="ev_count", subject=EVENT_SUBJECT)


@register("d9_dp_sum_events", "D9", "B4", sql=f"""
SELECT event_type, round(sum(least(greatest(value, {VALUE_LOWER!r}::DOUBLE), {VALUE_UPPER!r}::DOUBLE))
       + {gaussian_noise_sql(gaussian_sigma(_SUM_SENS, RELEASE_EPS), SEED, 'ev_sum', 'event_type')}, 6) AS dp_sum
FROM {_BOUNDED_EVENTS} GROUP BY event_type""")
def d9_dp_sum_events(spark, sf_dir):
    ev = read(spark, sf_dir, "events", "event_type", "value", "user_id", "event_id")
    return DP.dp_sum(ev, ["event_type"], "value", VALUE_LOWER, VALUE_UPPER, RELEASE_EPS, SEED,
                     mechanism="gaussian", stream="ev_sum", subject=EVENT_SUBJECT)


MEAN_SUBJECT = DP.SubjectBound("o_custkey", "o_orderkey", max_groups=2, max_rows=3)
MEAN_LOWER, MEAN_UPPER = 0.0, 400_000.0
_MEAN_SENS = [MEAN_SUBJECT.sensitivity(x, "laplace") for x in (1.0, MEAN_UPPER)]


@register("d9_dp_mean_capped", "D9", "B3", sql=f"""
WITH rel AS (
  SELECT o_orderstatus, CAST(count(*) AS DOUBLE)
         + {laplace_noise_sql(laplace_scale(_MEAN_SENS[0], RELEASE_EPS / 2), SEED, 'mean:n', 'o_orderstatus')} AS nn,
         sum(least(greatest(o_totalprice, {MEAN_LOWER!r}::DOUBLE), {MEAN_UPPER!r}::DOUBLE))
         + {laplace_noise_sql(laplace_scale(_MEAN_SENS[1], RELEASE_EPS / 2), SEED, 'mean:s', 'o_orderstatus')} AS sn
  FROM {MEAN_SUBJECT.sql('orders', 'o_orderstatus')} GROUP BY o_orderstatus)
SELECT o_orderstatus, round(nn, 6) AS dp_count, round(sn / greatest(nn, 1.0::DOUBLE), 6) AS dp_mean FROM rel""")
def d9_dp_mean_capped(spark, sf_dir):
    """Mean order value per order status, private per customer."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return DP.dp_mean(o, ["o_orderstatus"], "o_totalprice", MEAN_LOWER, MEAN_UPPER, RELEASE_EPS, SEED,
                      stream="mean", subject=MEAN_SUBJECT)
