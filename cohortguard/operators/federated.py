"""Federated and secure aggregation over model-vector and secret tables.

Vectors are ``ARRAY<DOUBLE>`` columns.  Coordinate-wise aggregates
``posexplode`` the arrays into (group, pos, value) rows and aggregate by
(group, pos) — partial aggregation keeps each site's contribution combined
map-side, and the only collect is the final rebuild of one d-length vector
per group (bounded by the model size, not the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.noise import DEFAULT_DELTA, gaussian_sigma
from ..functions.prf import TWO_PI, keyed_uniform

MIN_SITE_PATIENTS = 50


# --------------------------------------------------------------------------
# B15 — site governance gate
# --------------------------------------------------------------------------

def site_gate(df: DataFrame, site_col: str = "site_id", min_n: int = MIN_SITE_PATIENTS) -> DataFrame:
    """Per site row count and PARTICIPATING / DECLINED (n < min_n)."""
    return (df.groupBy(site_col).agg(F.count(F.lit(1)).alias("n_patients"))
            .withColumn("status", F.when(F.col("n_patients") >= min_n, "PARTICIPATING").otherwise("DECLINED")))


def participating_rows(df: DataFrame, site_col: str = "site_id", min_n: int = MIN_SITE_PATIENTS) -> DataFrame:
    ok = site_gate(df, site_col, min_n).where(F.col("status") == "PARTICIPATING").select(site_col)
    return df.join(ok, site_col, "left_semi")


# --------------------------------------------------------------------------
# Vector helpers
# --------------------------------------------------------------------------

def explode_vector(df: DataFrame, vec_col: str, keep=()) -> DataFrame:
    """(keep..., pos, value) rows from an ARRAY<DOUBLE> column (pos 0-based)."""
    return df.select(*keep, F.posexplode(vec_col).alias("pos", "value"))


def assemble_vector(long: DataFrame, keys=(), pos_col: str = "pos", value_col: str = "value",
                    out_col: str = "w") -> DataFrame:
    """Rebuild one array per key group in position order (bounded by d)."""
    keys = list(keys)
    g = long.groupBy(*keys) if keys else long.groupBy()
    return g.agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos_col).alias("p"),
                                                                   F.col(value_col).alias("v")))),
                             lambda s: s["v"]).alias(out_col))


def local_means(vectors: DataFrame, site_col: str = "site_id", vec_col: str = "w", min_n: int = 1) -> DataFrame:
    """Per-site mean vector (long form) and site size, of the sites with at
    least ``min_n`` rows (B15): rows are aggregated first, sites gated after."""
    long = explode_vector(vectors, vec_col, keep=[site_col])
    means = long.groupBy(site_col, "pos").agg(F.avg("value").alias("value"))
    sizes = vectors.groupBy(site_col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_n)
    return means.join(sizes, site_col)


# --------------------------------------------------------------------------
# D11 — FedAvg
# --------------------------------------------------------------------------

def fedavg_long(weights_long: DataFrame, n_col: str = "n", by=()) -> DataFrame:
    """D11 on long-form weights (site, pos, value, n): Σ n·w / Σ n per pos."""
    by = list(by)
    return (weights_long.groupBy(*by, "pos")
            .agg((F.sum(F.col(n_col) * F.col("value")) / F.sum(n_col)).alias("value"),
                 F.countDistinct("site_id").alias("n_sites"),
                 F.sum(n_col).alias("total_n")))


def fedavg(weights: DataFrame, vec_col: str = "w", n_col: str = "n", by=()) -> DataFrame:
    """Sample-weighted coordinate mean of site weight vectors.

    ``weights``: (site_id, n, w ARRAY<DOUBLE>).  Returns one vector per
    ``by`` group (e.g. per round).
    """
    long = weights.select(*by, "site_id", n_col, F.posexplode(vec_col).alias("pos", "value"))
    avg = fedavg_long(long, n_col, by)
    return assemble_vector(avg, by, out_col=vec_col)


# --------------------------------------------------------------------------
# D12 / D13 — device updates
# --------------------------------------------------------------------------

def noise_updates(updates: DataFrame, epsilon: float, seed, id_col: str = "device_id",
                  vec_col: str = "gradient_update", delta: float = DEFAULT_DELTA) -> DataFrame:
    """Gaussian noise on every coordinate of each device's update.

    One keyed draw per (device, coordinate), applied inside ``transform`` —
    the array never leaves the row."""
    sigma = gaussian_sigma(1.0, epsilon, delta)
    dev = F.col(id_col)

    def noisy(x, i):
        u1 = keyed_uniform(seed, "upd:n1", dev, i)
        u2 = keyed_uniform(seed, "upd:n2", dev, i)
        z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(TWO_PI) * u2)
        return x + F.lit(sigma) * z
    return (updates.withColumn(vec_col, F.transform(vec_col, noisy))
            .withColumn("epsilon_consumed", F.lit(float(epsilon)))
            .withColumn("raw_data_transmitted", F.lit(False)))


def aggregate_updates(updates: DataFrame, vec_col: str = "gradient_update", by=()) -> DataFrame:
    """Unweighted coordinate mean, device count and total epsilon."""
    by = list(by)
    long = updates.select(*by, F.posexplode(vec_col).alias("pos", "value"))
    mean = long.groupBy(*by, "pos").agg(F.avg("value").alias("value"))
    vec = assemble_vector(mean, by, out_col="aggregated_gradient")
    aggs = [F.count(F.lit(1)).alias("n_devices_contributed"),
            F.sum("epsilon_consumed").alias("total_epsilon_consumed")]
    if by:
        return vec.join(updates.groupBy(*by).agg(*aggs), by)
    stats = updates.agg(*aggs)
    return vec.select("*", *[stats.select(c).scalar().alias(c)
                             for c in ("n_devices_contributed", "total_epsilon_consumed")])


# --------------------------------------------------------------------------
# D14 / D15 — additive secret sharing (exact BIGINT arithmetic)
# --------------------------------------------------------------------------

SHARE_RANGE = 1_000_000_000_000  # shares drawn uniformly from [-R, R]


def secret_share(df: DataFrame, id_col: str, value_col: str, n_parties: int, seed,
                 keep=()) -> DataFrame:
    """Split each BIGINT secret into ``n_parties`` additive shares.

    Parties 1..n−1 get keyed uniform integers in [−R, R]; party n gets the
    remainder, so the shares sum exactly to the secret.  Built per row with
    array functions and exploded — no shuffle.  Output: (keep..., id,
    party_id, share); write it partitioned by party so each party reads only
    its own shares.
    """
    if n_parties < 2:
        raise ValueError("need at least two parties")
    span = float(2 * SHARE_RANGE + 1)

    def draw(p):
        u = keyed_uniform(seed, "share", F.col(id_col), p)
        return (F.floor(u * F.lit(span)).cast("long") - F.lit(SHARE_RANGE))
    # n is a plan constant: unrolled columns stay in whole-stage codegen
    rnd = [draw(F.lit(p)) for p in range(1, n_parties)]
    last = F.col(value_col).cast("long") - sum(rnd[1:], rnd[0])
    shares = F.array(*rnd, last)
    return (df.select(*keep, id_col, F.posexplode(shares).alias("_p", "share"))
            .select(*keep, id_col, F.concat(F.lit("Party_"), (F.col("_p") + 1).cast("string")).alias("party_id"),
                    "share"))


def party_sums(shares: DataFrame, key_col: str = "key") -> DataFrame:
    """D15 step 1: each party sums only its own shares per key."""
    return shares.groupBy(key_col, "party_id").agg(F.sum("share").alias("party_sum"))


def reconstruct(party_totals: DataFrame, key_col: str = "key") -> DataFrame:
    """D15 step 2: the aggregator adds the party sums = sum of the secrets."""
    return party_totals.groupBy(key_col).agg(F.sum("party_sum").alias("reconstructed_sum"),
                                             F.count(F.lit(1)).alias("n_parties"))
