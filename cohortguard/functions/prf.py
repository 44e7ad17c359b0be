"""Keyed pseudo-random uniforms.

``keyed_uniform(seed, stream, id...)`` maps (seed, stream name, row key) to a
double in (0, 1) through MD5.  The value depends only on the key — not on the
partition a row lands in, the number of executors, or a task retry — so a
recomputed plan (after a lost executor) draws exactly the same numbers, and
a noisy release is drawn once per cell no matter how often the plan runs.

The same formula runs in DuckDB (``keyed_uniform_sql``), which is what lets
the SQL oracle reproduce noisy releases bit for bit.

Keyed noise is reproducible by design.  For a production release, put a
secret salt in ``seed`` (so the noise cannot be recomputed by an adversary).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**52: the first 13 hex digits of the digest give 52 random bits.
TWO_POW_52 = 4503599627370496.0
TWO_PI = 2.0 * math.pi


def _key(seed, stream: str, ids) -> Column:
    parts = [F.lit(str(seed)), F.lit(stream)]
    for c in ids:
        parts.append((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.concat_ws("|", *parts)


def keyed_uniform(seed, stream: str, *ids, part: int = 0) -> Column:
    """Uniform double in the open interval (0, 1), keyed by ``ids``.

    ``ids`` are column names or Columns of integer or string type (doubles
    format differently across engines; do not key on them).  ``part`` 0 or 1
    picks hex digits 1–13 or 14–26 of the digest: two independent uniforms
    from one MD5 (Spark evaluates the shared digest once per row).
    """
    hexd = F.substring(F.md5(_key(seed, stream, ids)), 1 + 13 * part, 13)
    bits = F.conv(hexd, 16, 10).cast("bigint")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(TWO_POW_52)


def keyed_uniform_sql(seed, stream: str, *id_exprs: str, part: int = 0) -> str:
    """DuckDB expression equal to :func:`keyed_uniform` for the same key."""
    parts = [f"'{seed}'", f"'{stream}'"] + [f"CAST({e} AS VARCHAR)" for e in id_exprs]
    digest = f"md5(concat_ws('|', {', '.join(parts)}))"
    return (f"((CAST(('0x' || substr({digest}, {1 + 13 * part}, 13)) AS BIGINT))::DOUBLE + 0.5::DOUBLE)"
            f" / {TWO_POW_52!r}::DOUBLE")


def keyed_normal(seed, stream: str, *ids) -> Column:
    """Standard normal draw by Box–Muller on the two uniforms of one digest."""
    u1 = keyed_uniform(seed, stream + ":n", *ids, part=0)
    u2 = keyed_uniform(seed, stream + ":n", *ids, part=1)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(TWO_PI) * u2)


def keyed_normal_sql(seed, stream: str, *id_exprs: str) -> str:
    u1 = keyed_uniform_sql(seed, stream + ":n", *id_exprs, part=0)
    u2 = keyed_uniform_sql(seed, stream + ":n", *id_exprs, part=1)
    return f"(sqrt(-2.0::DOUBLE * ln({u1})) * cos({TWO_PI!r}::DOUBLE * {u2}))"
