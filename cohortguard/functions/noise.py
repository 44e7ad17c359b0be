"""Differential-privacy noise as Column expressions.

Noise is drawn from keyed uniforms (:mod:`cohortguard.functions.prf`), so each
released cell gets exactly one draw even if Spark recomputes the plan.  When
``seed`` is ``None`` the draw uses ``rand``/``randn`` instead (fresh noise per
evaluation — only safe on a materialised result).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .prf import keyed_normal, keyed_normal_sql, keyed_uniform, keyed_uniform_sql

DEFAULT_DELTA = 1e-5


def gaussian_sigma(sensitivity: float, epsilon: float, delta: float = DEFAULT_DELTA) -> float:
    """Classic Gaussian-mechanism scale: (s/ε)·√(2 ln(1.25/δ))."""
    _check_eps(epsilon)
    if not 0.0 < delta < 1.0:
        raise ValueError("delta must be in (0, 1)")
    return (sensitivity / epsilon) * math.sqrt(2.0 * math.log(1.25 / delta))


def laplace_scale(sensitivity: float, epsilon: float) -> float:
    _check_eps(epsilon)
    return sensitivity / epsilon


def _check_eps(epsilon: float) -> None:
    if epsilon is None or not epsilon > 0:
        raise ValueError("epsilon must be > 0")


def laplace_noise(scale: float, seed, stream: str, *ids) -> Column:
    """Laplace(0, scale) by inverting the CDF of a keyed uniform."""
    if seed is None:
        u = F.rand()
        u = F.when(u <= 0.0, F.lit(0.5)).otherwise(u)
    else:
        u = keyed_uniform(seed, stream, *ids)
    d = u - F.lit(0.5)
    return F.lit(-scale) * F.signum(d) * F.log(F.lit(1.0) - F.lit(2.0) * F.abs(d))


def laplace_noise_sql(scale: float, seed, stream: str, *id_exprs: str) -> str:
    u = keyed_uniform_sql(seed, stream, *id_exprs)
    return (f"({-scale!r}::DOUBLE * sign({u} - 0.5::DOUBLE)"
            f" * ln(1.0::DOUBLE - 2.0::DOUBLE * abs({u} - 0.5::DOUBLE)))")


def gaussian_noise(sigma: float, seed, stream: str, *ids) -> Column:
    z = F.randn() if seed is None else keyed_normal(seed, stream, *ids)
    return F.lit(sigma) * z


def gaussian_noise_sql(sigma: float, seed, stream: str, *id_exprs: str) -> str:
    return f"({sigma!r}::DOUBLE * {keyed_normal_sql(seed, stream, *id_exprs)})"


def laplace(col, sensitivity: float, epsilon: float, seed, stream: str, *ids) -> Column:
    """Value + Laplace(0, sensitivity/ε)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("double") + laplace_noise(laplace_scale(sensitivity, epsilon), seed, stream, *ids)


def gaussian(col, sensitivity: float, epsilon: float, seed, stream: str, *ids,
             delta: float = DEFAULT_DELTA) -> Column:
    """Value + N(0, σ²) with the classic Gaussian-mechanism σ."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("double") + gaussian_noise(gaussian_sigma(sensitivity, epsilon, delta), seed, stream, *ids)


def flip_probability(epsilon: float) -> float:
    """Label-flip rate used by the privacy–utility curve: clamp(1/(5ε), 0, 0.3)."""
    _check_eps(epsilon)
    return max(0.0, min(0.3, 1.0 / (epsilon * 5.0)))
