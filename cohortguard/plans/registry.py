"""Registry of named queries and their SQL oracles.

A plan is a function ``(spark, sf_dir) -> DataFrame`` that reads the driver
tables (through :mod:`cohortguard.sources.bindings`) and applies operators.
``sql`` is the same computation as DuckDB SQL over the driver tables, used as
an independent oracle; it is omitted for jobs SQL cannot express (model fits,
streams), which are checked by property tests instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    name: str
    plan: Plan
    sql: str | None
    operator_ids: tuple[str, ...]
    bench: bool = True


_PLANS: dict[str, Registered] = {}


def register(name: str, *operator_ids: str, sql: str | None = None, bench: bool = True):
    """Register a plan; ``bench=False`` keeps driver-loop model jobs and
    streams out of the default benchmark set (they still run in tests)."""
    def deco(fn: Plan) -> Plan:
        if name in _PLANS:
            raise ValueError(f"duplicate plan {name}")
        _PLANS[name] = Registered(name, fn, sql, tuple(operator_ids), bench)
        return fn
    return deco


def all_plans() -> dict[str, Registered]:
    from . import load_all  # noqa: F401  (imports every plan module)
    load_all()
    return dict(_PLANS)
