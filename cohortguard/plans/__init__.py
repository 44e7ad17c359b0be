"""Registered queries (plans) and their SQL oracles."""

from __future__ import annotations

import importlib

PLAN_MODULES = (
    "consent",
    "budget",
    "metrics",
    "governance",
    "federated",
    "streams",
    "audit",
    "models",
    "sqlfuncs",
)


def load_all() -> None:
    for m in PLAN_MODULES:
        importlib.import_module(f"{__name__}.{m}")
