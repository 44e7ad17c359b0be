"""Structured Streaming operators (G1–G3) and an available-now runner."""

from .operators import stream_audit_counts, stream_budget_gate, stream_consent_status  # noqa: F401
