"""cohortguard — privacy, consent and fairness analytics on Spark DataFrames.

Every operator takes and returns :class:`pyspark.sql.DataFrame` objects and is
expressed with built-in Spark SQL functions wherever possible, so Catalyst can
prune columns, push filters into the Parquet scan and fuse expressions into
whole-stage code.  Python runs inside tasks only where an ordered fold (hash
chain, budget gate) or a model fit genuinely needs it.

Sub-packages:

* ``functions``  — Column-level building blocks (keyed uniforms, noise,
  pseudonyms, hashing payloads, bands and scores).
* ``sources``    — driver-table readers, data bindings, seeded cohort
  generators, audit event writers and fixed reference values.
* ``operators``  — DataFrame → DataFrame operators (ledger, budget, DP,
  metrics, fairness, governance, federated aggregation, model jobs).
* ``plans``      — the registered queries that compose bindings and
  operators, plus their SQL oracles.
* ``streaming``  — Structured Streaming versions of the ledger, budget and
  audit operators.
"""

__version__ = "0.1.0"
