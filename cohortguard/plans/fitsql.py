"""DuckDB SQL for the model jobs: logistic regressions by Newton steps in a
recursive query (one Cholesky solve per step, spelled out column by column),
AUC by running counts, and clipped gradient descent.  Independent of the Spark
code: another language, another solver, no shared sums."""

from __future__ import annotations

from collections.abc import Sequence

NEWTON_STEPS = 30


def scaled_sql(rows: str, features: Sequence[str], keep: str, fitted: str = "true") -> str:
    """``keep`` columns and x0 .. xd (scaled by the moments of the ``fitted``
    rows; the last is one) of the relation ``rows``."""
    moments = ", ".join(f"avg({f}) AS m{i}, stddev_pop({f}) AS s{i}" for i, f in enumerate(features))
    xs = ", ".join(f"(CAST({f} AS DOUBLE) - m{i}) / CASE WHEN s{i} = 0 OR s{i} IS NULL THEN 1.0 ELSE s{i} END AS x{i}"
                   for i, f in enumerate(features))
    return (f"SELECT {keep}, {xs}, 1.0::DOUBLE AS x{len(features)} "
            f"FROM {rows}, (SELECT {moments} FROM {rows} WHERE {fitted}) st")


def _eta(d: int, b: str = "", x: str = "") -> str:
    return " + ".join(f"{b}b{i} * {x}x{i}" for i in range(d + 1))


def newton_ctes(rows: str, d: int, penalty: float = 1.0, steps: int = NEWTON_STEPS) -> str:
    """CTE ``coef(model, b0 .. bd)`` for the relation ``rows`` (model, x0 ..
    xd, y, w); needs WITH RECURSIVE."""
    bs, zero = _names(d), ", ".join(f"0.0::DOUBLE AS b{i}" for i in range(d + 1))
    stepped = ", ".join(f"b{i} - t{i}" for i in range(d + 1))
    return f"""
    newton AS (
      SELECT DISTINCT 0 AS k, model, {zero} FROM {rows}
      UNION ALL
      SELECT k + 1, model, {stepped} FROM ({_solved('newton', rows, 'model', 'model', d, penalty, steps)})),
    coef AS (SELECT * EXCLUDE (k) FROM newton WHERE k = {steps})"""


def _names(d: int, prefix: str = "b") -> str:
    return ", ".join(f"{prefix}{i}" for i in range(d + 1))


def _solved(state: str, rows: str, key: str, keep: str, d: int, penalty: float, steps: int) -> str:
    """``k, keep, b0 .. bd, t0 .. td``: the Newton steps t of the models in
    ``state`` (k, key, b0 .. bd) over ``rows`` (key, x0 .. xd, y, w)."""
    p = range(d + 1)
    ridge = [penalty] * d + [0.0]
    grads = ", ".join(f"sum(w * (mu - y) * x{i}) + {ridge[i]}::DOUBLE * b{i} AS g{i}" for i in p)
    hess = ", ".join(f"sum(w * mu * (1.0 - mu) * x{i} * x{j}) + {(ridge[i] + 1e-9) if i == j else 0.0!r}::DOUBLE AS h{i}_{j}"
                     for i in p for j in p if j <= i)
    chol, solve = [], []
    for i in p:
        for j in range(i + 1):
            inner = "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))
            chol.append(f"sqrt(h{i}_{i}{inner}) AS l{i}_{i}" if i == j else f"(h{i}_{j}{inner}) / l{j}_{j} AS l{i}_{j}")
    for i in p:
        solve.append(f"(g{i}{''.join(f' - l{i}_{k} * z{k}' for k in range(i))}) / l{i}_{i} AS z{i}")
    for i in reversed(p):
        solve.append(f"(z{i}{''.join(f' - l{k}_{i} * t{k}' for k in range(i + 1, d + 1))}) / l{i}_{i} AS t{i}")
    bs = _names(d)
    return f"""
        SELECT k, {keep}, {bs}, {', '.join(chol + solve)} FROM (
          SELECT k, {keep}, {bs}, {grads}, {hess} FROM (
            SELECT n.k, {', '.join('n.' + c.strip() for c in keep.split(','))}, {', '.join(f'n.b{i}' for i in p)},
                   {', '.join(f't.x{i}' for i in p)}, t.y, t.w,
                   1.0 / (1.0 + exp(-({_eta(d, 'n.', 't.')}))) AS mu
            FROM {state} n JOIN {rows} t ON t.{key} = n.{key} WHERE n.k < {steps})
          GROUP BY k, {keep}, {bs})"""


def federated_ctes(rows: str, d: int, rounds: int, local_steps: int) -> str:
    """CTE ``globals(round, b0 .. bd)``: averages by size of the sites' weights
    after ``local_steps`` Newton steps each, over ``rows`` (site, x0 .. xd, y,
    w)."""
    p = range(d + 1)
    step = ", ".join(f"CASE WHEN (k + 1) % {local_steps} = 0 THEN sum(n * (b{i} - t{i})) OVER () / sum(n) OVER () "
                     f"ELSE b{i} - t{i} END" for i in p)
    return f"""
    fl AS (
      SELECT 0 AS k, site, n, {', '.join(f'0.0::DOUBLE AS b{i}' for i in p)}
      FROM (SELECT site, count(*) AS n FROM {rows} GROUP BY site)
      UNION ALL
      SELECT k + 1, site, n, {step}
      FROM ({_solved('fl', rows, 'site', 'site, n', d, 1.0, rounds * local_steps)})),
    globals AS (SELECT k // {local_steps} AS round, {', '.join(f'min(b{i}) AS b{i}' for i in p)} FROM fl
                WHERE k > 0 AND k % {local_steps} = 0 GROUP BY 1)"""


def score_sql(d: int) -> str:
    return f"round({_eta(d)}, 9)"


def auc_ctes(scores: str, by: str) -> str:
    """CTE ``auc(by, auc)`` of the relation ``scores`` (by, label, s)."""
    return f"""
    auc_per AS (SELECT {by}, s, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
                FROM {scores} GROUP BY {by}, s),
    auc_pre AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {by} ORDER BY s
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM auc_per),
    auc AS (SELECT {by}, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
                   sum(CAST(pos AS DOUBLE) * (CAST(nb AS DOUBLE) + CAST(neg AS DOUBLE) / 2.0::DOUBLE))
                   / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc
            FROM auc_pre GROUP BY {by})"""


def descent_ctes(rows: str, d: int, epochs: int, clip: float, rate: float, noise) -> str:
    """CTE ``descent(k, b0 .. bd)``: clipped gradient steps over ``rows`` (x0 ..
    xd, y); ``noise(epoch, i)`` gives the SQL of what is added to sum i."""
    p = range(d + 1)
    norm = f"abs(slope) * sqrt({' + '.join(f'x{i} * x{i}' for i in p)})"
    bs = ", ".join(f"b{i}" for i in p)
    return f"""
    descent AS (
      SELECT 0 AS k, {', '.join(f'0.0::DOUBLE AS b{i}' for i in p)}
      UNION ALL
      SELECT k + 1, {', '.join(f"b{i} - {rate}::DOUBLE * (g{i} + {noise('(k + 1)', i)}) / n" for i in p)} FROM (
        SELECT k, {bs}, count(*) AS n, {', '.join(f'sum(cut * slope * x{i}) AS g{i}' for i in p)} FROM (
          SELECT *, CASE WHEN {norm} > {clip}::DOUBLE THEN {clip}::DOUBLE / ({norm}) ELSE 1.0 END AS cut FROM (
            SELECT w.*, t.* EXCLUDE (y), 1.0 / (1.0 + exp(-({_eta(d, 'w.', 't.')}))) - t.y AS slope
            FROM descent w CROSS JOIN {rows} t WHERE w.k < {epochs}))
        GROUP BY k, {bs}))"""
