"""Seeded synthetic cohorts (A1–A9) as one projection over an id column.

``synthesize(ids, spec, seed)`` turns a DataFrame of unique integer ids —
taken from a real table, so the cohort grows with it — into a cohort whose
every cell is a function of (seed, column, id) through the keyed PRF.  The
result does not depend on partitioning or retries, and the same spec
compiles to DuckDB SQL for the oracle.

A spec is a list of ``(name, kind, params)``; later columns may refer to
earlier ones by name (lateral column aliases work in both Spark SQL and
DuckDB).  Names starting with ``_`` are helpers and are dropped.

Kinds: ``uniform(lo, hi)``, ``int_range(lo, hi)`` (hi exclusive),
``normal(mu, sd)``, ``lognormal(mu, sigma)``, ``bernoulli(p)``,
``choice(values, probs)``, ``fmt(pattern)`` (formatted id), ``expr(sql)``.
Any kind accepts ``clip=(lo, hi)``, ``round=d`` and ``cast=type``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from ..functions.prf import TWO_POW_52, keyed_uniform_sql

TWO_PI = 2.0 * math.pi


def _u_spark(seed, stream, id_col, part=0):
    key = f"concat_ws('|', '{seed}', '{stream}', CAST({id_col} AS STRING))"
    return (f"((CAST(conv(substring(md5({key}), {1 + 13 * part}, 13), 16, 10) AS BIGINT) + 0.5D)"
            f" / {TWO_POW_52!r}D)")


def _u(dialect, seed, stream, id_col, part=0):
    if dialect == "spark":
        return _u_spark(seed, stream, id_col, part)
    return keyed_uniform_sql(seed, stream, id_col, part=part)


def _lit(x, dialect):
    if isinstance(x, str):
        return "'" + x.replace("'", "''") + "'"
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, int):
        return str(x)
    return f"{float(x)!r}D" if dialect == "spark" else f"{float(x)!r}::DOUBLE"


def _normal(dialect, seed, stream, id_col):
    u1 = _u(dialect, seed, stream + ":n", id_col, 0)
    u2 = _u(dialect, seed, stream + ":n", id_col, 1)
    return f"(sqrt(-2.0 * ln({u1})) * cos({_lit(TWO_PI, dialect)} * {u2}))"


def column_sql(name, kind, params, seed, id_col, dialect):
    """One SQL expression for one spec entry."""
    p = dict(params)
    L = lambda x: _lit(x, dialect)
    if kind == "uniform":
        e = f"({L(p['lo'])} + ({L(p['hi'])} - {L(p['lo'])}) * {_u(dialect, seed, name, id_col)})"
    elif kind == "int_range":
        span = p["hi"] - p["lo"]
        e = f"CAST({p['lo']} + floor({_u(dialect, seed, name, id_col)} * {L(float(span))}) AS BIGINT)"
    elif kind == "normal":
        e = f"({L(p['mu'])} + {L(p['sd'])} * {_normal(dialect, seed, name, id_col)})"
    elif kind == "lognormal":
        e = f"exp({L(p['mu'])} + {L(p['sigma'])} * {_normal(dialect, seed, name, id_col)})"
    elif kind == "bernoulli":
        e = f"CAST({_u(dialect, seed, name, id_col)} < {L(p['p'])} AS INTEGER)"
    elif kind == "choice":
        vals = p["values"]
        probs = p.get("probs") or [1.0 / len(vals)] * len(vals)
        u = _u(dialect, seed, name, id_col)
        cum, parts = 0.0, []
        for v, pr in zip(vals[:-1], probs[:-1]):
            cum += pr
            parts.append(f"WHEN {u} < {L(cum)} THEN {L(v)}")
        e = f"(CASE {' '.join(parts)} ELSE {L(vals[-1])} END)"
    elif kind == "fmt":
        fn = "format_string" if dialect == "spark" else "printf"
        e = f"{fn}('{p['pattern']}', {id_col})"
    elif kind == "expr":
        e = f"({p['sql']})"
    else:
        raise ValueError(f"unknown kind {kind}")
    if "clip" in p:
        lo, hi = p["clip"]
        e = f"least(greatest({e}, {L(lo)}), {L(hi)})"
    if "round" in p:
        e = f"round({e}, {p['round']})"
    if "cast" in p:
        e = f"CAST({e} AS {p['cast']})"
    return e


def spec_sql(spec, seed, id_col: str, dialect: str) -> list[str]:
    return [f"{column_sql(n, k, prm, seed, id_col, dialect)} AS {n}" for n, k, prm in spec]


def synthesize(ids: DataFrame, spec, seed, id_col: str = "id") -> DataFrame:
    """A1: one row per id, columns drawn by ``spec`` (helpers dropped)."""
    df = ids.selectExpr(id_col, *spec_sql(spec, seed, id_col, "spark"))
    return df.select(id_col, *[n for n, _k, _p in spec if not n.startswith("_")])


def synthesize_sql(ids_sql: str, spec, seed, id_col: str = "id") -> str:
    inner = f"SELECT {id_col}, {', '.join(spec_sql(spec, seed, id_col, 'duckdb'))} FROM ({ids_sql}) ids"
    keep = ", ".join([id_col] + [n for n, _k, _p in spec if not n.startswith("_")])
    return f"SELECT {keep} FROM ({inner}) g"


# ---------------------------------------------------------------------------
# Presets — fixed distribution parameters of the reference cohorts.
# ---------------------------------------------------------------------------

def ehr_readmission():
    """A2: 11 columns; AST = ALT × U(0.7, 1.3); CKD = creatinine > 1.8;
    30-day readmission from logistic log-odds."""
    return [
        ("age", "int_range", {"lo": 18, "hi": 85}),
        ("sex", "bernoulli", {"p": 0.48}),
        ("_bmi", "normal", {"mu": 28.5, "sd": 5.2, "clip": (16.0, 55.0)}),
        ("_alt", "lognormal", {"mu": 3.6, "sigma": 0.4, "clip": (5.0, 200.0)}),
        ("_ast_f", "uniform", {"lo": 0.7, "hi": 1.3}),
        ("_creat", "lognormal", {"mu": 0.1, "sigma": 0.35, "clip": (0.4, 6.0)}),
        ("_hba1c", "normal", {"mu": 6.5, "sd": 1.2, "clip": (4.5, 14.0)}),
        ("diabetes", "bernoulli", {"p": 0.18}),
        ("hypertension", "bernoulli", {"p": 0.30}),
        ("ckd", "expr", {"sql": "CAST(_creat > 1.8 AS INTEGER)"}),
        ("_noise", "normal", {"mu": 0.0, "sd": 0.5}),
        ("_logodds", "expr", {"sql": "-3.0 + 0.03 * (age - 50) + 0.8 * diabetes + 0.6 * ckd"
                                     " + 0.4 * hypertension + 0.01 * (_alt - 40) + _noise"}),
        ("_ru", "uniform", {"lo": 0.0, "hi": 1.0}),
        ("readmission_30d", "expr", {"sql": "CAST(_ru < 1.0 / (1.0 + exp(-_logodds)) AS INTEGER)"}),
        ("bmi", "expr", {"sql": "round(_bmi, 1)"}),
        ("alt_u_per_l", "expr", {"sql": "round(_alt, 1)"}),
        ("ast_u_per_l", "expr", {"sql": "round(_alt * _ast_f, 1)"}),
        ("creatinine_mg_dl", "expr", {"sql": "round(_creat, 2)"}),
        ("hba1c_pct", "expr", {"sql": "round(_hba1c, 1)"}),
    ]


AE_DRUGS = ["DrugAlpha (synthetic)", "DrugBeta (synthetic)", "DrugGamma (synthetic)",
            "DrugDelta (synthetic)", "DrugEpsilon (synthetic)"]
AE_TERMS = ["hepatotoxicity", "rash", "nausea", "fatigue", "elevated ALT", "elevated AST",
            "pruritus", "jaundice", "abdominal pain", "dizziness"]
AE_OUTCOMES = ["recovered", "recovering", "not_recovered", "fatal", "unknown"]
AGE_GROUPS = ["<18", "18-44", "45-64", "65-74", "75+"]
REPORTER_TYPES = ["physician", "pharmacist", "consumer", "lawyer"]


def adverse_event_reports():
    """A3: seven report columns with weighted outcome and reporter type."""
    return [
        ("report_id", "fmt", {"pattern": "SYN-%06d"}),
        ("drug_name", "choice", {"values": AE_DRUGS}),
        ("ae_term", "choice", {"values": AE_TERMS}),
        ("patient_age_group", "choice", {"values": AGE_GROUPS}),
        ("outcome", "choice", {"values": AE_OUTCOMES, "probs": [0.50, 0.25, 0.10, 0.05, 0.10]}),
        ("days_to_onset", "int_range", {"lo": 1, "hi": 180}),
        ("reporter_type", "choice", {"values": REPORTER_TYPES, "probs": [0.45, 0.30, 0.20, 0.05]}),
    ]


def ehr_liver_risk():
    """A4: nine columns incl. five-way ethnicity; label = probability > 0.5."""
    return [
        ("patient_id", "fmt", {"pattern": "SYN%05d"}),
        ("age", "int_range", {"lo": 18, "hi": 90}),
        ("sex", "choice", {"values": [0, 1]}),
        ("ethnicity", "choice", {"values": [0, 1, 2, 3, 4], "probs": [0.60, 0.18, 0.13, 0.06, 0.03]}),
        ("_ldl", "normal", {"mu": 130.0, "sd": 35.0, "clip": (40.0, 300.0)}),
        ("_sbp", "normal", {"mu": 130.0, "sd": 20.0, "clip": (80.0, 220.0)}),
        ("_hba1c", "normal", {"mu": 6.5, "sd": 1.5, "clip": (4.0, 14.0)}),
        ("_creat", "lognormal", {"mu": 0.1, "sigma": 0.3, "clip": (0.5, 10.0)}),
        ("_noise", "normal", {"mu": 0.0, "sd": 0.5}),
        ("_logodds", "expr", {"sql": "-3.0 + 0.02 * (age - 50) + 0.01 * (_ldl - 130) + 0.015 * (_sbp - 130)"
                                     " + 0.3 * (_hba1c - 6.5) + _noise"}),
        ("ldl_mg_dl", "expr", {"sql": "round(_ldl, 1)"}),
        ("systolic_bp_mmhg", "expr", {"sql": "round(_sbp, 1)"}),
        ("hba1c_pct", "expr", {"sql": "round(_hba1c, 2)"}),
        ("creatinine_mg_dl", "expr", {"sql": "round(_creat, 3)"}),
        ("dili_risk", "expr", {"sql": "CAST(1.0 / (1.0 + exp(-_logodds)) > 0.5 AS INTEGER)"}),
    ]


SC_DRUGS = ["DrugA", "DrugB", "DrugC", "DrugD", "DrugE"]
SC_AE_TYPES = ["Hepatotoxicity", "Cardiotoxicity", "Nephrotoxicity", "Neurotoxicity", "Dermatitis",
               "Nausea", "Fatigue"]
SC_OUTCOMES = ["Recovered", "Not_Recovered", "Death", "Unknown"]
SC_REPORTERS = ["Physician", "Pharmacist", "Consumer", "Lawyer", "Unknown"]


def safety_cases():
    """A5: ten case columns."""
    return [
        ("case_id", "fmt", {"pattern": "AE%06d"}),
        ("drug", "choice", {"values": SC_DRUGS}),
        ("ae_type", "choice", {"values": SC_AE_TYPES}),
        ("age", "int_range", {"lo": 18, "hi": 85}),
        ("sex", "choice", {"values": ["M", "F", "U"], "probs": [0.45, 0.45, 0.10]}),
        ("outcome", "choice", {"values": SC_OUTCOMES, "probs": [0.55, 0.25, 0.08, 0.12]}),
        ("reporter", "choice", {"values": SC_REPORTERS}),
        ("serious", "choice", {"values": [0, 1], "probs": [0.6, 0.4]}),
        ("days_to_onset", "int_range", {"lo": 1, "hi": 180}),
        ("concomitant_drugs", "int_range", {"lo": 0, "hi": 5}),
    ]


LIVER_FEATURES = ["ALT", "AST", "Bilirubin", "ALP", "GGT", "Albumin", "Creatinine", "CYP3A4"]
LIVER_LOC = [1.0, 1.0, 0.8, 1.2, 0.9, 1.1, 0.7, 1.0]
LIVER_SCALE = [0.3, 0.4, 0.2, 0.5, 0.3, 0.4, 0.2, 0.3]


def liver_frame():
    """Eight biomarkers, 12 % positives, first three raised in positives,
    clipped to [0, 5] (published at 6 decimals)."""
    spec = [("dili", "bernoulli", {"p": 0.12})]
    for i, (f, mu, sd) in enumerate(zip(LIVER_FEATURES, LIVER_LOC, LIVER_SCALE)):
        spec.append((f"_{f}", "normal", {"mu": mu, "sd": sd}))
        if i < 3:
            spec.append((f"_{f}_up", "uniform", {"lo": 0.5, "hi": 1.5}))
            spec.append((f, "expr", {"sql": f"round(least(greatest(_{f} + dili * _{f}_up, 0.0), 5.0), 6)"}))
        else:
            spec.append((f, "expr", {"sql": f"round(least(greatest(_{f}, 0.0), 5.0), 6)"}))
    return spec


WIDE_47 = (["MolWeight", "LogP", "HBD", "HBA", "RotBonds", "TPSA", "AromaticRings", "HeavyAtomCount"]
           + ["MTT_IC50", "LDH_release", "ATP_depletion", "Caspase3_activity", "ROS_production",
              "MitoMembranePotential"]
           + ["ALT", "AST", "ALP", "TotalBilirubin", "GGT"]
           + ["Cmax", "AUC_0inf", "HalfLife", "CL_F"]
           + ["Age", "Sex", "BMI", "eGFR", "AlbuminLevel", "ConcomitantMeds"]
           + ["CYP1A2", "CYP3A4", "UGT1A1", "ABCB1", "ABCG2", "SLC22A1", "HMOX1", "NRF2"]
           + ["Dose_mg", "DurationDays", "RouteOral", "Polypharmacy_score"]
           + ["random_1", "random_2", "random_3", "random_4", "random_5", "random_6"])


def wide_47():
    """47 standard-normal named features, 10 % positives, first ten
    shifted by U(0.4, 0.9) in positives."""
    spec = [("dili", "bernoulli", {"p": 0.10})]
    for i, f in enumerate(WIDE_47):
        spec.append((f"_{f}", "normal", {"mu": 0.0, "sd": 1.0}))
        if i < 10:
            spec.append((f"_{f}_up", "uniform", {"lo": 0.4, "hi": 0.9}))
            spec.append((f, "expr", {"sql": f"round(_{f} + dili * _{f}_up, 6)"}))
        else:
            spec.append((f, "expr", {"sql": f"round(_{f}, 6)"}))
    return spec


def uniform_8():
    """Eight U(0, 1) features."""
    return [(f"f{i}", "uniform", {"lo": 0.0, "hi": 1.0}) for i in range(8)]


def multi_site_sql_parts(seed, site_col: str, id_col: str, dialect: str) -> list[str]:
    """Non-IID sites — per-site mean shift U(−.2, .2) per feature and
    prevalence U(.08, .18) (keyed by site), features N(1 + shift, .35)
    clipped to [0, 5], label Bernoulli(prevalence), first three features
    raised by U(.3, 1.0) in positives, clipped again."""
    L = lambda x: _lit(x, dialect)
    parts = [f"({L(0.08)} + {L(0.10)} * {_u(dialect, seed, 'site_prev', site_col)}) AS _prev",
             f"CAST({_u(dialect, seed, 'label', id_col)} < _prev AS INTEGER) AS label"]
    for i in range(8):
        shift = f"({L(-0.2)} + {L(0.4)} * {_u(dialect, seed, f'site_shift{i}', site_col)})"
        x = f"least(greatest({L(1.0)} + {shift} + {L(0.35)} * {_normal(dialect, seed, f'f{i}', id_col)}, 0.0), 5.0)"
        if i < 3:
            up = f"({L(0.3)} + {L(0.7)} * {_u(dialect, seed, f'up{i}', id_col)})"
            x = f"least(greatest({x} + label * {up}, 0.0), 5.0)"
        parts.append(f"round({x}, 6) AS f{i}")
    return parts


def multi_site(ids: DataFrame, seed, site_col: str = "site_id", id_col: str = "id") -> DataFrame:
    df = ids.selectExpr(id_col, site_col, *multi_site_sql_parts(seed, site_col, id_col, "spark"))
    return df.select(id_col, site_col, "label", *[f"f{i}" for i in range(8)])
