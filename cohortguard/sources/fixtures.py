"""Fixed reference values (dimension tables).

Everything in this module is a fixed value that must equal the reference's
for identical scores: the privacy-by-design checklist (7 principles, 22
questions and their weights), the remediation advice per principle, the
risk-level order, and the worked examples used by golden tests.  They are
small dimension tables; operators join them (broadcast, size-checked).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# Fixed values — privacy-by-design checklist.
# (principle_id, principle name, question_id, question text, weight)
# ---------------------------------------------------------------------------
PRINCIPLES = (
    (1, "Proactive not Reactive; Preventative not Remedial"),
    (2, "Privacy as the Default Setting"),
    (3, "Privacy Embedded into Design"),
    (4, "Full Functionality — Positive-Sum, not Zero-Sum"),
    (5, "End-to-End Security — Full Lifecycle Protection"),
    (6, "Visibility and Transparency"),
    (7, "Respect for User Privacy — Keep it User-Centric"),
)

QUESTIONS = (
    (1, "P1-Q1", "PIA completed before model development?", 0.40),
    (1, "P1-Q2", "STRIDE threat models applied before training?", 0.30),
    (1, "P1-Q3", "Documented privacy budget allocated prior to deployment?", 0.30),
    (2, "P2-Q1", "Minimum necessary data collected by default?", 0.35),
    (2, "P2-Q2", "Model outputs de-identified by default before sharing?", 0.35),
    (2, "P2-Q3", "API endpoints return only required fields by role?", 0.30),
    (3, "P3-Q1", "DP or FL embedded natively in training pipeline?", 0.40),
    (3, "P3-Q2", "Encryption integrated at the data layer?", 0.30),
    (3, "P3-Q3", "Privacy engineer reviewed architecture before build?", 0.30),
    (4, "P4-Q1", "Privacy-utility tradeoff formally measured?", 0.40),
    (4, "P4-Q2", "Privacy controls do not reduce performance below threshold?", 0.35),
    (4, "P4-Q3", "Privacy-preserving alternatives evaluated before de-ID?", 0.25),
    (5, "P5-Q1", "Data encrypted in transit (TLS 1.3+) and at rest?", 0.30),
    (5, "P5-Q2", "Tamper-evident audit logs for training and inference?", 0.30),
    (5, "P5-Q3", "Retention and secure destruction schedule enforced?", 0.25),
    (5, "P5-Q4", "Model inversion / membership inference assessment done?", 0.15),
    (6, "P6-Q1", "Model card published internally?", 0.35),
    (6, "P6-Q2", "Participants notified in plain language of AI use?", 0.35),
    (6, "P6-Q3", "PIA accessible to compliance and DPO without special access?", 0.30),
    (7, "P7-Q1", "Mechanism to withdraw consent and remove data from training?", 0.40),
    (7, "P7-Q2", "Consent granular — per use case?", 0.35),
    (7, "P7-Q3", "Consent reviewed for plain-language understandability?", 0.25),
)

REMEDIATION = (
    ("Proactive not Reactive; Preventative not Remedial",
     "Complete STRIDE threat model and PIA before next sprint. Establish privacy budget before training."),
    ("Privacy as the Default Setting",
     "Audit all API endpoints for over-sharing. Enforce data minimization at ingestion layer."),
    ("Privacy Embedded into Design",
     "Refactor pipeline to embed DP-SGD (Opacus) or FL natively. Remove bolt-on anonymization."),
    ("Full Functionality — Positive-Sum, not Zero-Sum",
     "Run epsilon vs AUC curves. Document clinical acceptance thresholds before epsilon selection."),
    ("End-to-End Security — Full Lifecycle Protection",
     "Implement immutable audit logging. Commission model inversion risk assessment."),
    ("Visibility and Transparency",
     "Publish model card this quarter. Draft patient-facing plain-language AI notice."),
    ("Respect for User Privacy — Keep it User-Centric",
     "Implement consent ledger with granular per-use-case consent."),
)
DEFAULT_REMEDIATION = "Review."

# Letter-grade bands (lower bound, grade), highest first.
CHECKLIST_GRADES = ((90.0, "A"), (80.0, "B"), (70.0, "C"), (60.0, "D"))
TSTR_GRADES = ((80.0, "A"), (70.0, "B"), (60.0, "C"))
CHECKLIST_PASS = 70.0
CRITERIA_PASS = 0.7

# Risk levels, most severe first (ordinal 1 = Critical).
RISK_LEVELS = ("Critical", "High", "Medium", "Low", "Negligible")

STRIDE_THREATS = (
    "Spoofing (identity impersonation in training pipeline)",
    "Tampering (data poisoning or label manipulation)",
    "Repudiation (no audit trail for model decisions)",
    "Information Disclosure (model inversion / membership inference)",
    "Denial of Service (privacy budget exhaustion attack)",
    "Elevation of Privilege (unauthorized access to raw training data)",
)

# Privacy tiers of features; unlisted features are "Benign".
TIER_DIRECT, TIER_QUASI, TIER_BENIGN = "Direct ID", "Quasi-ID", "Benign"

# ROI: maximum fine as a share of annual revenue, and the decision threshold.
GDPR_FINE_RATE = 0.04
ROI_INVEST_THRESHOLD = 1.0
ROI_INVEST = "INVEST — positive P-ROI"
ROI_REVIEW = "REVIEW — marginal or negative P-ROI"
# ---------------------------------------------------------------------------


def checklist(spark: SparkSession) -> DataFrame:
    """Long checklist dimension: one row per question (22 rows)."""
    names = dict(PRINCIPLES)
    rows = [(pid, names[pid], qid, i, text, float(w))
            for i, (pid, qid, text, w) in enumerate(QUESTIONS)]
    return spark.createDataFrame(
        rows, "principle_id int, principle string, question_id string, question_pos int, "
              "text string, weight double")


def remediation(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REMEDIATION), "principle string, advice string")


def risk_levels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(lvl, i + 1) for i, lvl in enumerate(RISK_LEVELS)],
                                 "level string, severity int")


def checklist_sql() -> str:
    names = dict(PRINCIPLES)
    vals = ", ".join(
        f"({pid}, '{names[pid]}', '{qid}', {i}, {w!r}::DOUBLE)"
        for i, (pid, qid, _t, w) in enumerate(QUESTIONS))
    return f"(VALUES {vals}) AS checklist(principle_id, principle, question_id, question_pos, weight)"


def remediation_sql() -> str:
    vals = ", ".join(f"('{p}', '{a}')" for p, a in REMEDIATION)
    return f"(VALUES {vals}) AS remediation(principle, advice)"


def risk_levels_sql() -> str:
    vals = ", ".join(f"('{lvl}', {i + 1})" for i, lvl in enumerate(RISK_LEVELS))
    return f"(VALUES {vals}) AS risk_levels(level, severity)"
