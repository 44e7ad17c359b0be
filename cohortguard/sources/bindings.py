"""Bindings: the library's input tables, derived by Spark from driver tables.

The operators take health-data shaped tables (consent requests, budget
operations, cohorts, model updates, secrets, checklist answers …).  The
driver ships TPC-H-like tables instead, so each binding below derives one
operator input from them with plain projections, joins and aggregates.
Every binding reads whole tables — its output grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import pseudonymize
from ..operators.common import with_dimension
from .tables import read

# ---------------------------------------------------------------------------
# Fixed parameters of the bindings.
# ---------------------------------------------------------------------------
N_LEDGER_SHARDS = 8
N_USE_CASES = 3
REGISTERED_USE_CASES = ("UC0", "UC1")
CONSENT_VERSION = "v1.0"
BUDGET_TOTAL_MICRO = 2_000_000          # T2: 2.0 ε per user budget
ALLOCATION_TOTAL_MICRO = 1_000_000_000  # T3: 1,000 ε per brand
N_SIGNAL_DRUGS = 20
N_SIGNAL_SYSTEMS = 5
N_SECRET_PARTIES = 3
# ---------------------------------------------------------------------------


# T1 — consent requests from events ----------------------------------------

def consent_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One consent request per event: subject = user, use case = event_id % 3,
    WITHDRAW for error events, GRANT otherwise; shard = user % 8."""
    return consent_requests_from(read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type"))


def consent_requests_from(ev: DataFrame) -> DataFrame:
    """T1 on any events DataFrame (batch or streaming)."""
    return ev.select(
        F.concat(F.lit("L"), (F.col("user_id") % N_LEDGER_SHARDS).cast("string")).alias("ledger_id"),
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("record_id"),
        F.col("event_id").alias("request_seq"),
        F.col("user_id").alias("subject_id"),
        pseudonymize("user_id").alias("patient_pseudonym"),
        F.concat(F.lit("UC"), (F.col("event_id") % N_USE_CASES).cast("string")).alias("use_case_id"),
        F.when(F.col("event_type") == "error", F.lit("WITHDRAW")).otherwise(F.lit("GRANT")).alias("action"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("date").alias("expiry_date"),
        F.lit(CONSENT_VERSION).alias("version"),
    )


def use_case_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(uc, f"registered use case {uc}") for uc in REGISTERED_USE_CASES],
        "use_case_id string, description string")


def registry_sql() -> str:
    rows = ", ".join(f"('{uc}', 'registered use case {uc}')" for uc in REGISTERED_USE_CASES)
    return f"(VALUES {rows}) AS registry(use_case_id, description)"


# T2 — budget operations from events -----------------------------------------

def budget_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event charges round(value·1000) micro-ε to its user's budget."""
    return budget_ops_from(read(spark, sf_dir, "events", "event_id", "ts", "user_id", "value"))


def budget_ops_from(ev: DataFrame) -> DataFrame:
    """T2 on any events DataFrame (batch or streaming)."""
    return ev.select(
        F.col("user_id").alias("budget_id"),
        F.col("event_id").alias("op_id"),
        F.col("ts"),
        F.round(F.col("value") * 1000).cast("long").alias("epsilon_micro"))


# T3 — allocation requests from parts ----------------------------------------

def allocation_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size", "p_retailprice")
    return p.select(
        F.col("p_brand").alias("budget_id"),
        F.col("p_partkey").alias("op_id"),
        F.col("p_partkey").alias("seq"),
        (F.col("p_size").cast("long") * 1_000_000).alias("epsilon_micro"),
        F.col("p_retailprice").alias("utility_value"),
        (F.lit(1) + F.col("p_partkey") % 3).cast("int").alias("priority_tier"),
        (F.col("p_partkey") % 2 == 0).alias("can_be_deferred"))


# T4 — customer cohort ---------------------------------------------------------

COHORT_FEATURES = ("acctbal", "n_orders", "mean_price", "span_days")


def customer_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer with orders: balance, order count, mean order price,
    days between first and last order; label = total spend above the mean
    spend of all such customers."""
    o = read(spark, sf_dir, "orders", "o_custkey", "o_totalprice", "o_orderdate")
    c = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    per = (o.groupBy("o_custkey")
           .agg(F.count(F.lit(1)).alias("n_orders"),
                F.sum("o_totalprice").alias("spend"),
                F.avg("o_totalprice").alias("mean_price"),
                F.datediff(F.max("o_orderdate").cast("date"), F.min("o_orderdate").cast("date"))
                .alias("span_days")))
    avg_spend = per.agg(F.avg("spend")).scalar()
    return (c.join(per, c.c_custkey == per.o_custkey, "inner")
            .withColumn("_avg_spend", avg_spend)
            .select(F.col("c_custkey").alias("id"), "c_nationkey", "c_mktsegment",
                    F.col("c_acctbal").alias("acctbal"),
                    F.col("n_orders").cast("double").alias("n_orders"),
                    "mean_price",
                    F.col("span_days").cast("double").alias("span_days"),
                    (F.col("spend") > F.col("_avg_spend")).cast("int").alias("label")))


COHORT_SQL = """(
  SELECT c_custkey AS id, c_nationkey, c_mktsegment, c_acctbal AS acctbal,
         CAST(n_orders AS DOUBLE) AS n_orders, mean_price,
         CAST(span_days AS DOUBLE) AS span_days,
         CAST(spend > avg(spend) OVER () AS INTEGER) AS label
  FROM customer JOIN (
      SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spend,
             avg(o_totalprice) AS mean_price,
             date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) AS span_days
      FROM orders GROUP BY o_custkey) per ON c_custkey = o_custkey
)"""


# T6 — fairness predictions -------------------------------------------------

def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """y_true = labelled quality, y_pred = long document, group = language."""
    lab = read(spark, sf_dir, "labels", "doc_id", "quality")
    doc = read(spark, sf_dir, "documents", "doc_id", "lang", "n_chars")
    return (lab.join(doc, "doc_id")
            .select(F.col("doc_id").alias("id"),
                    F.col("quality").cast("int").alias("y_true"),
                    (F.col("n_chars") > 1000).cast("int").alias("y_pred"),
                    F.log1p(F.col("n_chars").cast("double")).alias("score"),
                    F.col("lang").alias("sensitive")))


# T7 — event counts for the signal ------------------------------------------

def signal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_returnflag")
    return (li.groupBy((F.col("l_partkey") % N_SIGNAL_DRUGS).alias("drug"),
                       F.col("l_returnflag").alias("event"),
                       (F.col("l_suppkey") % N_SIGNAL_SYSTEMS).alias("system"))
            .agg(F.count(F.lit(1)).alias("n")))


# T8 — per-device / per-site model vectors ------------------------------------

def site_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 64-d update per embedding row; site = label."""
    e = read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return e.select(F.col("vec_id").alias("device_id"),
                    F.concat(F.lit("site_"), F.col("label").cast("string")).alias("site_id"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("w"))


# T9 — secrets ------------------------------------------------------------------

def order_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderpriority")
    return o.select(F.col("o_orderkey").alias("row_id"),
                    F.col("o_orderpriority").alias("key"),
                    F.round(F.col("o_totalprice") * 100).cast("long").alias("secret"))


# T11 — ROI scenarios ---------------------------------------------------------

def nation_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual revenue per nation from its customers' orders; other returns
    and the investment are fixed fractions of revenue."""
    o = read(spark, sf_dir, "orders", "o_custkey", "o_totalprice")
    c = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    rev = (o.join(c, o.o_custkey == c.c_custkey)
           .groupBy("c_nationkey").agg(F.sum("o_totalprice").alias("annual_revenue_eur")))
    return (rev.join(n, rev.c_nationkey == n.n_nationkey)
            .select(F.col("n_name").alias("scenario"),
                    "annual_revenue_eur",
                    F.lit(8.0).alias("breach_probability_pct"),
                    (F.col("annual_revenue_eur") * 0.0015).alias("privacy_investment_eur"),
                    (F.col("annual_revenue_eur") * 0.001).alias("approval_value_eur"),
                    (F.col("annual_revenue_eur") * 0.0008).alias("trust_premium_eur"),
                    (F.col("annual_revenue_eur") * 0.0005).alias("regulatory_dividend_eur"),
                    F.lit(0.75).alias("control_effectiveness")))


# T12 — audit events -------------------------------------------------------

def audit_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_source_from(read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props"))


def audit_source_from(ev: DataFrame) -> DataFrame:
    """T12 on any events DataFrame (batch or streaming)."""
    return ev.select(F.col("ts").cast("timestamp").alias("timestamp"),
                     F.concat(F.lit("s"), (F.col("user_id") % 10).cast("string")).alias("session_id"),
                     F.lit("events").alias("context"),
                     F.upper("event_type").alias("event_type"),
                     F.col("props").alias("details"),
                     "event_id")


# T10 — checklist answers: one project per supplier ----------------------------

def checklist_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier × checklist: answer = ((suppkey·7 + question_pos) % 3) / 2;
    even suppliers cite "P1-Q2" ids, odd ones "1.2"; a question is left
    unanswered when (suppkey + question_pos) % 11 = 0."""
    from .fixtures import checklist
    s = read(spark, sf_dir, "supplier", "s_suppkey")
    g = with_dimension(s, checklist(spark))  # 22-row literal questionnaire
    dotted = F.concat(F.col("principle_id").cast("string"), F.lit("."),
                      F.regexp_extract("question_id", r"Q(\d+)$", 1))
    ref = F.when(F.col("s_suppkey") % 2 == 0, F.col("question_id")).otherwise(dotted)
    return (g.where((F.col("s_suppkey") + F.col("question_pos")) % 11 != 0)
            .select(F.col("s_suppkey").alias("project"), ref.alias("question_ref"),
                    (((F.col("s_suppkey") * 7 + F.col("question_pos")) % 3).cast("double") / 2.0)
                    .alias("answer")))


def checklist_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier", "s_suppkey").select(F.col("s_suppkey").alias("project"))


# T13 — impact assessments: one per supplier ------------------------------------

def _levels_expr(idx):
    from .fixtures import RISK_LEVELS
    arr = F.array(*[F.lit(x) for x in RISK_LEVELS])
    return F.element_at(arr, (idx + F.lit(1)).cast("int"))


def assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier", "s_suppkey")
    lvl = _levels_expr(F.col("s_suppkey") % 4)
    return s.select(F.col("s_suppkey").alias("project"), lvl.alias("overall_residual_risk"),
                    lvl.isin("Medium", "Low").alias("approved_for_deployment"))


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: the supplier (a project), the part's brand (a
    data asset), the order's priority (a purpose), and whether the line was
    returned and went to another nation."""
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    p = read(spark, sf_dir, "part", "p_partkey", "p_brand")
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    c = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    s = read(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    rows = (li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
            .join(c, o.o_custkey == c.c_custkey).join(s, li.l_suppkey == s.s_suppkey))
    return rows.select(F.col("s_suppkey").alias("project"), F.col("p_brand").alias("asset_name"),
                       F.col("o_orderpriority").alias("purpose_id"), (F.col("l_returnflag") == "R").alias("returned"),
                       (F.col("c_nationkey") != F.col("s_nationkey")).alias("abroad"))


DELIVERIES_SQL = """(
  SELECT s_suppkey AS project, p_brand AS asset_name, o_orderpriority AS purpose_id, l_returnflag = 'R' AS returned,
         c_nationkey <> s_nationkey AS abroad
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""


def assessment_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands that a supplier delivers; they cross borders if any line does."""
    return (_deliveries(spark, sf_dir).groupBy("project", "asset_name")
            .agg(F.bool_or("abroad").alias("cross_border_transfer")))


def assessment_purposes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities of the orders that a supplier delivers to."""
    return _deliveries(spark, sf_dir).select("project", "purpose_id").distinct()


def assessment_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line that was not returned documents its brand for its priority."""
    return (_deliveries(spark, sf_dir).where(~F.col("returned"))
            .select("project", "asset_name", "purpose_id").distinct())


def assessment_threats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three STRIDE threats per project with a residual risk level."""
    from .fixtures import STRIDE_THREATS
    s = read(spark, sf_dir, "supplier", "s_suppkey")
    threats = F.array(*[F.lit(t) for t in STRIDE_THREATS])
    x = s.select(F.col("s_suppkey").alias("project"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("j"))
    return x.select("project", "j",
                    F.element_at(threats, ((F.col("project") + F.col("j")) % 6 + 1).cast("int")).alias("threat"),
                    _levels_expr((F.col("project") + 2 * F.col("j")) % 5).alias("residual_risk"))


def assessment_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier", "s_suppkey")
    return s.select(F.col("s_suppkey").alias("project"),
                    F.explode(F.sequence(F.lit(1), (F.lit(1) + F.col("s_suppkey") % 3).cast("int")))
                    .alias("gap_no"))


def assessment_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assessments(spark, sf_dir).where(~F.col("approved_for_deployment"))
    return a.select("project", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("condition_no"))
