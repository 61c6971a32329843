"""Column names, projections and row-level expressions."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from creditspark import schema as S
from creditspark.functions import loan as L, numeric as N
from creditspark.operators import canonical as C, columns as K
from creditspark.plans.fixtures import ctes, dirty_loans, labels_feed, loans, prediction_log, raw_card, runs
from creditspark.plans.registry import query

CARD = ctes("raw_card")
LOANS = ctes("loans")


@query("normalize_columns", CARD + "SELECT id, limit_bal, age, default_payment_next_month FROM raw_card")
def _(spark, sf):
    df = raw_card(spark, sf).select("id", "limit_bal", "age", "default_payment_next_month")
    return K.normalize_columns(df.toDF(" ID", "Limit-Bal", "AGE ", "Default Payment-Next Month"))


@query(
    "rename_map",
    CARD + "SELECT id AS loan_id, limit_bal AS credit_limit, pay_0 AS payment_status_1, "
    "bill_amt1 AS bill_amount_1, default_payment_next_month AS loan_default FROM raw_card",
)
def _(spark, sf):
    df = raw_card(spark, sf).select("id", "limit_bal", "pay_0", "bill_amt1", "default_payment_next_month")
    df = df.toDF("ID", "LIMIT_BAL", "PAY_0", "BILL_AMT1", "default.payment.next.month")
    return K.rename_present(df, S.CARD_RENAMES)


CANONICAL = """
canon AS (
  SELECT *, least(greatest(limit_bal * 3, 1e3), 1e7) AS inc0,
    CAST(pay_0 <= 0 AS INT) + CAST(pay_2 <= 0 AS INT) + CAST(pay_3 <= 0 AS INT) + CAST(pay_4 <= 0 AS INT)
      + CAST(pay_5 <= 0 AS INT) + CAST(pay_6 <= 0 AS INT) AS on_time,
    CAST(pay_amt1 > 0 AS INT) + CAST(pay_amt2 > 0 AS INT) + CAST(pay_amt3 > 0 AS INT)
      + CAST(pay_amt4 > 0 AS INT) + CAST(pay_amt5 > 0 AS INT) + CAST(pay_amt6 > 0 AS INT) AS paid
  FROM raw_card
),
canonical AS (
  SELECT printf('LOAN_%07d', id) AS loan_id,
    round_even(least(greatest(limit_bal, 1e2), 1e5) * 100, 0) / 100 AS loan_amount,
    round_even(inc0 * 100, 0) / 100 AS annual_income,
    CAST(least(greatest(age - 22, 0), 50) AS BIGINT) AS employment_years,
    CAST(floor(300 + 550 * (on_time / 6)) AS BIGINT) AS credit_score,
    round_even(least(greatest(bill_amt1 / (round_even(inc0 * 100, 0) / 100 / 12), 0e0), 2e0) * 10000, 0) / 10000 AS debt_to_income_ratio,
    CAST(greatest(paid, 1) AS BIGINT) AS num_open_accounts,
    CAST(6 - on_time AS BIGINT) AS num_delinquencies,
    CASE education WHEN 1 THEN 'home_improvement' WHEN 2 THEN 'debt_consolidation' WHEN 3 THEN 'major_purchase'
      WHEN 5 THEN 'vacation' WHEN 6 THEN 'medical' ELSE 'other' END AS loan_purpose,
    CASE marriage WHEN 1 THEN 'MORTGAGE' WHEN 3 THEN 'OWN' ELSE 'RENT' END AS home_ownership,
    CAST(CASE WHEN limit_bal > 200000 THEN 60 ELSE 36 END AS BIGINT) AS loan_term_months,
    default_payment_next_month AS loan_default
  FROM canon
)"""
CANON = ctes("raw_card", extra=CANONICAL)


@query(
    "resolve_column",
    CANON + "SELECT * REPLACE (5::BIGINT AS employment_years, 'RENT' AS home_ownership) FROM canonical",
)
def _(spark, sf):
    df = raw_card(spark, sf).drop("age", "marriage", "sex")
    df = df.withColumnsRenamed(
        {
            "id": "account",
            "limit_bal": "credit_limit_total",
            "education": "edu_level",
            "default_payment_next_month": "outcome",
        }
    )
    return C.canonicalize(df)


@query("canonicalize_loans", CANON + "SELECT * FROM canonical")
def _(spark, sf):
    return C.canonicalize(raw_card(spark, sf))


@query(
    "select_cast_alias",
    ctes("labels_feed") + "SELECT loan_id, CAST(loan_default AS INTEGER) AS actual_default FROM labels_feed",
)
def _(spark, sf):
    return labels_feed(spark, sf).select("loan_id", F.col("loan_default").cast("int").alias("actual_default"))


@query(
    "drop_columns_if_present",
    LOANS + "SELECT * EXCLUDE (k, pd, as_of, default_probability, loan_id, loan_default) FROM loans",
)
def _(spark, sf):
    return loans(spark, sf).drop("k", "pd", "as_of", "default_probability", "loan_id", "loan_default", "absent")


@query("filter_labeled", ctes("prediction_log") + "SELECT * FROM prediction_log WHERE actual_default IS NOT NULL")
def _(spark, sf):
    return prediction_log(spark, sf).filter(F.col("actual_default").isNotNull())


@query("filter_slice", LOANS + "SELECT loan_id, loan_amount FROM loans WHERE CAST(loan_term_months AS VARCHAR) = '60'")
def _(spark, sf):
    return loans(spark, sf).filter(F.col("loan_term_months").cast("string") == "60").select("loan_id", "loan_amount")


@query(
    "derive_if_absent",
    CARD + "SELECT id, limit_bal AS credit_limit, limit_bal AS annual_income, limit_bal AS loan_amount FROM raw_card",
)
def _(spark, sf):
    df = raw_card(spark, sf).select("id", F.col("limit_bal").alias("credit_limit"))
    return K.derive_if_absent(df, "credit_limit", ["annual_income", "loan_amount"])


@query(
    "predict_columns",
    LOANS + "SELECT loan_id, loan_amount, annual_income, employment_years, credit_score, debt_to_income_ratio, "
    "num_open_accounts, num_delinquencies, loan_term_months, loan_purpose, home_ownership FROM loans",
)
def _(spark, sf):
    return loans(spark, sf).select("loan_id", *S.NUMERIC_FEATURES, *S.CATEGORICAL_FEATURES)


@query(
    "lookup_map",
    CARD + """SELECT id,
    CASE education WHEN 1 THEN 'home_improvement' WHEN 2 THEN 'debt_consolidation' WHEN 3 THEN 'major_purchase'
      WHEN 5 THEN 'vacation' WHEN 6 THEN 'medical' ELSE 'other' END AS loan_purpose,
    CASE marriage WHEN 1 THEN 'MORTGAGE' WHEN 3 THEN 'OWN' ELSE 'RENT' END AS home_ownership FROM raw_card""",
)
def _(spark, sf):
    df = raw_card(spark, sf)
    marriage_text = F.col("marriage").cast("string")
    return df.select(
        "id",
        K.lookup(F.col("education"), T.LongType(), S.EDUCATION_TO_PURPOSE, "other").alias("loan_purpose"),
        K.lookup(marriage_text, T.StringType(), S.MARRIAGE_TO_OWNERSHIP, "RENT").alias("home_ownership"),
    )


def _loan_expr(name: str, sql_expr: str, expr, source=loans, base: str = LOANS, frm: str = "loans", key: str = "loan_id"):
    """A query that returns the id and one computed column."""
    query(name, f"{base}SELECT {key}, {sql_expr} AS {name} FROM {frm}")(
        lambda spark, sf: source(spark, sf).select(key, expr().alias(name))
    )


_loan_expr(
    "loan_to_income_ratio",
    "least(greatest(coalesce(loan_amount / nullif(annual_income, 0), 0e0), 0e0), 1e1)",
    lambda: L.loan_to_income(F.col("loan_amount"), F.col("annual_income")),
    dirty_loans, ctes("dirty_loans"), "dirty_loans", "k",
)


@query(
    "log_features",
    LOANS + """SELECT loan_id, round_even(ln(1 + greatest(loan_amount, 0e0)) * 1e9, 0) / 1e9 AS log_loan_amount,
    round_even(ln(1 + greatest(annual_income, 0e0)) * 1e9, 0) / 1e9 AS log_annual_income FROM loans""",
)
def _(spark, sf):
    return loans(spark, sf).select(
        "loan_id", *[N.round_half_even(L.log_floor0(F.col(c)), 9).alias(f"log_{c}") for c in S.LOG_FEATURES]
    )


BAND_SQL = (
    "CASE WHEN credit_score < 300 THEN 'nan' WHEN credit_score < 580 THEN 'Poor' WHEN credit_score < 670 THEN 'Fair' "
    "WHEN credit_score < 740 THEN 'Good' WHEN credit_score < 800 THEN 'Very_Good' "
    "WHEN credit_score < 851 THEN 'Exceptional' ELSE 'nan' END"
)
_loan_expr(
    "credit_score_band", BAND_SQL, lambda: L.score_band(F.col("credit_score")),
    dirty_loans, ctes("dirty_loans"), "dirty_loans", "k",
)
_loan_expr(
    "high_delinquency_risk", "CAST(num_delinquencies >= 2 AS INTEGER)",
    lambda: L.delinquency_flag(F.col("num_delinquencies")),
)
_loan_expr(
    "clip", "CASE WHEN annual_income IS NOT NULL THEN least(greatest(annual_income, 2e4), 1e5) END",
    lambda: N.clip(F.col("annual_income"), 20_000.0, 100_000.0),
    dirty_loans, ctes("dirty_loans"), "dirty_loans", "k",
)
_loan_expr(
    "round_half_even", "round_even(default_probability * 100, 0) / 100",
    lambda: N.round_half_even(F.col("default_probability"), 2),
)
_loan_expr(
    "to_numeric_default",
    "coalesce(TRY_CAST(CASE WHEN k % 7 = 0 THEN 'n/a' WHEN k % 11 <> 0 THEN CAST(credit_score AS VARCHAR) END AS DOUBLE), 1e4)",
    lambda: N.to_number(
        F.when(F.col("k") % 7 == 0, "n/a").when(F.col("k") % 11 != 0, F.col("credit_score").cast("string")), 10_000
    ),
)
_loan_expr(
    "format_loan_id", "'LOAN_' || CASE WHEN id < 10000000 THEN lpad(CAST(id AS VARCHAR), 7, '0') ELSE CAST(id AS VARCHAR) END",
    lambda: L.format_loan_id(F.col("id")), raw_card, CARD, "raw_card", "id",
)

STATUS = ["pay_0", "pay_2", "pay_3", "pay_4", "pay_5", "pay_6"]
PAID = [f"pay_amt{i}" for i in range(1, 7)]


@query(
    "row_count_where",
    ctes("raw_card", extra=CANONICAL)
    + "SELECT id, CAST(6 - on_time AS BIGINT) AS num_delinquencies, CAST(greatest(paid, 1) AS BIGINT) AS num_open_accounts FROM canon",
)
def _(spark, sf):
    return raw_card(spark, sf).select(
        "id", C.months_late(STATUS).alias("num_delinquencies"), C.months_paid(PAID).alias("num_open_accounts")
    )


_loan_expr(
    "derive_credit_score", "CAST(floor(300 + 550 * (on_time / 6)) AS BIGINT)",
    lambda: C.payment_score(STATUS), raw_card, CANON, "canon", "id",
)
_loan_expr(
    "employment_years", "CAST(least(greatest(age - 22, 0), 50) AS BIGINT)",
    lambda: C.employment_years(F.col("age")), raw_card, CARD, "raw_card", "id",
)
_loan_expr(
    "dti_ratio",
    "round_even(least(greatest(bill_amt1 / (round_even(inc0 * 100, 0) / 100 / 12), 0e0), 2e0) * 10000, 0) / 10000",
    lambda: C.debt_ratio(F.col("bill_amt1"), C.income_proxy(F.col("limit_bal"))), raw_card, CANON, "canon", "id",
)
_loan_expr(
    "loan_term", "CAST(CASE WHEN limit_bal > 200000 THEN 60 ELSE 36 END AS BIGINT)",
    lambda: C.loan_term(F.col("limit_bal")), raw_card, CARD, "raw_card", "id",
)
_loan_expr(
    "annual_income_proxy", "round_even(least(greatest(limit_bal * 3, 1e3), 1e7) * 100, 0) / 100",
    lambda: C.income_proxy(F.col("limit_bal")), raw_card, CARD, "raw_card", "id",
)
P = lambda: F.col("default_probability")
_loan_expr(
    "decision", "CASE WHEN default_probability >= 5e-1 THEN 'REJECT' ELSE 'APPROVE' END", lambda: L.decision(P()),
)
_loan_expr(
    "confidence",
    "CASE WHEN abs(default_probability - 5e-1) >= 3e-1 THEN 'HIGH' WHEN abs(default_probability - 5e-1) >= 15e-2 THEN 'MEDIUM' ELSE 'LOW' END",
    lambda: L.confidence(P()),
)
TIER_SQL = (
    "CASE WHEN default_probability < 2e-1 THEN 'LOW_RISK' WHEN default_probability < 45e-2 THEN 'MEDIUM_RISK' "
    "WHEN default_probability < 7e-1 THEN 'HIGH_RISK' ELSE 'VERY_HIGH_RISK' END"
)
_loan_expr("risk_tier", TIER_SQL, lambda: L.risk_tier(P()))
_loan_expr(
    "factor_direction", "CASE WHEN debt_to_income_ratio - 1 > 0 THEN 'increases_risk' ELSE 'decreases_risk' END",
    lambda: L.factor_direction(F.col("debt_to_income_ratio") - 1),
)
_loan_expr("request_id", "'req_' || substr(md5(loan_id), 1, 16)", lambda: L.request_id(F.col("loan_id")))


@query(
    "utc_timestamps",
    LOANS + """SELECT loan_id, strftime(as_of, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(as_of, '%Y%m%dT%H%M%S') AS compact,
    strftime(as_of, '%Y/%m/%d') AS date_path FROM loans""",
)
def _(spark, sf):
    ts = F.col("as_of")
    return loans(spark, sf).select(
        "loan_id", L.iso_timestamp(ts).alias("iso"), L.compact_timestamp(ts).alias("compact"), L.date_path(ts).alias("date_path")
    )


@query(
    "string_prefix",
    ctes("runs") + "SELECT 'report_' || substr(run_id, 1, 8) || '_' || substr(strftime(created, '%Y-%m-%dT%H:%M:%S'), 1, 10) AS report_name, run_id FROM runs",
)
def _(spark, sf):
    return runs(spark, sf).select(
        F.concat(
            F.lit("report_"), F.substring("run_id", 1, 8), F.lit("_"), F.substring(L.iso_timestamp(F.col("created")), 1, 10)
        ).alias("report_name"),
        "run_id",
    )


@query(
    "json_encode_report",
    ctes("runs") + "SELECT run_id, test_auc_roc AS auc_roc, model_name AS first_factor FROM runs",
)
def _(spark, sf):
    report = F.struct(
        "run_id",
        F.create_map(F.lit("auc_roc"), F.col("test_auc_roc")).alias("test_metrics"),
        F.array(F.struct(F.col("model_name").alias("feature"))).alias("top_features"),
    )
    shape = "run_id string, test_metrics map<string,double>, top_features array<struct<feature string>>"
    back = runs(spark, sf).select(F.from_json(F.to_json(report), shape).alias("r"))
    return back.select(
        "r.run_id",
        F.col("r.test_metrics")["auc_roc"].alias("auc_roc"),
        F.col("r.top_features")[0]["feature"].alias("first_factor"),
    )


_loan_expr(
    "default_fill", "coalesce(CASE WHEN k % 3 <> 0 THEN num_delinquencies END, 0)",
    lambda: F.coalesce(F.when(F.col("k") % 3 != 0, F.col("num_delinquencies")), F.lit(0).cast("long")),
)
_loan_expr(
    "sigmoid", "round_even(1 / (1 + exp(-((680 - credit_score) / 100 + num_delinquencies * 5e-1 - 2))) * 1e9, 0) / 1e9",
    lambda: N.round_half_even(N.sigmoid((680 - F.col("credit_score")) / 100 + F.col("num_delinquencies") * 0.5 - 2), 9),
)


@query(
    "promotion_reason",
    ctes("runs") + """SELECT run_id, 'Test AUC ' || printf('%.4f', test_auc_roc) || CASE WHEN test_auc_roc >= 8e-1 THEN ' ≥' ELSE ' <' END
    || ' threshold 0.8000' AS promotion_reason FROM runs""",
)
def _(spark, sf):
    return runs(spark, sf).select("run_id", L.promotion_reason(F.col("test_auc_roc"), S.PROMOTION_AUC).alias("promotion_reason"))
