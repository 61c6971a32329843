"""Canonical loan table: columns, value rules, feature lists and thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Names, bounds, categories and thresholds below are part of the data contract.

ID_COLUMN = "loan_id"
TARGET_COLUMN = "loan_default"

NUMERIC_FEATURES = [
    "loan_amount",
    "annual_income",
    "employment_years",
    "credit_score",
    "debt_to_income_ratio",
    "num_open_accounts",
    "num_delinquencies",
    "loan_term_months",
]
CATEGORICAL_FEATURES = ["loan_purpose", "home_ownership"]
ENGINEERED_FEATURES = [
    "loan_to_income_ratio",
    "log_loan_amount",
    "log_annual_income",
    "credit_score_band",
]
LOG_FEATURES = ["loan_amount", "annual_income"]

SCORE_BAND_EDGES = [300, 580, 670, 740, 800, 851]
SCORE_BAND_LABELS = ["Poor", "Fair", "Good", "Very_Good", "Exceptional"]

LOAN_PURPOSES = [
    "debt_consolidation",
    "home_improvement",
    "major_purchase",
    "medical",
    "vacation",
    "other",
]
HOME_OWNERSHIP = ["RENT", "MORTGAGE", "OWN"]
LOAN_TERMS = [36, 60]

AUDIT_COLUMNS = ["loan_purpose", "home_ownership", "loan_term_months"]

FEATURE_GROUPS = {
    "creditworthiness": ["credit_score", "num_delinquencies", "credit_score_band"],
    "income_capacity": ["annual_income", "log_annual_income", "employment_years"],
    "loan_characteristics": [
        "loan_amount",
        "log_loan_amount",
        "loan_to_income_ratio",
        "loan_term_months",
    ],
    "debt_burden": ["debt_to_income_ratio", "num_open_accounts"],
    "demographics": ["loan_purpose", "home_ownership"],
}

EDUCATION_TO_PURPOSE = {
    "1": "home_improvement",
    "2": "debt_consolidation",
    "3": "major_purchase",
    "4": "other",
    "5": "vacation",
    "6": "medical",
    "0": "other",
}
MARRIAGE_TO_OWNERSHIP = {"1": "MORTGAGE", "2": "RENT", "3": "OWN", "0": "RENT"}

CARD_RENAMES = {
    "ID": "loan_id",
    "LIMIT_BAL": "credit_limit",
    "SEX": "sex",
    "EDUCATION": "education_level",
    "MARRIAGE": "marital_status",
    "AGE": "age",
    "PAY_0": "payment_status_1",
    "PAY_2": "payment_status_2",
    "PAY_3": "payment_status_3",
    "PAY_4": "payment_status_4",
    "PAY_5": "payment_status_5",
    "PAY_6": "payment_status_6",
    "BILL_AMT1": "bill_amount_1",
    "BILL_AMT2": "bill_amount_2",
    "BILL_AMT3": "bill_amount_3",
    "BILL_AMT4": "bill_amount_4",
    "BILL_AMT5": "bill_amount_5",
    "BILL_AMT6": "bill_amount_6",
    "PAY_AMT1": "pay_amount_1",
    "PAY_AMT2": "pay_amount_2",
    "PAY_AMT3": "pay_amount_3",
    "PAY_AMT4": "pay_amount_4",
    "PAY_AMT5": "pay_amount_5",
    "PAY_AMT6": "pay_amount_6",
    "default.payment.next.month": "loan_default",
}

PSI_THRESHOLD = 0.15
LIVE_AUC_THRESHOLD = 0.75
PROMOTION_AUC = 0.80
MIN_LABELED = 100
MIN_SLICE_ROWS = 20
FOUR_FIFTHS = 0.80

# metric, warning, critical; "above" breaches when the value is larger
THRESHOLD_LEVELS = [
    ("psi", "above", 0.10, 0.20),
    ("ks_pvalue", "below", 0.10, 0.05),
    ("auc_roc", "below", 0.78, 0.72),
    ("f1", "below", 0.60, 0.50),
]
MAX_PREDICTION_SHIFT = 0.15
MAX_NULL_RATE = 0.05
MAX_OUTLIER_RATE = 0.10
MIN_ROWS_FOR_RETRAIN = 1000
RETRAIN_COOLDOWN_HOURS = 24
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class ColumnRule:
    """Declared type and value constraint of one column (null never passes)."""

    column: str
    dtype: T.DataType
    low: float | None = None
    high: float | None = None
    allowed: tuple = ()
    pattern: str | None = None


INFERENCE_RULES = [
    ColumnRule("loan_amount", T.DoubleType(), 100.0, 100_000.0),
    ColumnRule("annual_income", T.DoubleType(), 1_000.0, 10_000_000.0),
    ColumnRule("employment_years", T.LongType(), 0, 50),
    ColumnRule("credit_score", T.LongType(), 300, 850),
    ColumnRule("debt_to_income_ratio", T.DoubleType(), 0.0, 2.0),
    ColumnRule("num_open_accounts", T.LongType(), 0, 100),
    ColumnRule("num_delinquencies", T.LongType(), 0, 50),
    ColumnRule("loan_purpose", T.StringType(), allowed=tuple(LOAN_PURPOSES)),
    ColumnRule("home_ownership", T.StringType(), allowed=tuple(HOME_OWNERSHIP)),
    ColumnRule("loan_term_months", T.LongType(), allowed=tuple(LOAN_TERMS)),
]
RAW_RULES = [
    ColumnRule("loan_id", T.StringType(), pattern=r"^LOAN_\d+$"),
    *INFERENCE_RULES,
    ColumnRule("loan_default", T.LongType(), allowed=(0, 1)),
]

LOAN_SCHEMA = T.StructType([T.StructField(r.column, r.dtype) for r in RAW_RULES])
CANONICAL_COLUMNS = LOAN_SCHEMA.fieldNames()

PREDICTION_LOG_SCHEMA = T.StructType(
    [
        T.StructField("loan_id", T.StringType()),
        T.StructField("default_probability", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("actual_default", T.IntegerType()),
    ]
)
