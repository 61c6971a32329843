"""Reading and writing tables, logs and reports, with read-back."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditspark import schema as S
from creditspark.functions.loan import iso_timestamp
from creditspark.operators import runs as RU, split as SP
from creditspark.plans.fixtures import ctes, loans, prediction_log, runs, table
from creditspark.plans.q_metrics import r6
from creditspark.plans.q_monitor import EVALUATION, report, summary
from creditspark.plans.q_quality import SPLITS
from creditspark.plans.registry import query
from creditspark.session import fresh_dir
from creditspark.sources import generate as G, reports as RP, tables as TB

LOANS = ctes("loans")
CANON_COLS = ", ".join(S.CANONICAL_COLUMNS)


def canonical(spark, sf):
    return loans(spark, sf).select(*S.CANONICAL_COLUMNS)


@query("scan_csv", LOANS + f"SELECT {CANON_COLS} FROM loans")
def _(spark, sf):
    path = fresh_dir(spark, "loans") + ".csv"
    TB.write_csv(canonical(spark, sf), path)
    return TB.scan_csv(spark, path, S.LOAN_SCHEMA)


@query("scan_csv_reordered", LOANS + f"SELECT {CANON_COLS} FROM loans")
def _(spark, sf):
    """The file has the columns backwards and two more; they are found by name."""
    path = fresh_dir(spark, "loans") + ".csv"
    backwards = [F.lit("x").alias("note"), *reversed(S.CANONICAL_COLUMNS), F.col("loan_default").alias("seen")]
    TB.write_csv(canonical(spark, sf).select(*backwards), path)
    return TB.scan_csv(spark, path, S.LOAN_SCHEMA)


@query("scan_csv_inferred", LOANS + "SELECT loan_id, loan_amount, CAST(credit_score AS INTEGER) AS credit_score, loan_purpose FROM loans")
def _(spark, sf):
    path = fresh_dir(spark, "loans") + ".csv"
    TB.write_csv(canonical(spark, sf), path)
    return TB.scan_csv(spark, path, sampling=1.0).select("loan_id", "loan_amount", "credit_score", "loan_purpose")


@query("scan_parquet", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def _(spark, sf):
    df = TB.scan_parquet(spark, f"{sf}/orders.parquet")
    return df.filter(F.col("o_totalprice") > 300_000).select("o_orderkey", "o_totalprice")


_GUARDED = ["customer", "orders", "lineitem", "part", "events"]


@query(
    "scan_dispatch_guard",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _GUARDED),
)
def _(spark, sf):
    counts = [
        TB.scan(spark, f"{sf}/{t}.parquet").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        for t in _GUARDED
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query(
    "scan_glob",
    "SELECT c_custkey, c_acctbal, NULL::BIGINT AS s_suppkey FROM customer UNION ALL SELECT NULL, NULL, s_suppkey FROM supplier",
)
def _(spark, sf):
    return TB.scan_glob(spark, sf, "{customer,supplier}.parquet").select("c_custkey", "c_acctbal", "s_suppkey")


@query("scan_splits", SPLITS + "SELECT loan_id, loan_default FROM split_loans WHERE split = 'val'")
def _(spark, sf):
    path = fresh_dir(spark, "splits")
    TB.write_splits(SP.hash_split(canonical(spark, sf)), path)
    return TB.read_split(spark, path, "val").select("loan_id", "loan_default")


@query("sink_parquet", LOANS + f"SELECT {CANON_COLS} FROM loans")
def _(spark, sf):
    path = fresh_dir(spark, "canonical")
    TB.write_parquet(canonical(spark, sf), path)
    return TB.scan_parquet(spark, path)


@query("sink_csv", LOANS + "SELECT loan_id, loan_amount, loan_default FROM loans ORDER BY loan_id LIMIT 200")
def _(spark, sf):
    path = fresh_dir(spark, "sample") + ".csv"
    TB.write_sample_csv(canonical(spark, sf), path)
    return TB.scan_csv(spark, path, S.LOAN_SCHEMA).select("loan_id", "loan_amount", "loan_default")


@query("sink_log_append", ctes("prediction_log") + "SELECT *, CAST(date_trunc('month', ts) AS DATE) AS dt FROM prediction_log")
def _(spark, sf):
    path = fresh_dir(spark, "log")
    log = prediction_log(spark, sf)
    first = F.col("model_version") == "v1"
    for part in (log.filter(first), log.filter(~first)):
        TB.append_predictions(part, path, period="month")
    return TB.read_predictions(spark, path)


@query(
    "prediction_log_month",
    ctes("prediction_log") + "SELECT loan_id, model_version FROM prediction_log WHERE CAST(ts AS DATE) BETWEEN DATE '1999-03-01' AND DATE '1999-03-31'",
)
def _(spark, sf):
    path = fresh_dir(spark, "log")
    TB.append_predictions(prediction_log(spark, sf), path, period="month")
    month = F.lit("1999-03-01").cast("date")
    return TB.read_predictions(spark, path).filter(F.col("dt") == month).select("loan_id", "model_version")


@query("sink_json_report", EVALUATION)
def _(spark, sf):
    """The report written and read back: the fields that evaluation_report gives."""
    path = fresh_dir(spark, "reports")
    rows = report(spark, sf)
    RP.save_reports(rows, path)
    return summary(RP.load_reports(spark, path, rows.schema))


@query(
    "scan_json_report",
    ctes("runs") + """SELECT run_id, 'report_' || substr(run_id, 1, 8) || '_' || strftime(created, '%Y-%m-%d') AS report,
    test_auc_roc AS test_auc, val_auc_roc AS val_auc, test_auc_roc >= 8e-1 AS promoted FROM runs""",
)
def _(spark, sf):
    path = fresh_dir(spark, "run-reports")
    nested = RU.promotion_gate(runs(spark, sf)).select(
        "run_id",
        "model_name",
        iso_timestamp(F.col("created")).alias("timestamp"),
        F.create_map(F.lit("auc_roc"), "val_auc_roc").alias("val_metrics"),
        F.create_map(F.lit("auc_roc"), "test_auc_roc").alias("test_metrics"),
        "promoted",
    )
    RP.save_reports(nested, path)
    return RP.load_reports(spark, path, nested.schema).select(
        "run_id",
        "report",
        F.col("test_metrics")["auc_roc"].alias("test_auc"),
        F.col("val_metrics")["auc_roc"].alias("val_auc"),
        "promoted",
    )


@query(
    "sink_metrics_json",
    LOANS + f"SELECT count(*) AS n_rows, {r6('avg(loan_default)')} AS default_rate FROM loans",
)
def _(spark, sf):
    path = fresh_dir(spark, "metrics")
    flat = canonical(spark, sf).agg(
        F.count(F.lit(1)).alias("n_rows"), (F.rint(F.avg("loan_default") * 1e6) / 1e6).alias("default_rate")
    )
    RP.save_metrics(flat, path)
    return spark.read.schema(flat.schema).json(path)


_U = [f"(('0x' || substr(d{b}, {1 + 8 * i}, 8))::BIGINT + 5e-1) / 4294967296e0 AS u{4 * b + i}" for b in range(6) for i in range(4)]
GENERATED = f"""
dig AS (SELECT o_orderkey AS k, {', '.join(f"md5('42:{b}:' || o_orderkey) AS d{b}" for b in range(6))} FROM orders),
dr AS (SELECT k, {', '.join(_U)} FROM dig),
gb AS (SELECT k, least(greatest(exp(95e-1 + 6e-1 * (sqrt(-2e0 * ln(u0)) * cos(6.283185307179586e0 * u1))), 1e3), 4e4) AS amount,
  least(greatest(exp(109e-1 + 5e-1 * (sqrt(-2e0 * ln(u2)) * cos(6.283185307179586e0 * u3))), 15e3), 3e5) AS income,
  CAST(floor(u4 * 31) AS BIGINT) AS employment_years,
  CAST(floor(least(greatest(68e1 + 8e1 * (sqrt(-2e0 * ln(u5)) * cos(6.283185307179586e0 * u6)), 3e2), 85e1)) AS BIGINT) AS credit_score,
  least(greatest(list_sort([u8, u9, u10, u11, u12, u13])[2], 1e-2), 99e-2) AS dti,
  CAST(floor(u7 * 19) AS BIGINT) + 1 AS num_open_accounts,
  CAST(least(greatest(floor(ln(u14) / ln(CAST({1 - 0.7!r} AS DOUBLE))), 0), 10) AS BIGINT) AS num_delinquencies,
  CASE WHEN u15 < 45e-2 THEN 'debt_consolidation' WHEN u15 < 65e-2 THEN 'home_improvement' WHEN u15 < 8e-1 THEN 'major_purchase'
    WHEN u15 < 88e-2 THEN 'medical' WHEN u15 < 93e-2 THEN 'vacation' ELSE 'other' END AS loan_purpose,
  CASE WHEN u16 < 45e-2 THEN 'RENT' WHEN u16 < 85e-2 THEN 'MORTGAGE' ELSE 'OWN' END AS home_ownership,
  CAST(CASE WHEN u17 < 6e-1 THEN 36 ELSE 60 END AS BIGINT) AS loan_term_months,
  (sqrt(-2e0 * ln(u18)) * cos(6.283185307179586e0 * u19)) * 5e-1 AS noise, u20 AS draw FROM dr)"""


@query(
    "generate_loans",
    "WITH " + GENERATED.strip() + """
    SELECT printf('LOAN_%07d', k) AS loan_id, round_even(amount * 100, 0) / 100 AS loan_amount, round_even(income * 100, 0) / 100 AS annual_income,
    employment_years, credit_score, round_even(dti * 10000, 0) / 10000 AS debt_to_income_ratio, num_open_accounts, num_delinquencies,
    loan_purpose, home_ownership, loan_term_months,
    CAST(draw < 1 / (1 + exp(-(-35e-1 + (dti - 3e-1) * 8e-1 + (credit_score - 680) * -8e-3 + num_delinquencies * 5e-1 + employment_years * -3e-2
      + (amount / income - 3e-1) * 2e-1 + noise))) AS BIGINT) AS loan_default FROM gb""",
)
def _(spark, sf):
    return G.generate_loans(table(spark, sf, "orders"), "o_orderkey")
