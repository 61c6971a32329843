"""Loan-shaped tables derived from the star-schema tables, with matching SQL.

Each function builds a DataFrame lazily from the parquet files of one folder. The
``ctes`` helper gives the same tables as SQL common table expressions. All rules use
integer or single-step arithmetic, so that two engines agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditspark import schema as S


TABLE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A star-schema table; the declared schema saves the footer scan of inference."""
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def loans(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """One loan per order, with default flag, predicted probability and date.

    ``orders`` may be a stream of the orders table; the other tables are read as they
    are. The line counts are partitioned by order already, so the merge join only moves
    the orders, and everything after it runs on all partitions.
    """
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.expr("count(1) AS n_lines"), F.expr("count_if(l_returnflag = 'R') AS n_returned"))
    )
    joined = orders.join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey")).join(
        lines.hint("merge"), F.expr("o_orderkey = l_orderkey"), "left"
    )
    # The id names both sides of the join, so that hashing it is not repeated per line.
    number = "coalesce(o_orderkey, l_orderkey)"
    base = joined.selectExpr(
        "o_orderkey AS k",
        f"concat('LOAN_', lpad(string({number}), greatest(7, length(string({number}))), '0')) AS loan_id",
        "least(greatest(rint(o_totalprice / 5 * 100d) / 100d, 100d), 100000d) AS loan_amount",
        "least(greatest(rint((c_acctbal + 1000) * 15 * 100d) / 100d, 1000d), 10000000d) AS annual_income",
        "o_custkey % 41 AS employment_years",
        "300 + (o_orderkey * 7919 + o_custkey * 104729) % 551 AS credit_score",
        "double((o_orderkey * 31) % 200) / 100 AS debt_to_income_ratio",
        "coalesce(n_lines, 0L) AS num_open_accounts",
        "coalesce(n_returned, 0L) AS num_delinquencies",
        f"elt(int(o_orderkey % 6) + 1, {', '.join(repr(p) for p in S.LOAN_PURPOSES)}) AS loan_purpose",
        "CASE o_orderstatus WHEN 'F' THEN 'RENT' WHEN 'O' THEN 'MORTGAGE' ELSE 'OWN' END AS home_ownership",
        "CASE WHEN o_totalprice > 300000 THEN 60L ELSE 36L END AS loan_term_months",
        "o_orderdate AS as_of",
    )
    return base.selectExpr(
        "*",
        "least(greatest(double(680 - credit_score) / 1000 + num_delinquencies * 0.08d"
        " + (debt_to_income_ratio - 1) * 0.1d + 0.05d, 0.02d), 0.95d) AS pd",
    ).selectExpr(
        "*",
        "CASE WHEN double((k * 48271) % 2147483647 % 10000) / 10000 < pd THEN 1L ELSE 0L END AS loan_default",
        "rint(least(greatest(pd + (double((k * 69621) % 1000) / 1000 - 0.5d) * 0.3d, 0d), 1d) * 10000d) / 10000d"
        " AS default_probability",
    )


_LOANS = """
lines AS (
  SELECT l_orderkey, count(*) AS n_lines, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned
  FROM lineitem GROUP BY l_orderkey
),
loan_base AS (
  SELECT o_orderkey AS k, printf('LOAN_%07d', o_orderkey) AS loan_id,
    least(greatest(round_even(o_totalprice / 5 * 100, 0) / 100, 1e2), 1e5) AS loan_amount,
    least(greatest(round_even((c_acctbal + 1000) * 15 * 100, 0) / 100, 1e3), 1e7) AS annual_income,
    o_custkey % 41 AS employment_years,
    300 + (o_orderkey * 7919 + o_custkey * 104729) % 551 AS credit_score,
    CAST((o_orderkey * 31) % 200 AS DOUBLE) / 100 AS debt_to_income_ratio,
    coalesce(n_lines, 0) AS num_open_accounts,
    coalesce(n_returned, 0) AS num_delinquencies,
    CASE o_orderkey % 6 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'home_improvement'
      WHEN 2 THEN 'major_purchase' WHEN 3 THEN 'medical' WHEN 4 THEN 'vacation' ELSE 'other' END AS loan_purpose,
    CASE o_orderstatus WHEN 'F' THEN 'RENT' WHEN 'O' THEN 'MORTGAGE' ELSE 'OWN' END AS home_ownership,
    CAST(CASE WHEN o_totalprice > 300000 THEN 60 ELSE 36 END AS BIGINT) AS loan_term_months,
    o_orderdate AS as_of
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lines ON o_orderkey = l_orderkey
),
risk_rows AS (
  SELECT *, least(greatest(CAST(680 - credit_score AS DOUBLE) / 1000 + num_delinquencies * 8e-2
    + (debt_to_income_ratio - 1) * 1e-1 + 5e-2, 2e-2), 95e-2) AS pd
  FROM loan_base
),
loans AS (
  SELECT *,
    CAST(CASE WHEN CAST((k * 48271) % 2147483647 % 10000 AS DOUBLE) / 10000 < pd THEN 1 ELSE 0 END AS BIGINT) AS loan_default,
    round_even(least(greatest(pd + (CAST((k * 69621) % 1000 AS DOUBLE) / 1000 - 5e-1) * 3e-1, 0e0), 1e0) * 10000, 0) / 10000 AS default_probability
  FROM risk_rows
)"""


def raw_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card-account table: limit, person columns, six months of status, bills, payments.

    Lines beyond the sixth count in the month of their number modulo six, by the larger value.
    """
    cells = []
    for i in range(1, 7):
        cells.append(F.expr(f"max(CASE WHEN l_linenumber % 6 = {i % 6} THEN bigint(l_quantity) END) AS q{i}"))
        cells.append(F.expr(f"max(CASE WHEN l_linenumber % 6 = {i % 6} THEN l_extendedprice END) AS x{i}"))
    months = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*cells)
    base = loans(spark, sf_dir).select("k", "loan_default")
    status = ["pay_0", "pay_2", "pay_3", "pay_4", "pay_5", "pay_6"]
    return (
        table(spark, sf_dir, "orders")
        .join(months.hint("merge"), F.expr("o_orderkey = l_orderkey"), "left")
        .join(base, F.expr("o_orderkey = k"))
        .selectExpr(
            "o_orderkey AS id",
            "o_totalprice AS limit_bal",
            "o_custkey % 2 + 1 AS sex",
            "o_orderkey % 8 AS education",
            "o_custkey % 5 AS marriage",
            "20 + o_custkey % 55 AS age",
            *[f"coalesce(q{i} % 12 - 2, -2L) AS {status[i - 1]}" for i in range(1, 7)],
            *[f"coalesce(x{i}, 0d) AS bill_amt{i}" for i in range(1, 7)],
            *[f"coalesce(x{i}, 0d) AS pay_amt{i}" for i in range(1, 7)],
            "loan_default AS default_payment_next_month",
        )
    )


_RAW_CARD = (
    "months AS (SELECT l_orderkey, "
    + ", ".join(
        f"max(CASE WHEN l_linenumber % 6 = {i % 6} THEN CAST(l_quantity AS BIGINT) END) AS q{i}, "
        f"max(CASE WHEN l_linenumber % 6 = {i % 6} THEN l_extendedprice END) AS x{i}"
        for i in range(1, 7)
    )
    + " FROM lineitem GROUP BY l_orderkey),\n"
    "raw_card AS (SELECT o_orderkey AS id, o_totalprice AS limit_bal, o_custkey % 2 + 1 AS sex,"
    " o_orderkey % 8 AS education, o_custkey % 5 AS marriage, 20 + o_custkey % 55 AS age, "
    + ", ".join(
        f"coalesce(q{i} % 12 - 2, -2) AS pay_{0 if i == 1 else i}" for i in range(1, 7)
    )
    + ", "
    + ", ".join(f"coalesce(x{i}, 0e0) AS bill_amt{i}" for i in range(1, 7))
    + ", "
    + ", ".join(f"coalesce(x{i}, 0e0) AS pay_amt{i}" for i in range(1, 7))
    + ", loan_default AS default_payment_next_month FROM orders"
    " LEFT JOIN months ON o_orderkey = l_orderkey JOIN loans ON loans.k = o_orderkey)"
)


def dirty_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans with known faults: bad score, purpose, ownership, target, income, id."""
    case = F.col("k") % 50
    return loans(spark, sf_dir).select(
        "k",
        F.when(case == 5, F.concat(F.lit("X"), "loan_id")).otherwise(F.col("loan_id")).alias("loan_id"),
        "loan_amount",
        F.when(case != 4, F.col("annual_income")).alias("annual_income"),
        "employment_years",
        F.when(case == 0, F.lit(200).cast("long")).otherwise(F.col("credit_score")).alias("credit_score"),
        "debt_to_income_ratio",
        "num_open_accounts",
        "num_delinquencies",
        F.when(case == 1, "crypto").otherwise(F.col("loan_purpose")).alias("loan_purpose"),
        F.when(case == 2, "CONDO").otherwise(F.col("home_ownership")).alias("home_ownership"),
        "loan_term_months",
        F.when(case == 3, F.lit(2).cast("long")).otherwise(F.col("loan_default")).alias("loan_default"),
    )


_DIRTY = """
dirty_loans AS (
  SELECT k, CASE WHEN k % 50 = 5 THEN 'X' || loan_id ELSE loan_id END AS loan_id, loan_amount,
    CASE WHEN k % 50 <> 4 THEN annual_income END AS annual_income, employment_years,
    CASE WHEN k % 50 = 0 THEN 200 ELSE credit_score END AS credit_score, debt_to_income_ratio,
    num_open_accounts, num_delinquencies,
    CASE WHEN k % 50 = 1 THEN 'crypto' ELSE loan_purpose END AS loan_purpose,
    CASE WHEN k % 50 = 2 THEN 'CONDO' ELSE home_ownership END AS home_ownership, loan_term_months,
    CASE WHEN k % 50 = 3 THEN 2 ELSE loan_default END AS loan_default
  FROM loans
)"""


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One logged prediction per loan; a quarter already carries its label."""
    return loans(spark, sf_dir).select(
        "loan_id",
        "default_probability",
        F.concat(F.lit("v"), (F.col("k") % 3 + 1).cast("string")).alias("model_version"),
        F.concat(F.lit("req_"), F.substring(F.md5("loan_id"), 1, 16)).alias("request_id"),
        F.col("as_of").alias("ts"),
        F.when(F.col("k") % 4 == 0, F.col("loan_default").cast("int")).alias("actual_default"),
    )


_LOG = """
prediction_log AS (
  SELECT loan_id, default_probability, 'v' || (k % 3 + 1) AS model_version,
    'req_' || substr(md5(loan_id), 1, 16) AS request_id, as_of AS ts,
    CASE WHEN k % 4 = 0 THEN CAST(loan_default AS INTEGER) END AS actual_default
  FROM loans
)"""


def labels_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delayed labels, 30 to 119 days after the loan; every tenth id arrives twice."""
    base = loans(spark, sf_dir).select("k", "loan_id", "loan_default", "as_of")
    copies = F.when(F.col("k") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.withColumn("copy", F.explode(copies)).select(
        "loan_id",
        F.when(F.col("copy") == 1, 1 - F.col("loan_default")).otherwise(F.col("loan_default")).alias("loan_default"),
        (
            F.col("as_of")
            + F.make_dt_interval((F.lit(30) + F.col("k") % 90 - F.col("copy")).cast("int"))
        ).alias("label_ts"),
    )


_LABELS = """
labels_feed AS (
  SELECT loan_id, CASE WHEN dup = 1 THEN 1 - loan_default ELSE loan_default END AS loan_default,
    as_of + to_days(CAST(30 + k % 90 - dup AS INTEGER)) AS label_ts
  FROM loans, (VALUES (0), (1)) AS copies(dup)
  WHERE dup = 0 OR k % 10 = 0
)"""


def reference_current(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Baseline loans and a later window with shifted scores."""
    base = loans(spark, sf_dir)
    ref = base.filter(F.col("as_of") < F.lit("2000-01-01").cast("timestamp_ntz"))
    cur = base.filter(F.col("as_of") >= F.lit("2000-01-01").cast("timestamp_ntz")).withColumn("credit_score", F.greatest(F.col("credit_score") - 60, F.lit(300).cast("long")))
    return ref, cur


_REF_CUR = """
reference_loans AS (SELECT * FROM loans WHERE as_of < TIMESTAMP '2000-01-01'),
current_loans AS (
  SELECT * REPLACE (greatest(credit_score - 60, 300) AS credit_score) FROM loans
  WHERE as_of >= TIMESTAMP '2000-01-01'
)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One experiment run per part, with model name, metrics and creation time."""
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.format_string("run_%08d", p).alias("run_id"),
        F.when(p % 2 == 0, "gbt_depth5").otherwise("gbt_depth6").alias("model_name"),
        ((p * 37 % 400).cast("double") / 1000 + 0.6).alias("test_auc_roc"),
        ((p * 53 % 400).cast("double") / 1000 + 0.6).alias("val_auc_roc"),
        ((p * 41 % 500).cast("double") / 1000 + 0.2).alias("test_ks_statistic"),
        (((p * 37 % 400).cast("double") / 1000 + 0.6) * 2 - 1).alias("test_gini"),
        F.col("p_size").cast("long").alias("max_depth"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=p.cast("int"))).alias("created"),
    )


_RUNS = """
runs AS (
  SELECT printf('run_%08d', p_partkey) AS run_id,
    CASE WHEN p_partkey % 2 = 0 THEN 'gbt_depth5' ELSE 'gbt_depth6' END AS model_name,
    CAST(p_partkey * 37 % 400 AS DOUBLE) / 1000 + 6e-1 AS test_auc_roc,
    CAST(p_partkey * 53 % 400 AS DOUBLE) / 1000 + 6e-1 AS val_auc_roc,
    CAST(p_partkey * 41 % 500 AS DOUBLE) / 1000 + 2e-1 AS test_ks_statistic,
    (CAST(p_partkey * 37 % 400 AS DOUBLE) / 1000 + 6e-1) * 2 - 1 AS test_gini,
    CAST(p_size AS BIGINT) AS max_depth,
    TIMESTAMP '2024-01-01' + to_minutes(p_partkey) AS created
  FROM part
)"""

CONTRIBUTION_WEIGHTS = {
    "credit_score": -3,
    "num_delinquencies": 40,
    "debt_to_income_ratio": 25,
    "employment_years": -2,
    "num_open_accounts": 5,
    "loan_term_months": 1,
}
_CENTERS = {
    "credit_score": 575,
    "num_delinquencies": 1,
    "debt_to_income_ratio": 1,
    "employment_years": 20,
    "num_open_accounts": 4,
    "loan_term_months": 40,
}


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long table (loan_id, feature, value) of additive per-loan contributions."""
    base = loans(spark, sf_dir)
    parts = [
        (F.col(c) - _CENTERS[c]).cast("double") * float(w) for c, w in CONTRIBUTION_WEIGHTS.items()
    ]
    wide = base.select("loan_id", *[p.alias(c) for p, c in zip(parts, CONTRIBUTION_WEIGHTS)])
    return wide.unpivot("loan_id", list(CONTRIBUTION_WEIGHTS), "feature", "value")


_CONTRIBUTIONS = "contributions AS (" + " UNION ALL ".join(
    f"SELECT loan_id, '{c}' AS feature, CAST({c} - {_CENTERS[c]} AS DOUBLE) * {w} AS value FROM loans"
    for c, w in CONTRIBUTION_WEIGHTS.items()
) + ")"


def metric_events(events: DataFrame) -> DataFrame:
    """Serving events: time, latency, probability, decision, tier, error flag."""
    p = F.least(F.col("value") / 500, F.lit(1.0))
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        F.col("value").alias("latency_ms"),
        p.alias("probability"),
        F.when(p >= 0.5, "REJECT").otherwise("APPROVE").alias("decision"),
        F.when(p < 0.20, "LOW_RISK")
        .when(p < 0.45, "MEDIUM_RISK")
        .when(p < 0.70, "HIGH_RISK")
        .otherwise("VERY_HIGH_RISK")
        .alias("risk_tier"),
        (F.col("event_type") == "error").alias("is_error"),
    )


_EVENTS = """
metric_events AS (
  SELECT event_id, ts, user_id, event_type, value AS latency_ms, least(value / 500, 1e0) AS probability,
    CASE WHEN least(value / 500, 1e0) >= 5e-1 THEN 'REJECT' ELSE 'APPROVE' END AS decision,
    CASE WHEN least(value / 500, 1e0) < 2e-1 THEN 'LOW_RISK' WHEN least(value / 500, 1e0) < 45e-2 THEN 'MEDIUM_RISK'
      WHEN least(value / 500, 1e0) < 7e-1 THEN 'HIGH_RISK' ELSE 'VERY_HIGH_RISK' END AS risk_tier,
    event_type = 'error' AS is_error
  FROM events
)"""

_CTES = {
    "loans": ((), _LOANS),
    "raw_card": (("loans",), _RAW_CARD),
    "dirty_loans": (("loans",), _DIRTY),
    "prediction_log": (("loans",), _LOG),
    "labels_feed": (("loans",), _LABELS),
    "ref_cur": (("loans",), _REF_CUR),
    "runs": ((), _RUNS),
    "contributions": (("loans",), _CONTRIBUTIONS),
    "metric_events": ((), _EVENTS),
}


def ctes(*names: str, extra: str = "") -> str:
    """``WITH`` clause holding the named fixture tables and their inputs."""
    done: list[str] = []

    def add(name: str) -> None:
        for need in _CTES[name][0]:
            add(need)
        if name not in done:
            done.append(name)

    for n in names:
        add(n)
    parts = [_CTES[n][1].strip() for n in done]
    if extra:
        parts.append(extra.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n"
