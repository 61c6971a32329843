"""Rule checks, repair, splits and table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditspark import schema as S
from creditspark.operators import profile as P, quality as Q, split as SP
from creditspark.plans.fixtures import ctes, dirty_loans, loans, raw_card
from creditspark.operators.canonical import canonicalize
from creditspark.plans.registry import query
from creditspark.plans.q_scalars import CANON

DIRTY = ctes("dirty_loans")
LOANS = ctes("loans")

_BAD = {
    "loan_id": "NOT regexp_matches(loan_id, '^LOAN_\\d+$')",
    "loan_amount": "loan_amount IS NULL OR loan_amount NOT BETWEEN 100 AND 100000",
    "annual_income": "annual_income IS NULL OR annual_income NOT BETWEEN 1000 AND 10000000",
    "employment_years": "employment_years NOT BETWEEN 0 AND 50",
    "credit_score": "credit_score NOT BETWEEN 300 AND 850",
    "debt_to_income_ratio": "debt_to_income_ratio NOT BETWEEN 0 AND 2",
    "num_open_accounts": "num_open_accounts NOT BETWEEN 0 AND 100",
    "num_delinquencies": "num_delinquencies NOT BETWEEN 0 AND 50",
    "loan_purpose": "loan_purpose NOT IN ('debt_consolidation','home_improvement','major_purchase','medical','vacation','other')",
    "home_ownership": "home_ownership NOT IN ('RENT','MORTGAGE','OWN')",
    "loan_term_months": "loan_term_months NOT IN (36, 60)",
    "loan_default": "loan_default NOT IN (0, 1)",
}


def _counts_sql(rules, table="dirty_loans"):
    return " UNION ALL ".join(
        f"SELECT '{r.column}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {_BAD[r.column]}) AS n_violations FROM {table}"
        for r in rules
    )


def _verdict(before: str, after: str) -> str:
    """CTE ``verdict``: the rules' outcome on a table and, where it fails, on its repaired form."""
    failed = lambda t: "concat_ws(',', " + ", ".join(
        f"CASE WHEN (SELECT count(*) FROM {t} WHERE {bad}) > 0 THEN '{c}' END" for c, bad in _BAD.items()
    ) + ")"
    return f"""found AS (SELECT {failed(before)} AS e, {failed(after)} AS f),
verdict AS (SELECT CASE WHEN e = '' THEN 'PASSED' WHEN f = '' THEN 'PASSED_AFTER_FIX' ELSE 'FAILED' END AS status,
  (SELECT count(*) FROM {before}) AS n_rows, {len(_BAD)}::BIGINT AS n_columns,
  (SELECT round_even(avg(loan_default) * 1e9, 0) / 1e9 FROM {before}) AS default_rate,
  e AS validation_errors, CASE WHEN e = '' THEN '' ELSE f END AS errors_after_fix FROM found)
"""


@query("validate_raw", DIRTY + _counts_sql(S.RAW_RULES))
def _(spark, sf):
    return Q.rule_counts(dirty_loans(spark, sf))


@query("validate_inference", DIRTY + _counts_sql(S.INFERENCE_RULES))
def _(spark, sf):
    return Q.rule_counts(dirty_loans(spark, sf).drop("loan_id", "loan_default"), S.INFERENCE_RULES)


@query(
    "coerce_types",
    LOANS + """SELECT 'credit_score' AS column_name, count(*) FILTER (WHERE k % 13 = 0) AS n_uncastable FROM loans
    UNION ALL SELECT 'annual_income', count(*) FILTER (WHERE k % 17 = 0) FROM loans
    UNION ALL SELECT 'loan_default', 0 FROM (SELECT count(*) FROM loans)""",
)
def _(spark, sf):
    text = loans(spark, sf).select(
        F.when(F.col("k") % 13 == 0, "unknown").otherwise(F.col("credit_score").cast("string")).alias("credit_score"),
        F.when(F.col("k") % 17 == 0, "12,000").otherwise(F.col("annual_income").cast("string")).alias("annual_income"),
        F.col("loan_default").cast("string").alias("loan_default"),
    )
    return Q.coercion_failures(text)


@query(
    "violation_rows",
    DIRTY + "SELECT * FROM (SELECT loan_id, concat_ws(',', "
    + ", ".join(f"CASE WHEN {bad} THEN '{c}' END" for c, bad in _BAD.items())
    + ") AS failed FROM dirty_loans) WHERE failed <> ''",
)
def _(spark, sf):
    return Q.violation_rows(dirty_loans(spark, sf)).withColumn("failed", F.array_join("failed", ","))


@query(
    "autofix_revalidate",
    ctes("loans", extra="shifted AS (SELECT * REPLACE (CASE WHEN k % 50 = 0 THEN 200 ELSE credit_score END AS credit_score) FROM loans), "
    "repaired AS (SELECT * REPLACE (least(greatest(credit_score, 300), 850) AS credit_score) FROM shifted), "
    + _verdict("shifted", "repaired"))
    + "SELECT status, n_rows, n_columns, CASE WHEN status = 'PASSED' THEN default_rate END AS default_rate, validation_errors, errors_after_fix FROM verdict",
)
def _(spark, sf):
    df = loans(spark, sf).select("k", *S.CANONICAL_COLUMNS)
    shifted = F.when(F.col("k") % 50 == 0, F.lit(200).cast("long")).otherwise(F.col("credit_score"))
    return Q.validation_report(df.withColumn("credit_score", shifted).drop("k"))


@query(
    "validation_report",
    CANON.rstrip() + ",\n" + _verdict("canonical", "canonical")
    + "SELECT status, n_rows, n_columns, default_rate, validation_errors, errors_after_fix FROM verdict",
)
def _(spark, sf):
    report = Q.validation_report(canonicalize(raw_card(spark, sf)))
    return report.withColumn("default_rate", F.rint(F.col("default_rate") * 1e9) / 1e9)


SPLIT = f"""
hashed AS (SELECT *, ('0x' || substr(md5('42:' || loan_id), 1, 15))::BIGINT AS h FROM loans),
split_loans AS (
  SELECT * EXCLUDE (h), CASE WHEN h < {int(0.2 * 2**60)} THEN 'test' WHEN h < {int((0.2 + 0.1) * 2**60)} THEN 'val' ELSE 'train' END AS split
  FROM hashed
)"""
SPLITS = ctes("loans", extra=SPLIT)


@query("hash_split", SPLITS + "SELECT loan_id, loan_default, split FROM split_loans")
def _(spark, sf):
    return SP.hash_split(loans(spark, sf)).select("loan_id", "loan_default", "split")


EXACT = """
hashed AS (SELECT *, ('0x' || substr(md5('42:' || loan_id), 1, 15))::BIGINT AS h FROM loans),
sizes AS (SELECT loan_default, count(*) AS n, sum(count(*)) OVER () AS total FROM hashed GROUP BY 1),
t1 AS (SELECT *, ceil(total * 2e-1) * n / total AS share, ceil(total * 2e-1) AS draws FROM sizes),
t2 AS (SELECT *, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, loan_default)
    <= draws - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS n_test FROM t1),
v1 AS (SELECT *, sum(n - n_test) OVER () AS rest FROM t2),
v2 AS (SELECT *, ceil(rest * 125e-3) AS vdraws, ceil(rest * 125e-3) * (n - n_test) / rest AS vshare FROM v1),
quotas AS (SELECT loan_default, n, n_test, floor(vshare) + CASE WHEN row_number() OVER (ORDER BY vshare - floor(vshare) DESC, loan_default)
    <= vdraws - sum(floor(vshare)) OVER () THEN 1 ELSE 0 END AS n_val FROM v2),
ranked AS (SELECT loan_id, loan_default, row_number() OVER (PARTITION BY loan_default ORDER BY h, loan_id) AS rn FROM hashed)"""


_EXACT_ROWS = """SELECT loan_id, loan_default,
    CASE WHEN rn <= n_test THEN 'test' WHEN rn <= n_test + n_val THEN 'val' ELSE 'train' END AS split
    FROM ranked JOIN quotas USING (loan_default)"""


@query("stratified_split", ctes("loans", extra=EXACT) + _EXACT_ROWS)
def _(spark, sf):
    return SP.exact_stratified_split(loans(spark, sf)).select("loan_id", "loan_default", "split")


@query(
    "stratified_split_exact",
    (ctes("loans", extra="§") + _EXACT_ROWS).replace("§", EXACT.strip().replace("loan_default", "loan_purpose")).replace(_EXACT_ROWS, _EXACT_ROWS.replace("loan_default", "loan_purpose")),
)
def _(spark, sf):
    """By purpose: six classes in place of two."""
    return SP.exact_stratified_split(loans(spark, sf), target="loan_purpose").select("loan_id", "loan_purpose", "split")


@query(
    "split_summary",
    SPLITS + """SELECT split, count(*) AS n_rows, CAST(sum(loan_default) AS BIGINT) AS n_defaults,
    round_even(avg(loan_default) * 1e9, 0) / 1e9 AS default_rate FROM split_loans GROUP BY split""",
)
def _(spark, sf):
    out = SP.split_summary(SP.hash_split(loans(spark, sf)))
    return out.withColumn("default_rate", F.rint(F.col("default_rate") * 1e9) / 1e9)


# Two splits of the same loans by different seeds, stacked: ids the seeds place differently overlap.
SEEDS = SPLIT + f""",
hashed7 AS (SELECT *, ('0x' || substr(md5('7:' || loan_id), 1, 15))::BIGINT AS h FROM loans),
stacked AS (SELECT loan_id, split FROM split_loans UNION ALL
  SELECT loan_id, CASE WHEN h < {int(0.2 * 2**60)} THEN 'test' WHEN h < {int((0.2 + 0.1) * 2**60)} THEN 'val' ELSE 'train' END FROM hashed7)"""


def stacked_splits(spark, sf):
    base = loans(spark, sf)
    return SP.hash_split(base).unionByName(SP.hash_split(base, seed=7))


@query(
    "split_overlap",
    ctes("loans", extra=SEEDS) + """SELECT loan_id, min(split) AS first_split, max(split) AS last_split FROM stacked
    GROUP BY loan_id HAVING min(split) <> max(split)""",
)
def _(spark, sf):
    return SP.split_overlap(stacked_splits(spark, sf))


@query(
    "split_intersection",
    ctes("loans", extra=SEEDS) + "SELECT loan_id FROM stacked WHERE split = 'train' INTERSECT SELECT loan_id FROM stacked WHERE split = 'test'",
)
def _(spark, sf):
    return SP.split_intersection(stacked_splits(spark, sf), "train", "test")


@query(
    "split_cover",
    SPLITS + """SELECT loan_id, 'missing' AS side FROM (SELECT loan_id FROM loans EXCEPT ALL SELECT loan_id FROM split_loans WHERE split <> 'val')
    UNION ALL SELECT loan_id, 'extra' FROM (SELECT loan_id FROM split_loans WHERE split <> 'val' EXCEPT ALL SELECT loan_id FROM loans)""",
)
def _(spark, sf):
    base = loans(spark, sf)
    return SP.split_cover(base, SP.hash_split(base).filter(F.col("split") != "val"))


@query(
    "default_rate_by_band",
    LOANS + """SELECT CASE WHEN credit_score < 580 THEN 'Poor' WHEN credit_score < 670 THEN 'Fair' WHEN credit_score < 740 THEN 'Good'
      WHEN credit_score < 800 THEN 'Very_Good' ELSE 'Exceptional' END AS credit_band,
    round_even(avg(loan_default) * 1e9, 0) / 1e9 AS default_rate, count(*) AS count FROM loans GROUP BY 1""",
)
def _(spark, sf):
    out = P.default_rate_by_band(loans(spark, sf))
    return out.withColumn("default_rate", F.rint(F.col("default_rate") * 1e9) / 1e9)


@query(
    "table_profile",
    LOANS + "SELECT count(*) AS n_rows, 12::BIGINT AS n_columns, round_even(avg(loan_default) * 1e9, 0) / 1e9 AS default_rate FROM loans",
)
def _(spark, sf):
    out = P.table_profile(loans(spark, sf).select(*S.CANONICAL_COLUMNS))
    return out.withColumn("default_rate", F.rint(F.col("default_rate") * 1e9) / 1e9)


CORR = ["loan_amount", "annual_income", "credit_score", "debt_to_income_ratio", "num_delinquencies"]
_CORR_SQL = LOANS + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round_even(corr({c}, loan_default) * 1e6, 0) / 1e6 AS correlation FROM loans" for c in CORR
)


def _correlations(spark, sf):
    out = P.target_correlations(loans(spark, sf), CORR)
    return out.withColumn("correlation", F.rint(F.col("correlation") * 1e6) / 1e6)


query("feature_target_corr", _CORR_SQL)(_correlations)
query("sort_correlations", _CORR_SQL + " ORDER BY 2")(_correlations)

HIST = ["loan_amount", "annual_income", "credit_score", "debt_to_income_ratio", "employment_years", "num_delinquencies"]
_HIST_EXTRA = (
    "long AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM loans" for c in HIST)
    + """),
r AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM long GROUP BY 1),
grid AS (SELECT feature, lo, hi, CAST(bin AS INTEGER) AS bin, (hi - lo) / 40 AS step FROM r, range(40) AS t(bin)),
counts AS (
  SELECT g.feature, g.bin, count(*) AS n FROM grid g JOIN long l ON l.feature = g.feature
   AND l.x >= g.lo + g.bin * g.step AND (g.bin = 39 OR l.x < g.lo + (g.bin + 1) * g.step) GROUP BY 1, 2)"""
)


@query(
    "histogram",
    ctes("loans", extra=_HIST_EXTRA) + """SELECT g.feature, g.bin, g.lo + g.bin * g.step AS bin_low,
    CASE WHEN g.bin = 39 THEN g.hi ELSE g.lo + (g.bin + 1) * g.step END AS bin_high, coalesce(n, 0) AS n
    FROM grid g LEFT JOIN counts c ON c.feature = g.feature AND c.bin = g.bin""",
)
def _(spark, sf):
    return P.histogram(loans(spark, sf), HIST, 40)


@query(
    "reference_snapshot",
    SPLITS + "SELECT loan_id, loan_amount, credit_score, loan_default FROM split_loans WHERE split = 'train'",
)
def _(spark, sf):
    from creditspark.session import fresh_dir
    from creditspark.sources.tables import read_split, write_splits

    path = fresh_dir(spark, "splits")
    write_splits(SP.hash_split(loans(spark, sf).select(*S.CANONICAL_COLUMNS)), path)
    return read_split(spark, path, "train").select("loan_id", "loan_amount", "credit_score", "loan_default")
