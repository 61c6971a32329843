"""Ranking metrics, calibration and fairness."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditspark import schema as S
from creditspark.functions.numeric import round_half_even as R
from creditspark.operators import curve as V, fairness as A, metrics as M
from creditspark.plans.fixtures import ctes, loans, prediction_log
from creditspark.plans.registry import query

LOANS = ctes("loans")
SCORE, LABEL = "default_probability", "loan_default"


def _r(df, *cols, dp=6):
    return df.withColumns({c: R(F.col(c), dp) for c in cols})


def r6(expr: str) -> str:
    return f"round_even(({expr}) * 1000000, 0) / 1000000"


CURVE = """
hist AS (SELECT default_probability AS value, count(*) FILTER (WHERE loan_default = 1) AS pos,
  count(*) FILTER (WHERE loan_default = 0) AS neg FROM loans GROUP BY 1),
curve AS (SELECT value, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(neg) OVER w AS BIGINT) AS cum_neg,
  CAST(sum(pos) OVER () AS BIGINT) AS total_pos, CAST(sum(neg) OVER () AS BIGINT) AS total_neg,
  lead(value) OVER (ORDER BY value) AS next_value FROM hist WINDOW w AS (ORDER BY value ROWS UNBOUNDED PRECEDING)),
auc AS (SELECT sum(CAST(pos AS DOUBLE) * (cum_neg - neg / 2)) / (CAST(max(total_pos) AS DOUBLE) * max(total_neg)) AS a,
  max(abs(cum_pos / total_pos - cum_neg / total_neg)) AS ks FROM curve)"""
CURVES = ctes("loans", extra=CURVE)


@query("score_curve", CURVES + "SELECT * FROM curve")
def _(spark, sf):
    return V.score_curve(loans(spark, sf), SCORE, LABEL)


RANKS = """
ranked AS (SELECT loan_default, rank() OVER (ORDER BY default_probability) + (count(*) OVER (PARTITION BY default_probability) - 1) / 2 AS mr FROM loans),
sums AS (SELECT sum(mr) FILTER (WHERE loan_default = 1) AS s, count(*) FILTER (WHERE loan_default = 1) AS p,
  count(*) FILTER (WHERE loan_default = 0) AS n FROM ranked)"""
AUC_SQL = "(s - CAST(p AS DOUBLE) * (p + 1) / 2) / (CAST(p AS DOUBLE) * n)"


@query("roc_auc", ctes("loans", extra=RANKS) + f"SELECT {r6(AUC_SQL)} AS auc_roc FROM sums")
def _(spark, sf):
    return _r(V.rank_metrics(loans(spark, sf), SCORE, LABEL).select("auc_roc"), "auc_roc")


@query("gini", ctes("loans", extra=RANKS) + f"SELECT {r6('2 * ' + AUC_SQL + ' - 1')} AS gini FROM sums")
def _(spark, sf):
    return _r(V.rank_metrics(loans(spark, sf), SCORE, LABEL).select("gini"), "gini")


@query("ks_statistic", CURVES + f"SELECT {r6('ks')} AS ks_statistic FROM auc")
def _(spark, sf):
    return _r(V.rank_metrics(loans(spark, sf), SCORE, LABEL).select("ks_statistic"), "ks_statistic")


@query(
    "score_rank",
    LOANS + """SELECT loan_id, home_ownership, rank() OVER (PARTITION BY home_ownership ORDER BY default_probability)
    + (count(*) OVER (PARTITION BY home_ownership, default_probability) - 1) / 2 AS mid_rank FROM loans""",
)
def _(spark, sf):
    rows = loans(spark, sf).select("loan_id", "home_ownership", SCORE)
    return V.score_ranks(rows, SCORE, ["home_ownership"]).drop(SCORE)


CONF = """
conf AS (SELECT count(*) FILTER (WHERE default_probability >= 4e-1 AND loan_default = 1) AS tp,
  count(*) FILTER (WHERE default_probability >= 4e-1 AND loan_default = 0) AS fp,
  count(*) FILTER (WHERE default_probability < 4e-1 AND loan_default = 1) AS fn,
  count(*) FILTER (WHERE default_probability < 4e-1 AND loan_default = 0) AS tn, count(*) AS n FROM loans)"""


@query(
    "classification_metrics",
    ctes("loans", extra=CURVE.strip() + "," + CONF) + f"""SELECT {r6('a')} AS auc_roc, {r6('2 * a - 1')} AS gini, {r6('ks')} AS ks_statistic,
    {r6('2 * tp / (2 * tp + fn + fp)')} AS f1, {r6('tp / (tp + fp)')} AS precision, {r6('tp / (tp + fn)')} AS recall,
    {r6('(tp + tn) / n')} AS accuracy, 4e-1 AS threshold, n AS n_samples, tp + fn AS n_positives, {r6('(tp + fn) / n')} AS positive_rate
    FROM auc, conf""",
)
def _(spark, sf):
    out = M.classification_metrics(loans(spark, sf), SCORE, LABEL, 0.4)
    return _r(out, "auc_roc", "gini", "ks_statistic", "f1", "precision", "recall", "accuracy", "positive_rate")


@query(
    "class_imbalance",
    LOANS + f"""SELECT count(*) FILTER (WHERE loan_default = 0) AS n_neg, count(*) FILTER (WHERE loan_default = 1) AS n_pos,
    {r6('count(*) FILTER (WHERE loan_default = 0) / count(*) FILTER (WHERE loan_default = 1)')} AS scale_pos_weight FROM loans""",
)
def _(spark, sf):
    return _r(M.class_imbalance(loans(spark, sf), LABEL), "scale_pos_weight")


@query(
    "fbeta",
    LOANS + f"""SELECT home_ownership, {r6('5 * tp / (5 * tp + 4 * fn + fp)')} AS fbeta FROM (
    SELECT home_ownership, count(*) FILTER (WHERE default_probability >= 5e-1 AND loan_default = 1) AS tp,
    count(*) FILTER (WHERE default_probability >= 5e-1 AND loan_default = 0) AS fp,
    count(*) FILTER (WHERE default_probability < 5e-1 AND loan_default = 1) AS fn FROM loans GROUP BY 1)""",
)
def _(spark, sf):
    counts = M.confusion_counts(loans(spark, sf), SCORE, LABEL, 0.5, ["home_ownership"])
    out = counts.select("home_ownership", M.fbeta(F.col("tp"), F.col("fp"), F.col("fn"), 2.0).alias("fbeta"))
    return _r(out, "fbeta")


GRID = """
grid AS (SELECT 1e-1 + i * ((1e-1 + 1e-2) - 1e-1) AS threshold FROM range(80) AS t(i)),
cells AS (SELECT threshold, count(*) FILTER (WHERE default_probability >= threshold AND loan_default = 1) AS tp,
  count(*) FILTER (WHERE default_probability >= threshold AND loan_default = 0) AS fp,
  count(*) FILTER (WHERE default_probability < threshold AND loan_default = 1) AS fn FROM grid, loans GROUP BY threshold),
scored AS (SELECT threshold, tp, fp, fn, coalesce(5 * tp / nullif(5 * tp + 4 * fn + fp, 0), 0e0) AS fb FROM cells)"""


@query("threshold_grid", ctes("loans", extra=GRID) + f"SELECT threshold, tp, fp, fn, {r6('fb')} AS fbeta FROM scored")
def _(spark, sf):
    return _r(M.threshold_table(loans(spark, sf), SCORE, LABEL), "fbeta")


@query(
    "calibrate_threshold",
    ctes("loans", extra=GRID) + f"SELECT threshold, {r6('fb')} AS fbeta FROM scored ORDER BY fb DESC, threshold LIMIT 1",
)
def _(spark, sf):
    return _r(M.calibrate_threshold(loans(spark, sf), SCORE, LABEL), "fbeta")


def _slices_sql(frm: str = "loans") -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS slice_column, CAST({c} AS VARCHAR) AS slice_value, default_probability AS p, loan_default AS y FROM {frm}"
        for c in S.AUDIT_COLUMNS
    )
    return f"""
sl AS ({long}),
srank AS (SELECT *, rank() OVER (PARTITION BY slice_column, slice_value ORDER BY p)
  + (count(*) OVER (PARTITION BY slice_column, slice_value, p) - 1) / 2 AS mr FROM sl WHERE slice_value IS NOT NULL),
sagg AS (SELECT slice_column, slice_value, count(*) AS n, CAST(sum(y) AS BIGINT) AS pos, sum(mr) FILTER (WHERE y = 1) AS s,
  count(*) FILTER (WHERE p >= 5e-1) AS rejected FROM srank GROUP BY 1, 2),
slices AS (SELECT slice_column, slice_value, n AS n_samples,
  CAST(printf('%.4f', (s - CAST(pos AS DOUBLE) * (pos + 1) / 2) / (CAST(pos AS DOUBLE) * (n - pos))) AS DOUBLE) AS auc_roc,
  CAST(printf('%.4f', 1 - rejected / n) AS DOUBLE) AS approval_rate,
  CAST(printf('%.4f', pos / n) AS DOUBLE) AS default_rate FROM sagg WHERE n >= 20 AND pos > 0 AND pos < n),
impact AS (SELECT slice_column, CAST(printf('%.4f', min(approval_rate) / max(approval_rate)) AS DOUBLE) AS disparate_impact_ratio,
  max(approval_rate) AS max_approval_rate, min(approval_rate) AS min_approval_rate,
  min(approval_rate) / max(approval_rate) < 8e-1 AS flagged_4_5ths_rule FROM slices GROUP BY 1 HAVING count(*) >= 2 AND max(approval_rate) <> 0)"""


SLICES = ctes("loans", extra=_slices_sql())


@query("slice_metrics", SLICES + "SELECT * FROM slices")
def slices(spark, sf, base=None):
    return A.slice_metrics(loans(spark, sf) if base is None else base)


@query("sort_slices", SLICES + "SELECT * FROM slices ORDER BY slice_column, slice_value")
def _(spark, sf):
    return slices(spark, sf).orderBy("slice_column", "slice_value")


@query("disparate_impact", SLICES + "SELECT * FROM impact")
def _(spark, sf):
    return A.disparate_impact(slices(spark, sf))


@query(
    "filter_min_support",
    LOANS + """SELECT employment_years, n, CASE WHEN n < 350 THEN 'too few rows' WHEN pos = 0 OR pos = n THEN 'one class' END AS skip_reason
    FROM (SELECT employment_years, count(*) AS n, sum(loan_default) AS pos FROM loans GROUP BY 1)""",
)
def _(spark, sf):
    counted = loans(spark, sf).groupBy("employment_years").agg(
        F.count(F.lit(1)).alias("n"), F.sum(LABEL).alias("pos")
    )
    reason = F.when(F.col("n") < 350, "too few rows").when(
        (F.col("pos") == 0) | (F.col("pos") == F.col("n")), "one class"
    )
    return counted.select("employment_years", "n", reason.alias("skip_reason"))


@query(
    "distinct_values",
    ctes("prediction_log") + """SELECT count(DISTINCT actual_default) AS n_classes,
    string_agg(DISTINCT model_version, ',' ORDER BY model_version) AS model_versions FROM prediction_log WHERE actual_default IS NOT NULL""",
)
def _(spark, sf):
    labeled = prediction_log(spark, sf).filter(F.col("actual_default").isNotNull())
    return labeled.agg(
        F.countDistinct("actual_default").alias("n_classes"),
        F.array_join(F.array_sort(F.collect_set("model_version")), ",").alias("model_versions"),
    )
