"""Drift between a reference and a current window."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditspark import schema as S
from creditspark.functions.numeric import round_half_even as R
from creditspark.operators import drift as D
from creditspark.plans.fixtures import ctes, dirty_loans, metric_events, reference_current, table
from creditspark.plans.q_metrics import r6
from creditspark.plans.registry import query
from creditspark.session import fresh_dir, stored
from creditspark.streaming import drift as SD

NUM = S.NUMERIC_FEATURES
CAT = ["loan_purpose", "home_ownership", "loan_default"]


def _r(df, *cols, dp=6):
    return df.withColumns({c: R(F.col(c), dp) for c in cols})


def _long(cols, kind="DOUBLE"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS {kind}) AS x, {side} AS is_ref FROM {t}"
        for c in cols
        for t, side in (("reference_loans", "TRUE"), ("current_loans", "FALSE"))
    )


BINS = (
    f"long AS ({_long(NUM)}),\n"
    """r AS (SELECT feature, min(x) AS lo, max(x) AS hi, count(*) FILTER (WHERE is_ref) AS t_ref,
  count(*) FILTER (WHERE NOT is_ref) AS t_cur FROM long GROUP BY 1),
grid AS (SELECT r.*, CAST(bin AS INTEGER) AS bin, (hi - lo) / 10 AS step FROM r, range(10) AS t(bin)),
counts AS (SELECT g.feature, g.bin, count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur
  FROM grid g JOIN long l ON l.feature = g.feature AND l.x >= g.lo + g.bin * g.step AND (g.bin = 9 OR l.x < g.lo + (g.bin + 1) * g.step) GROUP BY 1, 2),
shares AS (SELECT g.feature, g.bin, (coalesce(n_ref, 0) + 1e-4) / (t_ref + 1e-3) AS rp, (coalesce(n_cur, 0) + 1e-4) / (t_cur + 1e-3) AS cp
  FROM grid g LEFT JOIN counts c ON c.feature = g.feature AND c.bin = g.bin),
psi AS (SELECT feature, CAST(printf('%.4f', greatest(sum((cp - rp) * ln(cp / rp)), 0e0)) AS DOUBLE) AS psi, CAST(NULL AS VARCHAR) AS reason FROM shares GROUP BY 1)"""
)
PSI = ctes("ref_cur", extra=BINS)


@query("psi", PSI + "SELECT * FROM psi WHERE feature = 'credit_score'")
def _(spark, sf):
    return D.psi(*reference_current(spark, sf), ["credit_score"])


@query("psi_all_features", PSI + "SELECT * FROM psi")
def psi_all(spark, sf):
    return D.psi(*reference_current(spark, sf))


@query("ref_current_align", PSI + "SELECT * FROM counts")
def _(spark, sf):
    return D.binned_counts(*reference_current(spark, sf), NUM)


@query("drop_if_missing_feature", PSI + "SELECT * FROM psi WHERE feature <> 'credit_score'")
def _(spark, sf):
    ref, cur = reference_current(spark, sf)
    return D.psi(ref, cur.drop("credit_score"), [*NUM, "never_there"])


EDF = (
    f"long AS ({_long(NUM)}),\n"
    """hist AS (SELECT feature, x, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c FROM long GROUP BY 1, 2),
edf AS (SELECT feature, x, lead(x) OVER (PARTITION BY feature ORDER BY x) AS nx,
  sum(r) OVER (PARTITION BY feature ORDER BY x ROWS UNBOUNDED PRECEDING) / sum(r) OVER (PARTITION BY feature) AS f,
  sum(c) OVER (PARTITION BY feature ORDER BY x ROWS UNBOUNDED PRECEDING) / sum(c) OVER (PARTITION BY feature) AS g,
  sum(r) OVER (PARTITION BY feature) AS t_ref, sum(c) OVER (PARTITION BY feature) AS t_cur FROM hist),
ks AS (SELECT feature, max(abs(f - g)) AS d, CAST(max(t_ref) AS BIGINT) AS n_ref, CAST(max(t_cur) AS BIGINT) AS n_cur FROM edf GROUP BY 1),
std AS (SELECT feature, stddev_pop(x) AS s FROM long WHERE is_ref GROUP BY 1),
wd AS (SELECT e.feature, sum(abs(f - g) * (nx - x)) AS distance, sum(abs(f - g) * (nx - x)) / greatest(max(s), 1e-3) AS normed
  FROM edf e JOIN std ON std.feature = e.feature GROUP BY 1)"""
)
EDFS = ctes("ref_cur", extra=EDF)
_LAM = "(d * sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)))"
_KS_P = (
    f"CASE WHEN {_LAM} < 2e-1 THEN 1e0 ELSE least(greatest(list_sum(list_transform(range(1, 101), lambda k: "
    f"CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END * exp(-2e0 * k * k * {_LAM} * {_LAM}))), 0e0), 1e0) END"
)


@query("drift_ks_test", EDFS + f"SELECT feature, {r6('d')} AS statistic, {r6(_KS_P)} AS p_value, n_ref, n_cur FROM ks")
def _(spark, sf):
    return _r(D.ks_drift(*reference_current(spark, sf), NUM), "statistic", "p_value")


@query("drift_wasserstein", EDFS + f"SELECT feature, round_even(distance * 10000, 0) / 10000 AS distance, {r6('normed')} AS statistic FROM wd")
def _(spark, sf):
    return _r(_r(D.wasserstein_drift(*reference_current(spark, sf), NUM), "statistic"), "distance", dp=4)


# The chi-square tail as a continued fraction (Lentz, from the far end) for x > a + 1, else a series.
_A, _X = "(degrees / 2e0)", "(chi_square / 2e0)"
_GAMMA_LOG = f"lgamma({_A})"
_TAIL_FRACTION = (
    f"exp({_A} * ln({_X}) - {_X} - {_GAMMA_LOG}) / list_reduce(list_reverse(range(1, 2001)), "
    f"lambda acc, i: {_X} + 2 * i - 1 - {_A} - i * (i - {_A}) / acc, {_X} + 4001 - {_A})"
)
_TAIL_SERIES = (
    f"1 - exp({_A} * ln({_X}) - {_X} - {_GAMMA_LOG}) * list_sum(list_transform(range(0, 400), "
    f"lambda n: exp(n * ln({_X}) - lgamma({_A} + n + 1) + {_GAMMA_LOG})))"
)
_CHI_P = f"CASE WHEN {_X} > {_A} + 1 THEN {_TAIL_FRACTION} ELSE {_TAIL_SERIES} END"


def _cats(cols):
    return (
    f"clong AS ({_long(cols, 'VARCHAR')}),\n"
    """ccount AS (SELECT feature, x, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c FROM clong GROUP BY 1, 2),
cshare AS (SELECT *, r / sum(r) OVER (PARTITION BY feature) AS p, c / sum(c) OVER (PARTITION BY feature) AS q,
  sum(c) OVER (PARTITION BY feature) AS t_cur FROM ccount),
cstat AS (SELECT feature, sum((c - p * t_cur) * (c - p * t_cur) / (p * t_cur)) AS chi_square, count(*) - 1 AS degrees,
  sqrt(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2) AS js_distance
  FROM cshare GROUP BY 1)"""
    )


CATS = _cats(CAT)


@query(
    "drift_categorical_test",
    ctes("ref_cur", extra=CATS)
    + f"SELECT feature, {r6('chi_square')} AS chi_square, degrees, {r6('js_distance')} AS js_distance, {r6(_CHI_P)} AS p_value FROM cstat",
)
def _(spark, sf):
    return _r(D.categorical_drift(*reference_current(spark, sf), CAT), "chi_square", "js_distance", "p_value")


MANY = ["loan_purpose", "annual_income"]
_SHARED = "(SELECT annual_income FROM reference_loans INTERSECT SELECT annual_income FROM current_loans)"


@query(
    "drift_columns_chi_square",
    ctes(
        "ref_cur",
        extra="seen AS " + _SHARED + ",\n" + _cats(MANY).replace(
            "CAST(annual_income AS VARCHAR) AS x, TRUE AS is_ref FROM reference_loans",
            "CAST(annual_income AS VARCHAR) AS x, TRUE AS is_ref FROM reference_loans WHERE annual_income IN (FROM seen)",
        ).replace(
            "CAST(annual_income AS VARCHAR) AS x, FALSE AS is_ref FROM current_loans",
            "CAST(annual_income AS VARCHAR) AS x, FALSE AS is_ref FROM current_loans WHERE annual_income IN (FROM seen)",
        ),
    )
    + f"""SELECT feature AS column_name, 'cat' AS kind, 'chi_square' AS test, {r6(_CHI_P)} AS score, {_CHI_P} < 5e-2 AS drifted FROM cstat""",
)
def _(spark, sf):
    """Incomes both windows hold, as text: hundreds to thousands of categories beside the six purposes."""
    ref, cur = (d.select("loan_purpose", "annual_income") for d in reference_current(spark, sf))
    seen = ref.select("annual_income").intersect(cur.select("annual_income"))

    def as_text(df):
        held = df.join(seen.withColumnRenamed("annual_income", "_seen"), F.col("annual_income") == F.col("_seen"), "left")
        return held.select("loan_purpose", F.col("_seen").cast("string").alias("annual_income"))

    return _r(D.drift_columns(as_text(ref), as_text(cur), categorical_test="chi_square"), "score")


REPORT = EDF + ",\n" + CATS + """,
dcols AS (SELECT feature AS column_name, 'num' AS kind, 'wasserstein' AS test, normed AS score, normed >= 1e-1 AS drifted FROM wd
  UNION ALL SELECT feature, 'cat', 'jensen_shannon', js_distance, js_distance >= 1e-1 FROM cstat)"""


@query("drift_columns", ctes("ref_cur", extra=REPORT) + f"SELECT column_name, kind, test, {r6('score')} AS score, drifted FROM dcols")
def drift_cols(spark, sf):
    ref, cur = (stored(d.select(*S.CANONICAL_COLUMNS), "window") for d in reference_current(spark, sf))
    return _r(D.drift_columns(ref, cur), "score")


@query(
    "dataset_drift_report",
    ctes("ref_cur", extra=REPORT) + f"""SELECT count(*) FILTER (WHERE drifted) / count(*) >= 5e-1 AS dataset_drift, count(*) FILTER (WHERE drifted) AS drifted_columns,
    {r6('count(*) FILTER (WHERE drifted) / count(*)')} AS share_of_drifted_columns, count(*) AS n_features_tested FROM dcols""",
)
def _(spark, sf):
    return _r(D.drift_report(drift_cols(spark, sf)), "share_of_drifted_columns")


_Q = NUM
QUAL = (
    "qlong AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM dirty_loans" for c in _Q)
    + """),
quart AS (SELECT feature, quantile_cont(x, 25e-2) AS q1, quantile_cont(x, 75e-2) AS q3 FROM qlong GROUP BY 1),
qrate AS (SELECT l.feature, avg(CASE WHEN x IS NULL THEN 1e0 ELSE 0e0 END) AS null_rate,
  avg(CASE WHEN x IS NOT NULL THEN CASE WHEN x < q1 - (q3 - q1) * 15e-1 OR x > q3 + (q3 - q1) * 15e-1 THEN 1e0 ELSE 0e0 END END) AS outlier_rate
  FROM qlong l JOIN quart q ON q.feature = l.feature GROUP BY 1)"""
)


@query(
    "quality_rates",
    ctes("dirty_loans", extra=QUAL) + f"""SELECT feature, {r6('null_rate')} AS null_rate, {r6('outlier_rate')} AS outlier_rate,
    null_rate <= 5e-2 AS null_rate_ok, outlier_rate <= 1e-1 AS outlier_rate_ok FROM qrate""",
)
def _(spark, sf):
    return _r(D.quality_rates(dirty_loans(spark, sf), _Q), "null_rate", "outlier_rate")


@query(
    "prediction_shift",
    ctes("ref_cur", extra="""m AS (SELECT (SELECT avg(default_probability) FROM reference_loans) AS a, (SELECT avg(default_probability) FROM current_loans) AS b)""")
    + f"SELECT {r6('a')} AS mean_ref, {r6('b')} AS mean_cur, {r6('abs(b - a)')} AS shift, abs(b - a) <= 15e-2 AS within_limit FROM m",
)
def _(spark, sf):
    out = D.prediction_shift(*reference_current(spark, sf), "default_probability")
    return _r(out, "mean_ref", "mean_cur", "shift")


PSI_FEATURES = ["latency_ms", "probability"]
#: The reference of the hourly PSI: the first ten days of the events.
REFERENCE_END = "2024-01-11"
PSI_HOUR = """
ref_long AS (SELECT 'latency_ms' AS feature, latency_ms AS v FROM metric_events WHERE ts < TIMESTAMP '2024-01-11'
  UNION ALL SELECT 'probability', probability FROM metric_events WHERE ts < TIMESTAMP '2024-01-11'),
cur_long AS (SELECT ts, 'latency_ms' AS feature, latency_ms AS v FROM metric_events UNION ALL SELECT ts, 'probability', probability FROM metric_events),
rng AS (SELECT feature, min(v) AS low, (max(v) - min(v)) / 10 AS step, count(v) AS t_ref FROM ref_long GROUP BY 1),
bins10 AS (SELECT CAST(range AS INTEGER) AS bin FROM range(10)),
ref_n AS (SELECT feature, CAST(least(greatest(floor((v - low) / step), 0), 9) AS INTEGER) AS bin, count(*) AS n FROM ref_long JOIN rng USING (feature) WHERE v IS NOT NULL GROUP BY 1, 2),
cur_n AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, feature, CAST(least(greatest(floor((v - low) / step), 0), 9) AS INTEGER) AS bin, count(*) AS n
  FROM cur_long JOIN rng USING (feature) WHERE v IS NOT NULL GROUP BY 1, 2, 3),
cur_t AS (SELECT window_start, feature, CAST(sum(n) AS BIGINT) AS t_cur FROM cur_n GROUP BY 1, 2),
psi_hour AS (SELECT c.window_start, c.feature, c.t_cur AS n, greatest(sum((cs - rs) * ln(cs / rs)), 0e0) AS psi FROM (
  SELECT t.window_start, t.feature, t.t_cur, (coalesce(r.n, 0) + 1e-4) / (g.t_ref + 1e-3) AS rs, (coalesce(k.n, 0) + 1e-4) / (t.t_cur + 1e-3) AS cs
  FROM cur_t t CROSS JOIN bins10 b JOIN rng g ON g.feature = t.feature LEFT JOIN ref_n r ON r.feature = t.feature AND r.bin = b.bin
  LEFT JOIN cur_n k ON k.window_start = t.window_start AND k.feature = t.feature AND k.bin = b.bin) c GROUP BY 1, 2, 3)"""


def psi_histogram(spark, sf):
    """The reference histogram, stored and read back as a monitor would."""
    path = fresh_dir(spark, "histogram")
    reference = metric_events(table(spark, sf, "events")).where(F.col("ts") < F.lit(REFERENCE_END).cast("timestamp"))
    SD.save_histogram(SD.reference_histogram(reference, PSI_FEATURES), path)
    return SD.load_histogram(spark, path)
