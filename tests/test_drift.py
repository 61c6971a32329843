import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspark.operators import drift as D, profile as P


def one(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def numpy_psi(ref, cur, n=10):
    bins = np.linspace(min(min(ref), min(cur)), max(max(ref), max(cur)), n + 1)
    r, c = np.histogram(ref, bins)[0], np.histogram(cur, bins)[0]
    r, c = (r + 1e-4) / (len(ref) + 1e-4 * n), (c + 1e-4) / (len(cur) + 1e-4 * n)
    return max(0.0, float(np.sum((c - r) * np.log(c / r))))


def test_psi_matches_numpy(spark):
    rng = np.random.default_rng(5)
    ref, cur = rng.normal(0, 1, 500).round(1), rng.normal(0.5, 1.2, 300).round(1)
    got = D.psi(one(spark, [*ref, None]), one(spark, [*cur, float("nan")]), ["x"], decimals=None).first()
    assert got.psi == pytest.approx(numpy_psi(ref, cur)) and got.reason is None


def test_psi_edges(spark):
    x = one(spark, [1.0, 2.0, 3.0])
    assert D.psi(x, x, ["x"]).first().psi == 0.0
    const = D.psi(one(spark, [5.0] * 10), one(spark, [5.0] * 1000), ["x"], decimals=None).first()
    assert const.psi == pytest.approx(numpy_psi([5.0] * 10, [5.0] * 1000))
    empty = D.psi(x, x.limit(0), ["x"]).first()
    assert empty.psi is None and empty.reason == "no current values"


def test_histogram_matches_numpy(spark):
    values = [i / 10 for i in range(11)] + [0.3, 0.6, 0.7]
    got = sorted((r.bin, r.n) for r in P.histogram(one(spark, values), ["x"], 10).collect())
    assert [n for _, n in got] == list(np.histogram(values, bins=np.array([0.1 * i for i in range(10)] + [1.0]))[0])
    const = sorted((r.bin, r.n) for r in P.histogram(one(spark, [3.0] * 4), ["x"], 4).collect())
    assert [n for _, n in const] == list(np.histogram([3.0] * 4, bins=4)[0])


@pytest.mark.parametrize("large", [None, 5])
def test_ks_and_wasserstein(spark, large):
    rng = np.random.default_rng(6)
    ref, cur = rng.normal(0, 2, 300).round(1), rng.normal(1, 2, 200).round(1)
    grid = np.unique(np.concatenate([ref, cur]))
    f, g = (np.array([np.mean(s <= t) for t in grid]) for s in (ref, cur))
    ks = D.ks_drift(one(spark, ref), one(spark, cur), ["x"], large).first()
    assert ks.statistic == pytest.approx(np.max(np.abs(f - g))) and 0 <= ks.p_value < 0.01
    wd = D.wasserstein_drift(one(spark, ref), one(spark, cur), ["x"], large).first()
    assert wd.distance == pytest.approx(np.sum(np.abs(f - g)[:-1] * np.diff(grid)))
    assert wd.statistic == pytest.approx(wd.distance / ref.std())


def test_tails(spark):
    row = spark.range(1).select(
        D.chi_square_tail(F.lit(3.0), F.lit(2)).alias("a"),
        D.chi_square_tail(F.lit(2.5), F.lit(1)).alias("b"),
        D.chi_square_tail(F.lit(7.0), F.lit(5)).alias("c"),
        D.chi_square_tail(F.lit(5000.0), F.lit(3)).alias("d"),
        D.chi_square_tail(F.lit(float("inf")), F.lit(3)).alias("e"),
        D.kolmogorov_tail(F.lit(0.1), F.lit(200), F.lit(200)).alias("k"),
    ).first()
    assert row.a == pytest.approx(math.exp(-1.5))
    assert row.b == pytest.approx(math.erfc(math.sqrt(1.25)))
    x = 3.5
    five = math.erfc(math.sqrt(x)) + math.exp(-x) * (x**0.5 / math.gamma(1.5) + x**1.5 / math.gamma(2.5))
    assert row.c == pytest.approx(five)
    assert row.d == 0.0 and row.e == 0.0
    lam = 1.0
    assert row.k == pytest.approx(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 50)))


def test_categorical(spark):
    ref = spark.createDataFrame([("a",)] * 60 + [("b",)] * 40, "c string")
    cur = spark.createDataFrame([("a",)] * 30 + [("b",)] * 20 + [("n",)] * 5, "c string")
    assert D.categorical_drift(ref, ref, ["c"]).first().js_distance == 0.0
    new = D.categorical_drift(ref, cur, ["c"]).first()
    assert new.p_value == 0.0 and new.js_distance > 0.1 and math.isinf(new.chi_square)


def test_report_flags(spark):
    rows = spark.createDataFrame([("a", True), ("b", False)], "column_name string, drifted boolean")
    half = D.drift_report(rows).first()
    assert half.dataset_drift and half.share_of_drifted_columns == 0.5
    none = D.drift_report(rows.limit(0)).first()
    assert not none.dataset_drift and none.n_features_tested == 0


def test_quality_rates(spark):
    got = D.quality_rates(one(spark, [*range(1, 20), 1000, None]), ["x"]).first()
    assert got.null_rate == pytest.approx(1 / 21) and got.null_rate_ok
    assert got.outlier_rate == pytest.approx(1 / 20) and got.outlier_rate_ok


@pytest.mark.parametrize("df", [1, 2, 3, 6, 19, 20, 151, 1200, 2000, 5001, 10_000, 20_000])
def test_chi_square_tail_at_any_number_of_degrees(spark, df):
    def exact(x):
        half = x / 2
        if x <= 0:
            return 1.0
        logs = [(j + df % 2 / 2) * math.log(half) - half - math.lgamma(j + 1 + df % 2 / 2) for j in range(df // 2)]
        return min(1.0, sum(map(math.exp, logs)) + (math.erfc(math.sqrt(half)) if df % 2 else 0.0))

    points = [df * f for f in (0.05, 0.5, 0.9, 1.0, 1.1, 1.5, 2.1)] + [0.3, 30.0]
    rows = spark.createDataFrame([(float(x), df) for x in points], "x double, df long")
    got = rows.select("x", D.chi_square_tail(F.col("x"), F.col("df")).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(exact(r.x), rel=1e-8, abs=1e-300)
    if df == 2000:
        assert rows.limit(1).select(D.chi_square_tail(F.lit(4200.0), F.lit(2000))).first()[0] < 1e-100


def test_erfc(spark):
    zs = [0.0, 1e-9, 0.3, 0.999, 1.0, 1.7, 4.0, 12.0, 26.0]
    got = [r[0] for r in spark.createDataFrame([(z,) for z in zs], "z double").select(D.erfc(F.col("z"))).collect()]
    assert got == pytest.approx([math.erfc(z) for z in zs], rel=1e-10)


def test_booleans_dates_and_times_are_tested(spark):
    ref = spark.range(200).selectExpr(
        "concat('L', id) AS loan_id", "id % 2 = 0 AS flag", "id % 2 = 0 AS same", "date_add(DATE'2024-01-01', CAST(id % 30 AS INT)) AS day",
        "timestamp_seconds(id * 60) AS at", "timestamp_ntz'2024-01-01' + make_dt_interval(0, CAST(id % 24 AS INT)) AS hour", "array(id) AS skipped",
    )
    cur = ref.selectExpr("loan_id", "flag OR true AS flag", "same", "date_add(day, 300) AS day", "at", "hour", "skipped")
    got = {r.column_name: (r.kind, r.drifted) for r in D.drift_columns(ref, cur).collect()}
    assert got == {"flag": ("cat", True), "same": ("cat", False), "day": ("num", True), "at": ("num", False), "hour": ("num", False)}
    assert {r.column_name: r.drifted for r in D.drift_columns(ref, cur, "ks", "chi_square").collect()} == {k: v[1] for k, v in got.items()}
    report = D.drift_report(D.drift_columns(ref, cur)).first()
    assert (report.n_features_tested, report.drifted_columns) == (5, 2)
