import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from creditspark.operators import curve as V, metrics as M


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def brute_ks(y, p):
    grid = np.unique(p)
    f = [np.mean(p[y == 1] <= t) for t in grid]
    g = [np.mean(p[y == 0] <= t) for t in grid]
    return np.max(np.abs(np.array(f) - np.array(g)))


def frame(spark, y, p, g=None):
    g = g if g is not None else ["a"] * len(y)
    rows = [(i, int(a) if a is not None else None, float(b) if b is not None else None, c) for i, (a, b, c) in enumerate(zip(y, p, g))]
    return spark.createDataFrame(rows, "id int, y int, p double, g string")


@pytest.mark.parametrize("large", [None, 3])
@pytest.mark.parametrize("decimals", [1, 6])
def test_auc_ks_against_brute_force(spark, large, decimals):
    rng = np.random.default_rng(1)
    y, p = rng.integers(0, 2, 400), rng.random(400).round(decimals)
    g = np.where(rng.random(400) < 0.7, "big", np.where(rng.random(400) < 0.5, "mid", "small"))
    got = {r.g: r for r in V.rank_metrics(frame(spark, y, p, g), "p", "y", ["g"], large).collect()}
    for name in set(g):
        m = g == name
        assert got[name].auc_roc == pytest.approx(brute_auc(y[m], p[m]))
        assert got[name].ks_statistic == pytest.approx(brute_ks(y[m], p[m]))
    whole = V.rank_metrics(frame(spark, y, p), "p", "y", None, large).first()
    assert whole.auc_roc == pytest.approx(brute_auc(y, p)) and whole.gini == pytest.approx(2 * brute_auc(y, p) - 1)


def test_auc_is_invariant(spark):
    rng = np.random.default_rng(2)
    y, p = rng.integers(0, 2, 200), rng.random(200).round(2)
    df = frame(spark, y, p)
    auc = lambda d: V.rank_metrics(d, "p", "y", None, 5).first().auc_roc
    base = auc(df)
    assert auc(df.withColumn("p", F.exp("p") * 3)) == pytest.approx(base)
    assert auc(df.withColumn("p", 1 - F.col("p"))) == pytest.approx(1 - base)
    assert auc(df.repartition(7, "id")) == pytest.approx(base)


def test_one_class_and_missing(spark):
    one = V.rank_metrics(frame(spark, [1, 1], [0.1, 0.2]), "p", "y").first()
    assert one.auc_roc is None and one.ks_statistic == 0.0
    df = frame(spark, [0, 0, 1, 1, None, 1], [0.1, 0.4, 0.35, 0.8, 0.9, None])
    assert V.rank_metrics(df, "p", "y").first().auc_roc == pytest.approx(0.75)
    ties = V.rank_metrics(frame(spark, [0, 1, 0, 1], [0.5] * 4), "p", "y").first()
    assert ties.auc_roc == 0.5 and ties.ks_statistic == 0.0


def test_perfect(spark):
    m = M.classification_metrics(frame(spark, [0, 0, 0, 1, 1, 1], [0.05, 0.1, 0.15, 0.85, 0.9, 0.95]), "p", "y").first()
    assert (m.auc_roc, m.gini, m.ks_statistic, m.f1, m.precision, m.recall, m.accuracy) == (1,) * 7
    assert (m.n_samples, m.n_positives, m.positive_rate, m.threshold) == (6, 3, 0.5, 0.5)


@pytest.mark.parametrize("large", [None, 4])
def test_mid_ranks(spark, large):
    import pandas as pd

    rng = np.random.default_rng(3)
    p, g = rng.integers(0, 12, 150) / 10, rng.choice(["a", "b"], 150)
    df = frame(spark, [0] * 150, p, g)
    got = {r.id: r.mid_rank for r in V.score_ranks(df, "p", ["g"], large, hot_rows=3).collect()}
    want = pd.Series(p).groupby(g).rank()
    assert len(got) == 150 and all(got[i] == want[i] for i in range(150))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=60), st.sampled_from([0.0, 0.25, 0.5, 0.95, 0.99, 1.0]))
def test_quantiles(spark, values, q):
    df = frame(spark, [0] * len(values), values)
    got = V.quantiles(df, "p", {"q": q}, None, 3).first()
    assert got.q == pytest.approx(np.quantile(values, q)) and got.n == len(values)
    assert got["mean"] == pytest.approx(np.mean(values))


def test_next_value_crosses_ranges(spark):
    rows = V.running_totals(frame(spark, [0] * 20, range(20)), "p", {"n": F.lit(1).cast("long")}, None, 2)
    got = sorted((r.value, r.next_value, r.cum_n, r.total_n) for r in rows.collect() if r.value < 19)
    assert got == [(float(i), float(i + 1), i + 1, 20) for i in range(19)]


def test_calibration_against_loop(spark):
    rng = np.random.default_rng(4)
    y, p = rng.integers(0, 2, 300), rng.random(300).round(2)
    best, at = -1.0, 0.5
    for t in np.arange(0.1, 0.9, 0.01):
        hit = p >= t
        tp, fp, fn = (hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 1)).sum()
        score = 5 * tp / (5 * tp + 4 * fn + fp) if tp else 0.0
        if score > best:
            best, at = score, float(t)
    got = M.calibrate_threshold(frame(spark, y, p), "p", "y").first()
    assert got.threshold == at and got.fbeta == pytest.approx(best)
    assert M.threshold_values() == list(np.arange(0.1, 0.9, 0.01))


def test_class_weight(spark):
    df = frame(spark, [0, 0, 0, 1], [0.1] * 4)
    assert M.class_imbalance(df, "y").first().scale_pos_weight == 3.0
    with pytest.raises(Exception, match="no positive rows"):
        M.class_imbalance(df.filter("y = 0"), "y").collect()
