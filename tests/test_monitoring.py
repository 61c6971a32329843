"""Fairness, prediction log, alerts, runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspark.errors import PromotionError
from creditspark.operators import alerts as AL, fairness as A, predictions as PR, runs as RU
from creditspark.operators.skew import hot_keys, salted_join


def test_slices_need_twenty_rows_and_two_classes(spark):
    rows = [("a", i % 2, i / 20) for i in range(20)] + [("b", i % 2, i / 20) for i in range(19)] + [("c", 1, 0.5)] * 30 + [(None, i % 2, 0.5) for i in range(40)]
    df = spark.createDataFrame(rows, "loan_purpose string, loan_default int, default_probability double")
    got = A.slice_metrics(df, columns=["loan_purpose", "absent"]).collect()
    assert [r.slice_value for r in got] == ["a"]
    assert got[0].approval_rate == 0.5 and got[0].n_samples == 20


def test_disparate_impact(spark):
    s = spark.createDataFrame([("p", "x", 0.5), ("p", "y", 0.4), ("q", "x", 0.5), ("r", "x", 0.0), ("r", "y", 0.0), ("t", "x", 0.39), ("t", "y", 0.5)],
                              "slice_column string, slice_value string, approval_rate double")
    got = {r.slice_column: r for r in A.disparate_impact(s).collect()}
    assert set(got) == {"p", "t"} and got["p"].disparate_impact_ratio == 0.8
    assert not got["p"].flagged_4_5ths_rule and got["t"].flagged_4_5ths_rule


def log_of(spark, n, labeled, classes=2):
    rows = [(f"L{i}", (i % 10) / 10, "v1", f"r{i}", (i % classes) if i < labeled else None) for i in range(n)]
    return spark.createDataFrame(rows, "loan_id string, default_probability double, model_version string, request_id string, actual_default int")


def test_live_auc_reasons(spark):
    few = PR.live_auc(log_of(spark, 150, 99)).first()
    assert few.live_auc is None and few.reason == "Insufficient labeled samples: 99 < 100" and few.n_total == 150
    assert PR.live_auc(log_of(spark, 150, 100)).first().live_auc is not None
    assert PR.live_auc(log_of(spark, 150, 120, 1)).first().reason == "Only one class present in labeled data"


def test_backfill_and_duplicates(spark):
    log = log_of(spark, 4, 1)
    labels = spark.createDataFrame([("L0", 1, 1), ("L1", 1, 1), ("L1", 0, 2), ("Z", 1, 1)], "loan_id string, loan_default int, t int")
    latest = {r.loan_id: r.actual_default for r in PR.backfill(log, PR.latest_labels(labels, "t")).collect()}
    assert latest == {"L0": 1, "L1": 0, "L2": None, "L3": None}
    assert PR.backfill(log, PR.label_rows(labels)).count() == 5
    m = PR.matched_labels(log, labels).first()
    assert (m.n_label_rows, m.n_ids) == (3, 2)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(3000).select(F.when(F.col("id") < 1500, 7).when(F.col("id") < 1600, None).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.createDataFrame([(7, "a"), (7, "b"), (3, "c"), (None, "n"), (99, "z")], "k long, v string")
    assert hot_keys(left, ["k"], 200, 1).count() == 1
    plain = left.alias("l").join(right.alias("r"), F.col("l.k").eqNullSafe(F.col("r.k")), how)
    plain = plain.select("l.k", "id", *(["v"] if how != "left_semi" else []))
    got = salted_join(left, right, ["k"], how, hot_rows=200).select(*plain.columns)
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_drift_alert_limits_are_strict(spark):
    psi = spark.createDataFrame([("a", 0.15), ("b", 0.1501), ("c", 0.30), ("d", 0.3001), ("e", None)], "feature string, psi double")
    got = {r.feature: r for r in AL.drift_alerts(psi).collect()}
    assert {f: r.severity for f, r in got.items()} == {"b": "warning", "c": "warning", "d": "critical"}
    assert got["d"].message == "Critical PSI drift on 'd': 0.300 > 0.300" and got["b"].threshold == 0.15
    assert got["b"].message == "Warning PSI drift on 'b': 0.150 > 0.150"


def test_summary(spark):
    psi = spark.createDataFrame([("a", 0.4)], "feature string, psi double")
    auc = spark.createDataFrame([(0.7,)], "live_auc double")
    s = AL.monitoring_summary(AL.monitoring_alerts(psi, auc), psi, auc).first()
    assert (s.n_alerts, s.has_critical, s.retrain_triggered, s.psi_values, s.live_auc) == (2, True, True, {"a": 0.4}, 0.7)
    calm = spark.createDataFrame([("a", 0.01)], "feature string, psi double")
    s = AL.monitoring_summary(AL.monitoring_alerts(calm, None), calm, None).first()
    assert (s.n_alerts, s.retrain_triggered, s.live_auc) == (0, False, None)


def test_alarm_runs_and_gaps(spark):
    rule = AL.AlarmRule("max", "above", 10.0, 2, 3600)
    rows = [("m", h, v) for h, v in [(0, 11), (1, 12), (2, 5), (3, 20), (5, 20), (6, 30), (7, 30)]] + [("n", 0, 99)]
    df = spark.createDataFrame(rows, "metric string, h int, value int").selectExpr(
        "metric", "timestamp_ntz'2024-01-01' + make_dt_interval(0, h) AS period", "double(value) AS value")
    got = sorted((r.metric, r.alarm_at.hour, r.ok_at and r.ok_at.hour, r.n_periods) for r in AL.alarm_intervals(df, rule).collect())
    assert got == [("m", 1, 2, 2), ("m", 6, None, 3)]  # nothing is known yet of the hour after the seventh


def test_retrain_cooldown_against_loop(spark):
    rng = np.random.default_rng(8)
    rows = [(m, h, int(rng.integers(1, 60)), bool(rng.random() < 0.3)) for m in ("a", "b") for h in range(200)]
    df = spark.createDataFrame(rows, "model string, h int, n_rows int, critical boolean").selectExpr(
        "model", "timestamp_ntz'2024-01-01' + make_dt_interval(0, h) AS hour", "n_rows", "critical", "h")
    want = []
    for m in ("a", "b"):
        seen, last = 0, None
        for _, h, n, c in [r for r in rows if r[0] == m]:
            seen += n
            if c and seen >= 1000 and (last is None or h - last >= 24):
                last = h
                want.append((m, h))
    base = df.first().hour
    got = sorted((r.model, int((r.signal_at - base).total_seconds() // 3600)) for r in AL.retrain_signals(df).collect())
    assert got == sorted(want)


def test_levels(spark):
    rows = spark.createDataFrame([("psi", 0.1), ("psi", 0.11), ("psi", 0.21), ("f1", 0.55), ("auc_roc", 0.9), ("ks_pvalue", 0.01)], "metric string, value double")
    assert sorted((r.metric, r.value, r.level) for r in AL.threshold_levels(rows).collect()) == [
        ("auc_roc", 0.9, "ok"), ("f1", 0.55, "warning"), ("ks_pvalue", 0.01, "critical"), ("psi", 0.1, "ok"), ("psi", 0.11, "warning"), ("psi", 0.21, "critical")]


def test_gate():
    RU.require_gate(0.80)
    with pytest.raises(PromotionError):
        RU.require_gate(0.7999)


def test_bucketed_join_equals_the_plain_one_for_hot_ids(spark):
    from creditspark.operators import predictions as PR

    log = spark.range(600).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id = 7 THEN NULL ELSE concat('L', id % 50) END AS loan_id", "id AS k",
        "CASE WHEN id % 41 <> 0 THEN timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id AS INT)) END AS ts",
    )
    labels = spark.range(90).selectExpr(
        "CASE WHEN id % 4 = 0 THEN 'hot' WHEN id = 5 THEN NULL ELSE concat('L', id) END AS loan_id", "id % 2 AS loan_default",
        "CASE WHEN id % 17 <> 0 THEN timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id * 9 AS INT)) END AS label_ts",
    )
    want = PR.delayed_label_join(log, labels)
    for days in (1, 15, 400):
        got = PR.bucketed_label_join(log, labels, bucket_days=days)
        assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert want.where("label is not null and loan_id = 'hot'").count() > 300
    # the hot id's rows lie under many keys
    assert log.where("loan_id = 'hot' and ts is not null").select((F.unix_seconds(F.col("ts").cast("timestamp")) / (15 * 86_400)).cast("long")).distinct().count() > 30


def test_backfill_replaces_only_the_days_it_touches(spark):
    from pathlib import Path

    from creditspark.operators import predictions as PR
    from creditspark.session import fresh_dir
    from creditspark.sources.tables import append_predictions, backfill_log, read_predictions

    log = spark.range(40).selectExpr(
        "concat('L', id) AS loan_id", "0.5D AS default_probability", "'v1' AS model_version", "concat('r', id) AS request_id",
        "timestamp'2024-01-01' + make_dt_interval(CAST(id % 8 AS INT)) AS ts", "CASE WHEN id % 5 = 0 THEN 1 END AS actual_default",
    )
    path = fresh_dir(spark, "log")
    append_predictions(log, path)
    files = lambda: {f.parent.name: f.name for f in Path(path.removeprefix("file:")).glob("dt=*/*.parquet")}
    before = files()
    labels = spark.createDataFrame([("L1", 0), ("L9", 1), ("L2", 1), ("L5", 1), ("L99", 1), (None, 1), ("L3", None)], "loan_id string, actual_default int")
    want = PR.backfill(read_predictions(spark, path), labels.where("loan_id is not null")).collect()
    days = backfill_log(spark, path, labels)
    assert sorted(str(r.dt) for r in days.collect()) == ["2024-01-02", "2024-01-03"]  # L5 already had that label
    after = files()
    changed = {d for d in before if before[d] != after[d]}
    assert set(after) == set(before) and changed == {"dt=2024-01-02", "dt=2024-01-03"}
    assert sorted(map(repr, read_predictions(spark, path).collect())) == sorted(map(repr, want))
    backfill_log(spark, path, labels)  # once more changes nothing
    assert files() == after
