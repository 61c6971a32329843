"""Prediction log, alerts, alarms, runs and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditspark import schema as S
from creditspark.functions.numeric import round_half_even as R
from creditspark.operators import alerts as AL, fairness as FA, metrics as M, predictions as PR, runs as RU, split as SP
from creditspark.operators.columns import union_by_name
from creditspark.operators.curve import rank_metrics
from creditspark.plans.fixtures import contributions, ctes, labels_feed, loans, metric_events, prediction_log, runs, table
from creditspark.plans.q_drift import BINS, PSI_FEATURES, PSI_HOUR, psi_all, psi_histogram
from creditspark.plans.q_metrics import _slices_sql, r6, slices
from creditspark.plans.q_quality import SPLIT
from creditspark.plans.registry import query
from creditspark.session import fresh_dir, stored
from creditspark.streaming.drift import psi_by_time
from creditspark.streaming.monitor import error_rate

LOGS = ctes("prediction_log", "labels_feed")
LATEST = """
latest AS (SELECT loan_id, CAST(arg_max(loan_default, (label_ts, loan_default)) AS INTEGER) AS y FROM labels_feed GROUP BY 1)"""


def backfilled(spark, sf):
    return PR.backfill(prediction_log(spark, sf), PR.latest_labels(labels_feed(spark, sf), "label_ts"))


BACKFILL = """
backfilled AS (SELECT p.* REPLACE (coalesce(l.y, p.actual_default) AS actual_default) FROM prediction_log p LEFT JOIN latest l USING (loan_id))"""
FILLED = ctes("prediction_log", "labels_feed", extra=LATEST.strip() + "," + BACKFILL)

query("label_backfill", FILLED + "SELECT * FROM backfilled")(backfilled)


@query(
    "label_backfill_all",
    LOGS + """SELECT p.* REPLACE (coalesce(CAST(l.loan_default AS INTEGER), p.actual_default) AS actual_default)
    FROM prediction_log p LEFT JOIN labels_feed l USING (loan_id)""",
)
def _(spark, sf):
    return PR.backfill(prediction_log(spark, sf), PR.label_rows(labels_feed(spark, sf)))


@query(
    "coalesce_update",
    LOGS + """SELECT p.loan_id, p.actual_default AS old_label, CAST(l.loan_default AS INTEGER) AS new_label,
    coalesce(CAST(l.loan_default AS INTEGER), p.actual_default) AS actual_default
    FROM prediction_log p LEFT JOIN labels_feed l USING (loan_id)""",
)
def _(spark, sf):
    fresh = PR.label_rows(labels_feed(spark, sf)).withColumnRenamed("actual_default", "new_label")
    log = prediction_log(spark, sf).select("loan_id", F.col("actual_default").alias("old_label"))
    return log.join(fresh, "loan_id", "left").withColumn("actual_default", F.coalesce("new_label", "old_label"))


@query(
    "label_match_count",
    LOGS + """SELECT count(*) AS n_label_rows, count(DISTINCT loan_id) AS n_ids FROM labels_feed
    WHERE loan_id IN (SELECT loan_id FROM prediction_log)""",
)
def _(spark, sf):
    return PR.matched_labels(prediction_log(spark, sf), labels_feed(spark, sf))


@query(
    "delayed_label_interval_join",
    LOGS + """SELECT p.*, l.loan_default AS label, l.label_ts FROM prediction_log p LEFT JOIN labels_feed l
    ON p.loan_id = l.loan_id AND l.label_ts BETWEEN p.ts + INTERVAL 30 DAY AND p.ts + INTERVAL 90 DAY""",
)
def _(spark, sf):
    return PR.delayed_label_join(prediction_log(spark, sf), labels_feed(spark, sf))


@query(
    "delayed_label_bucketed_join",
    LOGS + """SELECT p.*, l.loan_default AS label, l.label_ts FROM prediction_log p LEFT JOIN labels_feed l
    ON p.loan_id = l.loan_id AND l.label_ts BETWEEN p.ts + INTERVAL 30 DAY AND p.ts + INTERVAL 90 DAY""",
)
def _(spark, sf):
    return PR.bucketed_label_join(prediction_log(spark, sf), labels_feed(spark, sf))


@query("label_backfill_sink", FILLED + "SELECT *, CAST(date_trunc('month', ts) AS DATE) AS dt FROM backfilled")
def _(spark, sf):
    """The stored log after the labels were written into the folders they touch."""
    from creditspark.sources.tables import append_predictions, backfill_log, read_predictions

    path = fresh_dir(spark, "log")
    append_predictions(prediction_log(spark, sf), path, period="month")
    backfill_log(spark, path, PR.latest_labels(labels_feed(spark, sf), "label_ts"))
    return read_predictions(spark, path)


def _auc_sql(by: str = "", frm: str = "prediction_log") -> str:
    part = f"PARTITION BY {by}" if by else ""
    also = f"PARTITION BY {by}, default_probability" if by else "PARTITION BY default_probability"
    sel = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return f"""
lr AS (SELECT {sel}actual_default AS y, model_version AS mv, rank() OVER ({part} ORDER BY default_probability)
  + (count(*) OVER ({also}) - 1) / 2 AS mr FROM {frm} WHERE actual_default IS NOT NULL),
la AS (SELECT {sel}count(*) AS n, count(*) FILTER (WHERE y = 1) AS p, sum(mr) FILTER (WHERE y = 1) AS s,
  string_agg(DISTINCT mv, ',' ORDER BY mv) AS model_versions FROM lr{grp}),
tot AS (SELECT {sel}count(*) AS n_total FROM {frm}{grp}),
live AS (SELECT {"tot." + by + "," if by else ""} CASE WHEN n >= 100 AND p > 0 AND p < n THEN CAST(printf('%.4f', (s - CAST(p AS DOUBLE) * (p + 1) / 2) / (CAST(p AS DOUBLE) * (n - p))) AS DOUBLE) END AS live_auc,
  coalesce(n, 0) AS n_labeled, n_total, coalesce(model_versions, '') AS model_versions,
  CASE WHEN coalesce(n, 0) < 100 THEN 'Insufficient labeled samples: ' || coalesce(n, 0) || ' < 100'
    WHEN p = 0 OR p = n THEN 'Only one class present in labeled data' END AS reason
  FROM tot LEFT JOIN la {f"ON la.{by} = tot.{by}" if by else "ON TRUE"})"""


def live(spark, sf, by=None):
    out = PR.live_auc(prediction_log(spark, sf), by=by)
    return out.withColumn("model_versions", F.array_join("model_versions", ","))


@query("live_auc", ctes("prediction_log", extra=_auc_sql()) + "SELECT * FROM live")
def _(spark, sf):
    return live(spark, sf)


@query("live_auc_by_version", ctes("prediction_log", extra=_auc_sql("model_version")) + "SELECT * FROM live")
def _(spark, sf):
    return live(spark, sf, ["model_version"])


@query(
    "live_auc_after_backfill",
    ctes("prediction_log", "labels_feed", extra=LATEST.strip() + "," + BACKFILL + "," + _auc_sql(frm="backfilled")) + "SELECT * FROM live",
)
def _(spark, sf):
    out = PR.live_auc(backfilled(spark, sf))
    return out.withColumn("model_versions", F.array_join("model_versions", ","))


_MONTHLY = "monthly AS (SELECT *, strftime(ts, '%Y-%m') AS month FROM prediction_log),"


@query("live_auc_over_time", ctes("prediction_log", extra=_MONTHLY + _auc_sql("month", "monthly")) + "SELECT * FROM live")
def _(spark, sf):
    log = prediction_log(spark, sf).withColumn("month", F.date_format("ts", "yyyy-MM"))
    out = PR.live_auc(log, by=["month"])
    return out.withColumn("model_versions", F.array_join("model_versions", ","))


@query("log_date_partition", LOGS + "SELECT loan_id, 'predictions/' || strftime(ts, '%Y/%m/%d') AS log_path FROM prediction_log")
def _(spark, sf):
    from creditspark.sources.tables import log_location

    return log_location(prediction_log(spark, sf)).select("loan_id", "log_path")


@query(
    "union_diagonal",
    LOGS + """SELECT loan_id, default_probability, model_version, request_id, ts, actual_default FROM prediction_log
    UNION ALL SELECT loan_id, NULL, NULL, NULL, NULL, CAST(loan_default AS INTEGER) FROM labels_feed""",
)
def _(spark, sf):
    return union_by_name(prediction_log(spark, sf), PR.label_rows(labels_feed(spark, sf)))


@query(
    "metric_rows",
    ctes("ref_cur", "metric_events", extra=BINS) + """SELECT 'PSI' AS metric, '{"Feature":"' || feature || '"}' AS dims, psi AS value, 'None' AS unit FROM psi
    UNION ALL SELECT 'PredictionCount', '{"Decision":"' || decision || '","RiskTier":"' || risk_tier || '"}', 1e0, 'Count' FROM metric_events
    UNION ALL SELECT 'PredictionLatency', '{}', latency_ms, 'Milliseconds' FROM metric_events
    UNION ALL SELECT 'DefaultProbability', '{}', probability, 'None' FROM metric_events""",
)
def _(spark, sf):
    per_event = PR.prediction_metrics(metric_events(table(spark, sf, "events"))).drop("ts")
    out = PR.psi_metrics(psi_all(spark, sf)).unionByName(per_event)
    return out.withColumn("dims", F.to_json("dims"))


DRIFT_ALERTS = """
drift_alerts AS (SELECT 'drift_psi' AS alert_type, CASE WHEN psi > 15e-2 * 2 THEN 'critical' ELSE 'warning' END AS severity, feature, psi AS value,
  CASE WHEN psi > 15e-2 * 2 THEN 15e-2 * 2 ELSE 15e-2 END AS threshold,
  CASE WHEN psi > 15e-2 * 2 THEN 'Critical' ELSE 'Warning' END || ' PSI drift on ''' || feature || ''': ' || printf('%.3f', psi) || ' > '
    || printf('%.3f', CASE WHEN psi > 15e-2 * 2 THEN 15e-2 * 2 ELSE 15e-2 END) AS message
  FROM psi WHERE psi > 15e-2)"""
PERF = """
perf_alerts AS (SELECT 'performance_degradation' AS alert_type, 'critical' AS severity, CAST(NULL AS VARCHAR) AS feature, live_auc AS value,
  75e-2 AS threshold, 'Live AUC ' || printf('%.4f', live_auc) || ' < threshold 0.7500' AS message FROM live WHERE live_auc < 75e-2)"""
ALL_ALERTS = ctes(
    "ref_cur", "prediction_log",
    extra=BINS + "," + DRIFT_ALERTS + "," + _auc_sql() + "," + PERF
    + ",\nall_alerts AS (SELECT * FROM drift_alerts UNION ALL SELECT * FROM perf_alerts)",
)


@query("drift_alerts", ctes("ref_cur", extra=BINS + "," + DRIFT_ALERTS) + "SELECT * FROM drift_alerts")
def _(spark, sf):
    return AL.drift_alerts(psi_all(spark, sf))


@query("alert_message", ctes("ref_cur", extra=BINS + "," + DRIFT_ALERTS) + "SELECT feature, message FROM drift_alerts")
def _(spark, sf):
    return AL.drift_alerts(psi_all(spark, sf)).select("feature", "message")


@query("performance_alert", ALL_ALERTS + "SELECT * FROM perf_alerts")
def _(spark, sf):
    return AL.performance_alert(live(spark, sf))


@query("union_alerts", ALL_ALERTS + "SELECT * FROM all_alerts")
def _(spark, sf):
    return AL.monitoring_alerts(psi_all(spark, sf), live(spark, sf))


@query(
    "monitoring_summary",
    ALL_ALERTS + """SELECT count(*) AS n_alerts, coalesce(bool_or(severity = 'critical'), FALSE) AS has_critical,
    coalesce(bool_or(severity = 'critical'), FALSE) AS retrain_triggered,
    (SELECT string_agg(feature || '=' || printf('%.4f', psi), ';' ORDER BY feature) FROM psi) AS psi_values,
    (SELECT live_auc FROM live) AS live_auc FROM all_alerts""",
)
def _(spark, sf):
    psi, auc = stored(psi_all(spark, sf), "psi"), stored(live(spark, sf), "auc")  # eight rows and one
    out = AL.monitoring_summary(AL.monitoring_alerts(psi, auc), psi, auc).drop("checked_at")
    shown = F.transform(
        F.map_entries("psi_values"),
        lambda e: F.concat(e["key"], F.lit("="), F.call_function("format_number", e["value"], F.lit("0.0000"))),
    )
    return out.withColumn("psi_values", F.array_join(shown, ";"))


LEVELS = """
mrows AS (SELECT 'psi' AS metric, feature AS name, psi AS value FROM psi
  UNION ALL SELECT 'auc_roc', run_id, test_auc_roc FROM runs)"""


@query(
    "threshold_levels",
    ctes("ref_cur", "runs", extra=BINS + "," + LEVELS) + """SELECT metric, name, value,
    CASE metric WHEN 'psi' THEN 1e-1 ELSE 78e-2 END AS warning, CASE metric WHEN 'psi' THEN 2e-1 ELSE 72e-2 END AS critical,
    CASE WHEN metric = 'psi' THEN CASE WHEN value > 2e-1 THEN 'critical' WHEN value > 1e-1 THEN 'warning' ELSE 'ok' END
      ELSE CASE WHEN value < 72e-2 THEN 'critical' WHEN value < 78e-2 THEN 'warning' ELSE 'ok' END END AS level FROM mrows""",
)
def _(spark, sf):
    psi = psi_all(spark, sf).select(F.lit("psi").alias("metric"), F.col("feature").alias("name"), F.col("psi").alias("value"))
    auc = runs(spark, sf).select(F.lit("auc_roc").alias("metric"), F.col("run_id").alias("name"), F.col("test_auc_roc").alias("value"))
    return AL.threshold_levels(psi.unionByName(auc))


ALARM = AL.AlarmRule("avg", "above", 60.0, 2, 3600)
ALARM_SQL = """
hourly AS (SELECT event_type AS metric, time_bucket(INTERVAL 1 HOUR, ts) AS period, avg(value) AS v FROM events GROUP BY 1, 2),
br AS (SELECT metric, period, CAST(epoch(period) AS BIGINT) // 3600 - row_number() OVER (PARTITION BY metric ORDER BY period) AS run FROM hourly WHERE v > 60),
islands AS (SELECT metric, min(period) AS f, max(period) AS l, count(*) AS n_periods FROM br GROUP BY metric, run HAVING count(*) >= 2),
alarms AS (SELECT metric, f + INTERVAL 1 HOUR AS alarm_at,
  CASE WHEN l < (SELECT max(period) FROM hourly) THEN l + INTERVAL 1 HOUR END AS ok_at, n_periods FROM islands)"""


def alarm_rows(events):
    return events.select(F.col("event_type").alias("metric"), "ts", "value")


def alarms(spark, sf):
    stats = AL.period_stats(alarm_rows(table(spark, sf, "events")), ALARM)
    return AL.alarm_intervals(stats, ALARM)


@query("consecutive_breach", "WITH " + ALARM_SQL.strip() + " SELECT * FROM alarms")
def _(spark, sf):
    return alarms(spark, sf)


TRANSITIONS = """ SELECT metric, alarm_at AS at, 'ALARM' AS state FROM alarms
    UNION ALL SELECT metric, ok_at, 'OK' FROM alarms WHERE ok_at IS NOT NULL"""


def _declared_sql(name: str, rows: str, stat: str, breach: str, periods: int, seconds: int) -> str:
    """CTEs ending in ``name``: the alarms of one declared rule over ``rows`` (metric, ts, value)."""
    width = f"INTERVAL {seconds} SECOND"
    return f"""
{name}_s AS (SELECT metric, time_bucket({width}, ts) AS period, {stat}(value) AS v FROM ({rows}) GROUP BY 1, 2),
{name}_b AS (SELECT metric, period, CAST(epoch(period) AS BIGINT) // {seconds} - row_number() OVER (PARTITION BY metric ORDER BY period) AS run
  FROM {name}_s WHERE {breach}),
{name} AS (SELECT metric, min(period) + {width} * {periods - 1} AS alarm_at,
  CASE WHEN max(period) < (SELECT max(period) FROM {name}_s) THEN max(period) + {width} END AS ok_at, count(*) AS n_periods
  FROM {name}_b GROUP BY metric, run HAVING count(*) >= {periods})"""


DECLARED = ctes(
    "metric_events",
    extra=PSI_HOUR + """,
hr AS (SELECT date_trunc('hour', ts) AS hour, is_error AS y, rank() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY probability)
  + (count(*) OVER (PARTITION BY date_trunc('hour', ts), probability) - 1) / 2 AS mr FROM metric_events),
ha AS (SELECT hour, count(*) AS n, count(*) FILTER (WHERE y) AS p, sum(mr) FILTER (WHERE y) AS s FROM hr GROUP BY 1),
er AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS ts, 1e2 * count(*) FILTER (WHERE is_error)
  / greatest(count(*) FILTER (WHERE is_error), count(*) FILTER (WHERE NOT is_error)) AS rate FROM metric_events GROUP BY 1),"""
    + _declared_sql("psi_alarms", "SELECT 'psi:' || feature AS metric, window_start AS ts, psi AS value FROM psi_hour", "max", "v > 15e-2", 1, 3600)
    + ","
    + _declared_sql(
        "auc_alarms",
        "SELECT 'live_auc' AS metric, hour AS ts, (s - CAST(p AS DOUBLE) * (p + 1) / 2) / nullif(CAST(p AS DOUBLE) * (n - p), 0) AS value FROM ha",
        "avg", "v < 75e-2", 2, 3600,
    )
    + ","
    + _declared_sql("error_alarms", "SELECT 'error_rate' AS metric, ts, rate AS value FROM er", "max", "v > 1e0", 2, 60),
)


def hourly_auc(events):
    """(ts, value): the AUC of each hour's predictions."""
    rows = events.select(F.date_trunc("hour", "ts").alias("hour"), "probability", F.col("is_error").cast("int").alias("y"))
    return rank_metrics(rows, "probability", "y", ["hour"]).select(F.col("hour").cast("timestamp_ntz").alias("ts"), F.col("auc_roc").alias("value"))


@query("declared_alarms", DECLARED + "FROM psi_alarms UNION ALL FROM auc_alarms UNION ALL FROM error_alarms")
def _(spark, sf):
    """The three declared alarms: PSI per feature and live AUC by the hour, error rate by the minute."""
    events = metric_events(table(spark, sf, "events"))
    psi = psi_by_time(events, psi_histogram(spark, sf), PSI_FEATURES).select(
        F.concat(F.lit("psi:"), F.col("feature")).alias("metric"), F.col("window_start").alias("ts"), F.col("psi").alias("value")
    )
    hourly = hourly_auc(events).select(F.lit("live_auc").alias("metric"), "ts", "value")
    rates = error_rate(events).select(
        F.lit("error_rate").alias("metric"), F.col("window_start").alias("ts"), F.col("error_rate").alias("value")
    )
    parts = [
        AL.alarm_intervals(AL.period_stats(rows, rule), rule)
        for rows, rule in ((psi, AL.PSI_ALARM), (hourly, AL.LIVE_AUC_ALARM), (rates, AL.ERROR_RATE_ALARM))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "alarm_transitions",
    "WITH " + ALARM_SQL.strip() + TRANSITIONS,
)
def _(spark, sf):
    return AL.alarm_transitions(alarms(spark, sf))


@query(
    "retrain_signal",
    """WITH RECURSIVE hourly AS (SELECT event_type AS model, time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n_rows, max(value) > 200 AS critical
      FROM events GROUP BY 1, 2),
    seen AS (SELECT *, sum(n_rows) OVER (PARTITION BY model ORDER BY hour ROWS UNBOUNDED PRECEDING) AS s FROM hourly),
    due AS (SELECT model, hour FROM seen WHERE critical AND s >= 1000),
    sig AS (SELECT model, min(hour) AS h FROM due GROUP BY model
      UNION ALL SELECT sig.model, (SELECT min(hour) FROM due WHERE due.model = sig.model AND due.hour >= sig.h + INTERVAL 24 HOUR) FROM sig WHERE sig.h IS NOT NULL)
    SELECT model, h AS signal_at FROM sig WHERE h IS NOT NULL""",
)
def _(spark, sf):
    hourly = (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("model"), F.window("ts", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("n_rows"), (F.max("value") > 200).alias("critical"))
        .select("model", F.col("w.start").alias("hour"), "n_rows", "critical")
    )
    return AL.retrain_signals(hourly)


RUNS = ctes("runs")
BOARD = ["run_id", "model_name", "test_auc_roc", "val_auc_roc", "test_ks_statistic", "test_gini"]


@query(
    "run_leaderboard",
    RUNS + f"SELECT {', '.join(BOARD)} FROM runs ORDER BY test_auc_roc DESC, run_id LIMIT 10",
)
def _(spark, sf):
    return RU.leaderboard(runs(spark, sf)).select(*BOARD)


@query(
    "model_comparison",
    RUNS + f"""SELECT model_name, {r6('avg(test_auc_roc)')} AS mean, max(test_auc_roc) AS max, {r6('stddev_samp(test_auc_roc)')} AS std FROM runs GROUP BY 1""",
)
def _(spark, sf):
    out = RU.model_comparison(runs(spark, sf))
    return out.withColumns({c: R(F.col(c), 6) for c in ("mean", "std")})


@query("best_trial", RUNS + "SELECT run_id, model_name, max_depth, val_auc_roc FROM runs ORDER BY val_auc_roc DESC, run_id LIMIT 1")
def _(spark, sf):
    return RU.best_trial(runs(spark, sf).select("run_id", "model_name", "max_depth", "val_auc_roc"))


GATE = """
gated AS (SELECT run_id, model_name, created, test_auc_roc, test_auc_roc >= 8e-1 AS promoted,
  'Test AUC ' || printf('%.4f', test_auc_roc) || CASE WHEN test_auc_roc >= 8e-1 THEN ' ≥' ELSE ' <' END || ' threshold 0.8000' AS promotion_reason FROM runs)"""


@query("promotion_gate", ctes("runs", extra=GATE) + "SELECT run_id, promoted, promotion_reason FROM gated")
def _(spark, sf):
    return RU.promotion_gate(runs(spark, sf)).select("run_id", "promoted", "promotion_reason")


def versions(spark, sf):
    gated = RU.promotion_gate(runs(spark, sf))
    return gated.select(
        "model_name",
        F.substring("run_id", 5, 8).cast("long").alias("version"),
        "created",
        F.when(F.col("promoted"), "Approved").otherwise("PendingManualApproval").alias("approval"),
    )


VERSIONS = GATE + """,
versions AS (SELECT model_name, CAST(substr(run_id, 5, 8) AS BIGINT) AS version, created,
  CASE WHEN promoted THEN 'Approved' ELSE 'PendingManualApproval' END AS approval FROM gated)"""


@query(
    "latest_champion",
    ctes("runs", extra=VERSIONS) + """SELECT model_name, version, created, approval,
    CASE WHEN row_number() OVER (PARTITION BY model_name ORDER BY created DESC, version DESC) = 1 THEN 'champion' ELSE 'archived' END AS status
    FROM versions WHERE approval = 'Approved'""",
)
def _(spark, sf):
    return RU.champions(versions(spark, sf))


@query("list_versions", ctes("runs", extra=VERSIONS) + "SELECT * FROM versions ORDER BY created DESC, version DESC LIMIT 20")
def _(spark, sf):
    return RU.list_versions(versions(spark, sf))


@query(
    "run_table",
    RUNS + "SELECT run_id, model_name, created, CAST(max_depth AS VARCHAR) AS max_depth, test_auc_roc, val_auc_roc, CAST(NULL AS DOUBLE) AS absent FROM runs",
)
def _(spark, sf):
    packed = RU.as_run_table(runs(spark, sf), ["max_depth"], ["test_auc_roc", "val_auc_roc"])
    return RU.flatten_runs(packed, ["max_depth"], ["test_auc_roc", "val_auc_roc", "absent"])


@query("head", ctes("loans") + f"SELECT {', '.join(S.CANONICAL_COLUMNS)} FROM loans ORDER BY loan_id LIMIT 5")
def _(spark, sf):
    return loans(spark, sf).select(*S.CANONICAL_COLUMNS).orderBy("loan_id").limit(5)


def report(spark, sf):
    base = stored(SP.hash_split(loans(spark, sf)), "split-loans")
    run = RU.best_trial(runs(spark, sf), "test_auc_roc").withColumn(
        "params", F.create_map(F.lit("max_depth"), F.col("max_depth").cast("string"))
    )
    val = M.classification_metrics(base.filter("split = 'val'"), "default_probability", "loan_default", 0.4)
    test = M.classification_metrics(base.filter("split = 'test'"), "default_probability", "loan_default", 0.4)
    sl = stored(slices(spark, sf, base), "slices")
    top = (
        contributions(spark, sf).groupBy("feature").agg(F.avg(F.abs("value")).alias("importance"))
    )
    return RU.evaluation_report(run, val, test, sl, FA.disparate_impact(sl), top, 0.4)


def _auc_of(where: str, name: str) -> str:
    return f"""
{name}r AS (SELECT loan_default AS y, rank() OVER (ORDER BY default_probability) + (count(*) OVER (PARTITION BY default_probability) - 1) / 2 AS mr
  FROM split_loans WHERE {where}),
{name} AS (SELECT (sum(mr) FILTER (WHERE y = 1) - CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * (count(*) FILTER (WHERE y = 1) + 1) / 2)
  / (CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * count(*) FILTER (WHERE y = 0)) AS a, count(*) AS n FROM {name}r)"""


EVALUATION = (
    ctes("loans", "runs", extra=SPLIT + "," + _slices_sql().strip() + "," + _auc_of("split = 'val'", "va") + "," + _auc_of("split = 'test'", "te"))
    + f"""SELECT (SELECT run_id FROM runs ORDER BY test_auc_roc DESC, run_id LIMIT 1) AS run_id, 4e-1 AS threshold,
    {r6('va.a')} AS val_auc, {r6('te.a')} AS test_auc, CAST(te.n AS DOUBLE) AS test_n,
    (SELECT count(*) FROM slices) AS n_slices, (SELECT count(*) FROM impact WHERE flagged_4_5ths_rule) AS n_flagged, 6::BIGINT AS n_factors,
    te.a >= 8e-1 AS promoted, 'Test AUC ' || printf('%.4f', te.a) || CASE WHEN te.a >= 8e-1 THEN ' ≥' ELSE ' <' END || ' threshold 0.8000' AS promotion_reason
    FROM va, te"""
)


def summary(reports):
    return reports.select(
        "run_id",
        "threshold",
        R(F.col("val_metrics")["auc_roc"], 6).alias("val_auc"),
        R(F.col("test_metrics")["auc_roc"], 6).alias("test_auc"),
        F.col("test_metrics")["n_samples"].alias("test_n"),
        F.size("slice_metrics").cast("long").alias("n_slices"),
        F.size(F.filter("disparate_impact", lambda d: d["flagged_4_5ths_rule"])).cast("long").alias("n_flagged"),
        F.size("top_features").cast("long").alias("n_factors"),
        "promoted",
        "promotion_reason",
    )


@query("evaluation_report", EVALUATION)
def _(spark, sf):
    return summary(report(spark, sf))
