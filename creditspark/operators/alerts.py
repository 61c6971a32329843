"""Alerts from drift and performance, severity tables, alarms and the retrain signal."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from creditspark import schema as S
from creditspark.functions.loan import live_auc_message, psi_message

ALERT_COLUMNS = ["alert_type", "severity", "feature", "value", "threshold", "message"]


def drift_alerts(psi: DataFrame, threshold: float = S.PSI_THRESHOLD) -> DataFrame:
    """PSI above the threshold warns; above twice the threshold it is critical."""
    limit = F.when(F.col("psi") > threshold * 2, F.lit(threshold * 2)).when(F.col("psi") > threshold, F.lit(threshold))
    return (
        psi.withColumn("threshold", limit)
        .filter(F.col("threshold").isNotNull())
        .withColumn("severity", F.when(F.col("psi") > threshold * 2, "critical").otherwise("warning"))
        .select(
            F.lit("drift_psi").alias("alert_type"),
            "severity",
            "feature",
            F.col("psi").alias("value"),
            "threshold",
            psi_message(F.col("severity"), F.col("feature"), F.col("psi"), F.col("threshold")).alias("message"),
        )
    )


def performance_alert(auc: DataFrame, threshold: float = S.LIVE_AUC_THRESHOLD) -> DataFrame:
    """A critical alert where the live AUC is known and below the threshold."""
    return auc.filter(F.col("live_auc") < threshold).select(
        F.lit("performance_degradation").alias("alert_type"),
        F.lit("critical").alias("severity"),
        F.lit(None).cast("string").alias("feature"),
        F.col("live_auc").alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        live_auc_message(F.col("live_auc"), F.lit(float(threshold))).alias("message"),
    )


def monitoring_alerts(psi: DataFrame, auc: DataFrame | None) -> DataFrame:
    alerts = drift_alerts(psi)
    return alerts if auc is None else alerts.unionByName(performance_alert(auc))


def monitoring_summary(alerts: DataFrame, psi: DataFrame, auc: DataFrame | None) -> DataFrame:
    """One row: alert count, critical and retrain flags, PSI per feature, live AUC.

    The PSI map has one entry per feature.
    """
    by_feature = psi.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "psi")))).alias("m")
    ).scalar()
    live = F.lit(None).cast("double") if auc is None else auc.select("live_auc").scalar()
    critical = F.coalesce(F.bool_or(F.col("severity") == "critical"), F.lit(False))
    return (
        alerts.agg(F.count(F.lit(1)).alias("n_alerts"), critical.alias("has_critical"))
        .withColumn("retrain_triggered", F.col("has_critical"))
        .withColumn("psi_values", by_feature)
        .withColumn("live_auc", live)
        .withColumn("checked_at", F.current_timestamp())
    )


def threshold_table(spark: SparkSession) -> DataFrame:
    """The declared warning and critical levels: one row per metric."""
    return spark.createDataFrame(S.THRESHOLD_LEVELS, "metric string, direction string, warning double, critical double")


def threshold_levels(metrics: DataFrame, levels: DataFrame | None = None) -> DataFrame:
    """Metric rows (metric, value, ...) with their level: ok, warning or critical.

    The default levels are a handful of rows; a table passed in is joined as it is.
    """
    table = F.broadcast(threshold_table(metrics.sparkSession)) if levels is None else levels

    def beyond(limit: str) -> Column:
        above = F.col("direction") == "above"
        return (above & (F.col("value") > F.col(limit))) | (~above & (F.col("value") < F.col(limit)))

    level = F.when(beyond("critical"), "critical").when(beyond("warning"), "warning").otherwise("ok")
    return metrics.join(table, "metric").withColumn("level", level).drop("direction")


@dataclass(frozen=True)
class AlarmRule:
    """Alarm when ``stat`` of a period breaches for ``periods`` periods in a row."""

    stat: str  # max, avg or sum
    comparison: str  # above or below
    threshold: float
    periods: int = 1
    period_seconds: int = 3600


# --- fixed values: the declared alarms ------------------------------------------
PSI_ALARM = AlarmRule("max", "above", 0.15, 1, 3600)
LIVE_AUC_ALARM = AlarmRule("avg", "below", 0.75, 2, 3600)
ERROR_RATE_ALARM = AlarmRule("max", "above", 1.0, 2, 60)
# ----------------------------------------------------------------------------------


def breaches(rule: AlarmRule, value: Column) -> Column:
    hit = value > rule.threshold if rule.comparison == "above" else value < rule.threshold
    return F.coalesce(hit, F.lit(False))


def period_stats(rows: DataFrame, rule: AlarmRule, ts: str = "ts", value: str = "value") -> DataFrame:
    """(metric, period, value): the rule's statistic per metric and period."""
    stat = {"max": F.max, "avg": F.avg, "sum": F.sum}[rule.stat]
    width = f"{rule.period_seconds} seconds"
    return (
        rows.groupBy("metric", F.window(ts, width).alias("w"))
        .agg(stat(value).alias("value"))
        .select("metric", F.col("w.start").alias("period"), "value")
    )


def alarm_intervals(stats: DataFrame, rule: AlarmRule) -> DataFrame:
    """(metric, alarm_at, ok_at, n_periods): each alarm and when it is over.

    Only breaching periods matter; a missing period counts as not breaching, so a gap
    ends a run. An alarm is over once the period after its last breach is: as long as no
    metric has a later period, ``ok_at`` is null. One row per metric and period enters the
    window, however many raw rows a metric has.
    """
    step = rule.period_seconds
    newest = stats.agg(F.max("period")).scalar()
    index = (F.unix_seconds(F.col("period").cast("timestamp")) / step).cast("long")
    order = Window.partitionBy("metric").orderBy("i")
    runs = (
        stats.filter(breaches(rule, F.col("value")))
        .withColumn("i", index)
        .withColumn("run", F.col("i") - F.row_number().over(order))
        .groupBy("metric", "run")
        .agg(F.min("period").alias("first"), F.max("period").alias("last"), F.count(F.lit(1)).alias("n_periods"))
        .filter(F.col("n_periods") >= rule.periods)
    )
    return runs.select(
        "metric",
        (F.col("first") + F.make_dt_interval(secs=F.lit(step * (rule.periods - 1)))).alias("alarm_at"),
        F.when(F.col("last") < newest, F.col("last") + F.make_dt_interval(secs=F.lit(step))).alias("ok_at"),
        "n_periods",
    )


def alarm_transitions(intervals: DataFrame) -> DataFrame:
    """The notifications of each alarm: going to ALARM and, where it is over, back to OK."""
    steps = F.array(
        F.struct(F.col("alarm_at").alias("at"), F.lit("ALARM").alias("state")),
        F.struct(F.col("ok_at").alias("at"), F.lit("OK").alias("state")),
    )
    return intervals.select("metric", F.explode(steps).alias("s")).select("metric", "s.at", "s.state").where("at is not null")


def check_forget(cooldown_hours: int, forget_hours: int | None) -> None:
    if forget_hours is not None and forget_hours < cooldown_hours:
        raise ValueError("forget_hours must not be less than the cool-down")


def retrain_signals(
    hourly: DataFrame,
    min_rows: int = S.MIN_ROWS_FOR_RETRAIN,
    cooldown_hours: int = S.RETRAIN_COOLDOWN_HOURS,
    forget_hours: int | None = None,
) -> DataFrame:
    """(model, signal_at): retrain signals with a row minimum and a cool-down.

    ``hourly`` holds one row per model and hour: (model, hour, n_rows, critical). A
    signal needs ``min_rows`` rows seen so far and ``cooldown_hours`` since the previous
    signal of that model. The hours of a model are folded in order; their number is
    bounded by the calendar, not by the data. With ``forget_hours`` (at least the
    cool-down) a model starts anew after a longer silence.
    """
    check_forget(cooldown_hours, forget_hours)
    order = Window.partitionBy("model").orderBy("hour")
    spell = F.lit(0)
    if forget_hours is not None:
        silent = F.col("hour") > F.lag("hour").over(order) + F.make_dt_interval(hours=F.lit(forget_hours))
        hourly = hourly.withColumn("silent", F.coalesce(silent, F.lit(False)).cast("int"))
        spell = F.sum("silent").over(order)
    upto = Window.partitionBy("model", "spell").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    due = (
        hourly.withColumn("spell", spell)
        .withColumn("seen", F.sum("n_rows").over(upto))
        .filter(F.col("critical") & (F.col("seen") >= min_rows))
        .groupBy("model")
        .agg(F.array_sort(F.collect_list("hour")).alias("hours"))
    )
    gap = F.make_dt_interval(hours=F.lit(cooldown_hours))
    accepted = F.aggregate(
        "hours",
        F.slice("hours", 1, 1),
        lambda acc, h: F.when(h >= F.element_at(acc, -1) + gap, F.array_append(acc, h)).otherwise(acc),
    )
    return due.select("model", F.explode(accepted).alias("signal_at"))
