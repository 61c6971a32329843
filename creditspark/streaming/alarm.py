"""Alarms and retrain signals as keyed state over completed time buckets.

Two streams in a row: the first aggregates raw rows per metric and bucket and appends
completed buckets to a table, the second folds that table, in bucket order, into keyed
state. So the state function sees one row per bucket, whatever the volume of a metric.
The buckets a micro-batch completes are gathered by metric, so that a metric's buckets
arrive in one file per micro-batch and the second stream reads them in time order.

State is a typed value per key with an event-time timer that ends it, so keys that fall silent
leave nothing behind. It needs the RocksDB state store (``run.keyed_state``, or ``keyed=True`` of the functions that run a stream).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from creditspark import schema as S
from creditspark.operators.alerts import AlarmRule, breaches, check_forget
from creditspark.streaming.monitor import WATERMARK


def bucket_values(rows: DataFrame, rule: AlarmRule, watermark: str = WATERMARK) -> DataFrame:
    """(metric, period, value): the rule's statistic per completed bucket of a stream."""
    stat = {"max": F.max, "avg": F.avg, "sum": F.sum}[rule.stat]
    return (
        rows.withWatermark("ts", watermark)
        .groupBy("metric", F.window("ts", f"{rule.period_seconds} seconds").alias("w"))
        .agg(stat("value").alias("value"))
        .select("metric", F.col("w.start").alias("period"), "value")
        .repartition("metric")
    )


def hourly_activity(rows: DataFrame, critical_above: float, watermark: str = WATERMARK) -> DataFrame:
    """(model, hour, n_rows, critical) per completed hour of a stream of (model, ts, value)."""
    return (
        rows.withWatermark("ts", watermark)
        .groupBy("model", F.window("ts", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("n_rows"), (F.max("value") > critical_above).alias("critical"))
        .select("model", F.col("w.start").alias("hour"), "n_rows", "critical")
        .repartition("model")
    )


class _Timed(StatefulProcessor):
    """One typed value per key and at most one timer, which ``wake`` sets anew."""

    fields = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("value", self.fields)

    def wake(self, at_s: int | None) -> None:
        """The timer goes off once the watermark has reached ``at_s``; None: no timer."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if at_s is not None:
            self.handle.registerTimer(int(at_s) * 1000)

    def close(self) -> None:
        pass


def _in_order(chunks: Iterator[pd.DataFrame], column: str) -> pd.DataFrame:
    return pd.concat(list(chunks), ignore_index=True).sort_values(column)


class _Alarm(_Timed):
    fields = "last long, run long"

    def __init__(self, step: int, need: int):
        self.step, self.need = step, need

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, run = self.value.get() if self.value.exists() else (-1, 0)
        found = []
        buckets = _in_order(rows, "period_s")
        for at, breach in zip(buckets["period_s"], buckets["breach"]):
            if run and at > last + self.step:
                if run >= self.need:
                    found.append((last + self.step, "OK"))
                run = 0
            if breach:
                run += 1
                if run == self.need:
                    found.append((at, "ALARM"))
            else:
                if run >= self.need:
                    found.append((at, "OK"))
                run = 0
            last = at
        if run:
            self.value.update((int(last), int(run)))
            self.wake(int(last) + self.step)
        else:
            self.value.clear()
            self.wake(None)
        yield self.rows(key, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The bucket after the last breach is over and the metric had no row in it."""
        last, run = self.value.get()
        self.value.clear()
        yield self.rows(key, [(last + self.step, "OK")] if run >= self.need else [])

    @staticmethod
    def rows(key, found) -> pd.DataFrame:
        columns = {"metric": [key[0]] * len(found), "at_s": [int(a) for a, _ in found], "state": [x for _, x in found]}
        return pd.DataFrame(columns).astype({"metric": "object", "at_s": "int64", "state": "object"})


def alarm_stream(buckets: DataFrame, rule: AlarmRule) -> DataFrame:
    """(metric, at, state): transitions to ALARM and back to OK, as they become known.

    ``buckets`` streams the rows of ``bucket_values`` from the table they are appended to, without a
    limit on files per micro-batch: what one batch appended is then read together, and no bucket
    comes behind the time that another metric's bucket has set.

    A bucket without rows counts as not breaching. It is noticed when the metric's next bucket
    completes, or, if the metric stays silent, when any metric completes a later bucket. Only
    metrics whose last bucket breaches have state.
    """
    steps = buckets.withWatermark("period", "0 seconds").select(
        "metric", "period", F.unix_seconds("period").alias("period_s"), breaches(rule, F.col("value")).alias("breach")
    )
    out = steps.groupBy("metric").transformWithStateInPandas(
        _Alarm(rule.period_seconds, rule.periods), "metric string, at_s long, state string", "append", "EventTime"
    )
    return out.select("metric", F.timestamp_seconds("at_s").cast("timestamp_ntz").alias("at"), "state")


class _Retrain(_Timed):
    fields = "seen long, last long, newest long"

    def __init__(self, min_rows: int, gap: int, forget: int | None):
        self.min_rows, self.gap, self.forget = min_rows, gap, forget

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen, last, newest = self.value.get() if self.value.exists() else (0, None, None)
        signals = []
        hours = _in_order(rows, "hour_s")
        for at, n, critical in zip(hours["hour_s"], hours["n_rows"], hours["critical"]):
            if self.forget is not None and newest is not None and at > newest + self.forget:
                seen, last = 0, None
            seen, newest = seen + int(n), int(at)
            if critical and seen >= self.min_rows and (last is None or at >= last + self.gap):
                last = int(at)
                signals.append(last)
        self.value.update((int(seen), last, newest))
        if self.forget is not None:
            self.wake(newest + self.forget + 1)
        columns = {"model": [key[0]] * len(signals), "at_s": signals}
        yield pd.DataFrame(columns).astype({"model": "object", "at_s": "int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.value.clear()
        return iter([])


def retrain_stream(
    hourly: DataFrame,
    min_rows: int = S.MIN_ROWS_FOR_RETRAIN,
    cooldown_hours: int = S.RETRAIN_COOLDOWN_HOURS,
    forget_hours: int | None = None,
) -> DataFrame:
    """(model, signal_at) with row minimum and cool-down, from a stream of ``hourly_activity``.

    With ``forget_hours`` (at least the cool-down) a model that stays silent for longer leaves no
    state and counts its rows anew when it returns, as ``retrain_signals`` does with the same value.
    """
    check_forget(cooldown_hours, forget_hours)
    forget = None if forget_hours is None else forget_hours * 3600
    hours = hourly.withWatermark("hour", "0 seconds").select(
        "model", "hour", F.unix_seconds("hour").alias("hour_s"), "n_rows", "critical"
    )
    out = hours.groupBy("model").transformWithStateInPandas(
        _Retrain(min_rows, cooldown_hours * 3600, forget), "model string, at_s long", "append", "EventTime"
    )
    return out.select("model", F.timestamp_seconds("at_s").cast("timestamp_ntz").alias("signal_at"))
