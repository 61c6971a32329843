"""Time-bucketed monitoring. Each function takes a batch table or a stream.

A stream gets a watermark and appends a bucket once it is complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creditspark.operators.curve import quantiles

WATERMARK = "10 minutes"


def timed(rows: DataFrame, ts: str = "ts", watermark: str = WATERMARK) -> DataFrame:
    return rows.withWatermark(ts, watermark) if rows.isStreaming else rows


def bucket(width: str, ts: str = "ts") -> Column:
    return F.window(ts, width).alias("w")


def started(df: DataFrame, *columns) -> DataFrame:
    """Buckets named by their start, as a plain date-time."""
    return df.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *columns)


def prediction_volume(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Predictions per bucket, decision and tier."""
    counts = timed(events).groupBy(bucket(width), "decision", "risk_tier").agg(F.count(F.lit(1)).alias("n_predictions"))
    return started(counts, "decision", "risk_tier", "n_predictions")


def value_stats(events: DataFrame, value: str, quantile: float, width: str = "5 minutes") -> DataFrame:
    """(window_start, n, mean, q): mean and a high quantile per bucket.

    The quantile is exact and interpolated. On a table it comes from the score-curve
    machinery, so that a bucket holding much of the data is still shared among tasks. A
    stream first counts by bucket and value, so that such a bucket is counted in many tasks;
    its quantile is taken from those counts when the bucket closes. There, a bucket is named by
    its last instant: each value's row in the state and the shuffle holds one time, not two and a
    struct around them.
    """
    if not events.isStreaming:
        keyed = events.select(F.window("ts", width)["start"].alias("_start"), value)
        out = quantiles(keyed, value, {"q": quantile}, ["_start"])
        return out.select(F.col("_start").cast("timestamp_ntz").alias("window_start"), "n", "mean", "q")
    placed = timed(events).select(bucket(width), F.col(value).alias("v")).select(F.window_time("w").alias("at"), "v")
    counts = placed.groupBy("at", "v").agg(F.count(F.lit(1)).alias("k"))
    known = F.when(F.col("v").isNotNull(), F.col("k"))
    out = counts.groupBy("at").agg(
        F.coalesce(F.sum(known), F.lit(0)).alias("n"),
        (F.sum(F.col("v") * F.col("k")) / F.sum(known)).alias("mean"),
        F.percentile("v", quantile, F.col("k")).alias("q"),
    )
    return started(out.select(bucket(width, "at"), "n", "mean", "q"), "n", "mean", "q")


def latency(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    return value_stats(events, "latency_ms", 0.99, width).withColumnsRenamed({"mean": "avg_latency", "q": "p99_latency"})


def probability(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    return value_stats(events, "probability", 0.95, width).withColumnsRenamed({"mean": "avg_probability", "q": "p95_probability"})


def hourly_metrics(rows: DataFrame, width: str = "1 hour") -> DataFrame:
    """(window_start, metric, max_value, avg_value) of long metric rows."""
    out = timed(rows).groupBy(bucket(width), "metric").agg(F.max("value").alias("max_value"), F.avg("value").alias("avg_value"))
    return started(out, "metric", "max_value", "avg_value")


def error_rate(events: DataFrame, width: str = "1 minute") -> DataFrame:
    """100 x errors / max(errors, requests) per bucket."""
    errors, requests = F.count_if("is_error"), F.count_if(~F.col("is_error"))
    out = timed(events).groupBy(bucket(width)).agg(errors.alias("errors"), requests.alias("requests"))
    rate = F.try_divide(F.col("errors") * 100.0, F.greatest("errors", "requests").cast("double"))
    return started(out, "errors", "requests", rate.alias("error_rate"))
