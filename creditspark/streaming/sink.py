"""Metrics of a stream of predictions, appended to one long table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditspark.operators.predictions import live_auc, live_auc_metrics, metric_row, prediction_metrics
from creditspark.streaming.drift import psi_by_time
from creditspark.streaming.run import run_batches

METRICS = "metric string, dims map<string,string>, value double, unit string, ts timestamp, batch bigint"


def batch_metrics(batch: DataFrame, histogram: DataFrame | None = None, features: list[str] | None = None, label: str | None = None) -> DataFrame:
    """(metric, dims, value, unit, ts) of one batch of predictions (ts, decision, risk_tier, latency_ms, probability).

    Three rows a prediction; with a reference histogram the PSI of each feature and hour of the batch;
    with a label column the AUC of the batch's labelled predictions, where there are enough.
    """
    columns = ["metric", "dims", "value", "unit", "ts"]
    out = prediction_metrics(batch).select(*columns)
    if histogram is not None:
        psi = psi_by_time(batch, histogram, features or [])
        row = metric_row("PSI", F.col("psi"), dims={"Feature": F.col("feature")})
        out = out.unionByName(psi.select(row.alias("m"), F.col("window_start").cast("timestamp").alias("ts")).select("m.*", "ts"))
    if label is not None:
        log = batch.select(F.col("probability").alias("default_probability"), F.col(label).cast("int").alias("actual_default"), F.lit("").alias("model_version"))
        newest = batch.agg(F.max("ts")).scalar()
        out = out.unionByName(live_auc_metrics(live_auc(log)).withColumn("ts", newest).select(*columns))
    return out


def emit_metrics(stream: DataFrame, path: str, histogram: DataFrame | None = None, features: list[str] | None = None, label: str | None = None) -> None:
    """Run the stream over the data at hand; a micro-batch's metrics replace the folder of its number, so a repeat changes nothing."""
    run_batches(stream, lambda batch, batch_id: write_metrics(batch_metrics(batch, histogram, features, label), path, batch_id), "metrics")


def write_metrics(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).parquet(path)
