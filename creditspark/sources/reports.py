"""Nested reports and flat metric files as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def report_name(run_id, timestamp):
    """``report_<first 8 of the run id>_<date>``."""
    return F.concat(F.lit("report_"), F.substring(run_id, 1, 8), F.lit("_"), F.substring(timestamp, 1, 10))


def save_reports(reports: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON line per report, in a folder per report name."""
    named = reports.withColumn("report", report_name(F.col("run_id"), F.col("timestamp")))
    named.write.mode(mode).partitionBy("report").json(path)


def load_reports(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def save_metrics(metrics: DataFrame, path: str) -> None:
    """A metric table (usually one row) as one JSON file."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
