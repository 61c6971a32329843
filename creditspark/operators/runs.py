"""Experiment runs and model versions: leaderboard, comparison, gate, champion, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from creditspark import schema as S
from creditspark.errors import PromotionError
from creditspark.functions.loan import iso_timestamp, promotion_reason
from creditspark.operators.skew import salted_join


def leaderboard(runs: DataFrame, metric: str = "test_auc_roc", n: int = 10) -> DataFrame:
    """The best runs; equal metrics are ordered by run id."""
    return runs.orderBy(F.col(metric).desc(), "run_id").limit(n)


def model_comparison(runs: DataFrame, metric: str = "test_auc_roc") -> DataFrame:
    return runs.groupBy("model_name").agg(
        F.avg(metric).alias("mean"), F.max(metric).alias("max"), F.stddev_samp(metric).alias("std")
    )


def best_trial(runs: DataFrame, metric: str = "val_auc_roc", by: list[str] | None = None) -> DataFrame:
    """The run with the highest metric; of equal ones the smallest run id."""
    rest = [c for c in runs.columns if c not in ("run_id", metric, *(by or []))]
    packed = runs.select(*(by or []), F.struct(*[F.col(c) for c in ("run_id", *rest, metric)]).alias("row"), metric, "run_id")
    best = F.min_by("row", F.struct(-F.col(metric), F.col("run_id")))
    return packed.groupBy(*(by or [])).agg(best.alias("row")).select(*(by or []), "row.*")


def promotion_gate(runs: DataFrame, threshold: float = S.PROMOTION_AUC, metric: str = "test_auc_roc") -> DataFrame:
    """Adds ``promoted`` and the reason in words."""
    return runs.withColumn("promoted", F.coalesce(F.col(metric) >= threshold, F.lit(False))).withColumn(
        "promotion_reason", promotion_reason(F.col(metric), threshold)
    )


def require_gate(test_auc: float, threshold: float = S.PROMOTION_AUC) -> None:
    if test_auc < threshold:
        raise PromotionError(f"test AUC {test_auc:.4f} is below {threshold:.4f}")


def champions(versions: DataFrame) -> DataFrame:
    """Every approved version with its status: the newest per group leads, the rest rest.

    The newest is found with a map-side-combined aggregate, not by ordering a group.
    """
    approved = versions.filter(F.col("approval") == "Approved")
    newest = approved.groupBy("model_name").agg(F.max(F.struct("created", "version")).alias("_top"))
    return (
        salted_join(approved, newest, ["model_name"], "inner")
        .withColumn(
            "status",
            F.when(F.struct("created", "version") == F.col("_top"), "champion").otherwise("archived"),
        )
        .drop("_top")
    )


def list_versions(versions: DataFrame, n: int = 20) -> DataFrame:
    """The newest ``n`` versions."""
    return versions.orderBy(F.col("created").desc(), F.col("version").desc()).limit(n)


def as_run_table(runs: DataFrame, params: list[str], metrics: list[str]) -> DataFrame:
    """Runs with their parameters and metrics as maps."""
    return runs.select(
        "run_id",
        "model_name",
        "created",
        F.create_map(*[x for p in params for x in (F.lit(p), F.col(p).cast("string"))]).alias("params"),
        F.create_map(*[x for m in metrics for x in (F.lit(m), F.col(m).cast("double"))]).alias("metrics"),
    )


def flatten_runs(table: DataFrame, params: list[str], metrics: list[str]) -> DataFrame:
    """Run table with one column per named parameter and metric; absent ones are null."""
    return table.select(
        "run_id",
        "model_name",
        "created",
        *[F.try_element_at("params", F.lit(p)).alias(p) for p in params],
        *[F.try_element_at("metrics", F.lit(m)).alias(m) for m in metrics],
    )


def metric_map(metrics: DataFrame) -> DataFrame:
    """A one-row metric table as a one-column map."""
    pairs = [x for c in metrics.columns for x in (F.lit(c), F.col(c).cast("double"))]
    return metrics.select(F.create_map(*pairs).alias("m"))


def evaluation_report(
    run: DataFrame,
    val_metrics: DataFrame,
    test_metrics: DataFrame,
    slices: DataFrame,
    impact: DataFrame,
    top_features: DataFrame,
    threshold: float,
    gate: float = S.PROMOTION_AUC,
) -> DataFrame:
    """The nested evaluation row of one run.

    ``run`` has (run_id, model_name, created, params); metric tables have one row; the
    slice, impact and factor tables one row per audit value, column or feature.
    """

    def listed(df: DataFrame):
        return df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias("l")).scalar()

    return (
        run.select("run_id", "model_name", iso_timestamp(F.col("created")).alias("timestamp"), "params")
        .withColumn("val_metrics", metric_map(val_metrics).scalar())
        .withColumn("test_metrics", metric_map(test_metrics).scalar())
        .withColumn("threshold", F.lit(float(threshold)))
        .withColumn("top_features", listed(top_features))
        .withColumn("slice_metrics", listed(slices))
        .withColumn("disparate_impact", listed(impact))
        .withColumn("_auc", F.col("test_metrics")["auc_roc"])
        .withColumn("promoted", F.coalesce(F.col("_auc") >= gate, F.lit(False)))
        .withColumn("promotion_reason", promotion_reason(F.col("_auc"), gate))
        .drop("_auc")
    )
