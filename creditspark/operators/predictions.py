"""Prediction log: label backfill, delayed-label joins, live AUC, metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creditspark import schema as S
from creditspark.functions.numeric import round_report
from creditspark.operators.curve import auc_columns, score_curve
from creditspark.operators.skew import salted_join


def label_rows(labels: DataFrame, id_col: str = "loan_id", label_col: str = "loan_default") -> DataFrame:
    """Label feed as (loan_id, actual_default)."""
    return labels.select(F.col(id_col).alias("loan_id"), F.col(label_col).cast("int").alias("actual_default"))


def latest_labels(
    labels: DataFrame, ts: str, id_col: str = "loan_id", label_col: str = "loan_default"
) -> DataFrame:
    """One label per id: the latest; of several at the same time, the largest."""
    newest = F.max(F.struct(F.col(ts), F.col(label_col).cast("int").alias("y")))
    return labels.groupBy(F.col(id_col).alias("loan_id")).agg(newest.alias("m")).select(
        "loan_id", F.col("m.y").alias("actual_default")
    )


def backfill(log: DataFrame, labels: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Log with labels filled in; a new label wins over the one already there.

    ``labels`` holds (loan_id, actual_default). Where an id has several label rows, each
    gives a row, so pass ``latest_labels`` to keep one row per prediction.
    """
    fresh = labels.select("loan_id", F.col("actual_default").alias("_new"))
    return (
        salted_join(log, fresh, ["loan_id"], "left", hot_rows)
        .withColumn("actual_default", F.coalesce("_new", "actual_default"))
        .drop("_new")
        .select(*log.columns)
    )


def matched_labels(log: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: label rows whose id was predicted, and the number of such ids."""
    known = labels.select("loan_id").join(log.select("loan_id"), "loan_id", "left_semi")
    per_id = known.groupBy("loan_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_label_rows"), F.count(F.lit(1)).alias("n_ids")
    )


def delayed_label_join(
    log: DataFrame, labels: DataFrame, min_days: int = 30, max_days: int = 90, how: str = "left"
) -> DataFrame:
    """Predictions with the labels that arrived ``min_days`` to ``max_days`` later."""
    p, y = log.alias("p"), labels.select(F.col("loan_id").alias("label_id"), F.col("loan_default").alias("label"), "label_ts").alias("y")
    within = (
        (F.col("loan_id") == F.col("label_id"))
        & (F.col("label_ts") >= F.col("ts") + F.make_dt_interval(F.lit(min_days)))
        & (F.col("label_ts") <= F.col("ts") + F.make_dt_interval(F.lit(max_days)))
    )
    return p.join(y, within, how).drop("label_id")


def bucketed_label_join(
    log: DataFrame, labels: DataFrame, min_days: int = 30, max_days: int = 90, how: str = "left", bucket_days: int = 15
) -> DataFrame:
    """``delayed_label_join`` by id and stretch of ``bucket_days``, for ids that hold much of the log.

    A prediction lies in one stretch of time; a label is copied to each that its window touches,
    (max_days - min_days) / bucket_days + 2 at most. So the join is on equal keys, and the rows of
    one id are spread over as many keys as its predictions span stretches.
    """
    width = bucket_days * 86_400
    stretch = lambda t: F.floor(F.unix_seconds(t.cast("timestamp")) / width)
    p = log.withColumn("_stretch", stretch(F.col("ts")))
    y = labels.select(F.col("loan_id").alias("label_id"), F.col("loan_default").alias("label"), "label_ts").where("label_id is not null and label_ts is not null")
    earliest, latest = (F.col("label_ts") - F.make_dt_interval(F.lit(d)) for d in (max_days, min_days))
    y = y.withColumn("_at", F.explode(F.sequence(stretch(earliest), stretch(latest))))
    within = (
        (F.col("loan_id") == F.col("label_id"))
        & (F.col("_stretch") == F.col("_at"))
        & (F.col("label_ts") >= F.col("ts") + F.make_dt_interval(F.lit(min_days)))
        & (F.col("label_ts") <= F.col("ts") + F.make_dt_interval(F.lit(max_days)))
    )
    return p.join(y, within, how).drop("label_id", "_stretch", "_at")


def _reason(n_labeled: Column, n_pos: Column, min_samples: int) -> Column:
    return (
        F.when(
            n_labeled < min_samples,
            F.concat(F.lit("Insufficient labeled samples: "), n_labeled.cast("string"), F.lit(f" < {min_samples}")),
        )
        .when((n_pos == 0) | (n_pos == n_labeled), F.lit("Only one class present in labeled data"))
    )


def live_auc(
    log: DataFrame,
    min_samples: int = S.MIN_LABELED,
    by: list[str] | None = None,
    large_group: int | None = None,
) -> DataFrame:
    """AUC over the labelled part of the log, or null with the reason.

    Columns: ``by``, live_auc (4 decimals), n_labeled, n_total, model_versions, reason.
    """
    by = list(by or [])
    labeled = F.col("actual_default").isNotNull()
    sizes = log.groupBy(*by).agg(
        F.count_if(labeled).alias("n_labeled"),
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("actual_default") == 1).alias("_pos"),
        F.array_sort(F.collect_set(F.when(labeled, F.col("model_version")))).alias("model_versions"),
    )
    curve = score_curve(log, "default_probability", "actual_default", by, large_group)
    ranked = curve.groupBy(*by).agg(auc_columns()["auc_roc"].alias("_auc"))
    if by:
        renamed = ranked.withColumnsRenamed({b: f"_by_{b}" for b in by})
        joined = sizes.join(renamed, [F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by], "left")
    else:
        joined = sizes.withColumn("_auc", ranked.scalar())
    reason = _reason(F.col("n_labeled"), F.col("_pos"), min_samples)
    return joined.withColumn("reason", reason).select(
        *by,
        F.when(F.col("reason").isNull(), round_report(F.col("_auc"), 4)).alias("live_auc"),
        "n_labeled",
        "n_total",
        "model_versions",
        "reason",
    )


def metric_row(name: str, value: Column, unit: str = "None", dims: dict[str, Column] | None = None) -> Column:
    """One long metric record: name, dimensions, value, unit."""
    pairs = [x for k, c in (dims or {}).items() for x in (F.lit(k), c)]
    dimensions = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return F.struct(
        F.lit(name).alias("metric"),
        dimensions.alias("dims"),
        value.cast("double").alias("value"),
        F.lit(unit).alias("unit"),
    )


def prediction_metrics(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Three metric rows per prediction: count by decision and tier, latency, probability."""
    rows = F.array(
        metric_row("PredictionCount", F.lit(1), "Count", {"Decision": F.col("decision"), "RiskTier": F.col("risk_tier")}),
        metric_row("PredictionLatency", F.col("latency_ms"), "Milliseconds"),
        metric_row("DefaultProbability", F.col("probability")),
    )
    return events.select(F.col(ts).alias("ts"), F.explode(rows).alias("m")).select("ts", "m.*")


def psi_metrics(psi: DataFrame) -> DataFrame:
    row = metric_row("PSI", F.col("psi"), dims={"Feature": F.col("feature")})
    return psi.filter(F.col("psi").isNotNull()).select(row.alias("m")).select("m.*")


def live_auc_metrics(auc: DataFrame) -> DataFrame:
    return auc.filter(F.col("live_auc").isNotNull()).select(metric_row("LiveAUC", F.col("live_auc")).alias("m")).select("m.*")
