"""Classification metrics, class balance and threshold calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from creditspark.functions.numeric import count_reached, safe_ratio
from creditspark.operators.curve import rank_metrics

# --- fixed values: the calibration grid, as the usual arange(0.1, 0.9, 0.01) ---
GRID_START, GRID_STEP, GRID_POINTS = 0.1, 0.01, 80
# ------------------------------------------------------------------------------


def threshold_values() -> list[float]:
    """The 80 grid points; the step is the rounded difference of the first two."""
    step = (GRID_START + GRID_STEP) - GRID_START
    return [GRID_START + i * step for i in range(GRID_POINTS)]


def fbeta(tp: Column, fp: Column, fn: Column, beta: float) -> Column:
    """F-beta of counts; 0 when there is nothing to divide by."""
    b2 = float(beta) ** 2
    num = tp * F.lit(1 + b2)
    return safe_ratio(num, num + fn * F.lit(b2) + fp)


def confusion_counts(df: DataFrame, score: str, label: str, threshold: float, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn and n per group in one aggregation."""
    hit, yes = F.col(score) >= threshold, F.col(label) == 1
    return (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*(by or []))
        .agg(
            F.count_if(hit & yes).alias("tp"),
            F.count_if(hit & ~yes).alias("fp"),
            F.count_if(~hit & yes).alias("fn"),
            F.count_if(~hit & ~yes).alias("tn"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def classification_metrics(
    df: DataFrame, score: str, label: str, threshold: float = 0.5, large_group: int | None = None
) -> DataFrame:
    """One row with the eleven metrics; AUC, Gini and KS share one score curve."""
    counts = confusion_counts(df, score, label, threshold)
    ranked = rank_metrics(df, score, label, large_group=large_group)
    ranks = ranked.agg(F.struct(F.max("auc_roc").alias("auc_roc"), F.max("gini").alias("gini"), F.max("ks_statistic").alias("ks_statistic")).alias("r"))
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n"))
    return counts.withColumn("r", ranks.scalar()).select(
        "r.auc_roc",
        "r.gini",
        "r.ks_statistic",
        fbeta(tp, fp, fn, 1.0).alias("f1"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(tp + tn, n).alias("accuracy"),
        F.lit(float(threshold)).alias("threshold"),
        n.alias("n_samples"),
        (tp + fn).alias("n_positives"),
        safe_ratio(tp + fn, n).alias("positive_rate"),
    )


def class_imbalance(df: DataFrame, label: str) -> DataFrame:
    """n_neg / n_pos; the query fails where there is no positive row."""
    pos = F.sum(label)
    out = df.agg((F.count(label) - pos).alias("n_neg"), pos.alias("n_pos"))
    ratio = F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos"))
    return out.withColumn(
        "scale_pos_weight", F.coalesce(ratio, F.raise_error(F.lit("no positive rows")).cast("double"))
    )


def threshold_table(df: DataFrame, score: str, label: str, beta: float = 2.0) -> DataFrame:
    """Confusion counts and F-beta at every grid threshold, from one pass over the rows.

    A row counts for every threshold up to its score, so rows are counted once per
    grid cell (at most 81) and the counts accumulated from the top.
    """
    spark: SparkSession = df.sparkSession
    values = threshold_values()
    grid = spark.range(GRID_POINTS).select(
        F.col("id").cast("int").alias("i"), F.get(F.array(*[F.lit(v) for v in values]), F.col("id").cast("int")).alias("threshold")
    )
    cell = count_reached(F.array(*[F.lit(v) for v in values]), GRID_POINTS, F.col(score))
    cells = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(cell.alias("cell"))
        .agg(F.sum(F.col(label)).alias("pos"), F.sum(1 - F.col(label)).alias("neg"))
    )
    padded = (
        grid.select((F.col("i") + 1).alias("cell"), "threshold")
        .unionByName(spark.range(1).select(F.lit(0).alias("cell"), F.lit(None).cast("double").alias("threshold")))
        .join(cells, "cell", "left")
    )
    from_top = Window.orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    zero = F.lit(0).cast("long")
    return (
        padded.select(
            "cell",
            "threshold",
            F.sum(F.coalesce("pos", zero)).over(from_top).alias("tp"),
            F.sum(F.coalesce("neg", zero)).over(from_top).alias("fp"),
            F.sum(F.coalesce("pos", zero)).over(whole).alias("n_pos"),
        )
        .filter(F.col("threshold").isNotNull())
        .select(
            "threshold",
            "tp",
            "fp",
            (F.col("n_pos") - F.col("tp")).alias("fn"),
            fbeta(F.col("tp"), F.col("fp"), F.col("n_pos") - F.col("tp"), beta).alias("fbeta"),
        )
    )


def calibrate_threshold(df: DataFrame, score: str, label: str, beta: float = 2.0) -> DataFrame:
    """The grid threshold with the highest F-beta; the lowest one wins a tie."""
    best = F.max(F.struct(F.col("fbeta"), (-F.col("threshold")).alias("neg_t")))
    return (
        threshold_table(df, score, label, beta)
        .agg(best.alias("b"))
        .select((-F.col("b.neg_t")).alias("threshold"), F.col("b.fbeta").alias("fbeta"))
    )
