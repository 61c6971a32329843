"""Table shape, rates by band, correlations with the target, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creditspark import schema as S
from creditspark.functions.loan import score_band
from creditspark.functions.numeric import bin_index, null_if_nan


def default_rate_by_band(df: DataFrame, labels: list[str] | None = None) -> DataFrame:
    band = score_band(F.col("credit_score"), labels=labels or S.SCORE_BAND_LABELS, outside=None)
    return (
        df.withColumn("credit_band", band)
        .filter(F.col("credit_band").isNotNull())
        .groupBy("credit_band")
        .agg(F.avg(S.TARGET_COLUMN).alias("default_rate"), F.count(S.TARGET_COLUMN).alias("count"))
    )


def table_profile(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.avg(S.TARGET_COLUMN).alias("default_rate"),
    )


def target_correlations(df: DataFrame, features: list[str], target: str = S.TARGET_COLUMN) -> DataFrame:
    """Pearson correlation of each feature with the target, ascending, in one pass."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in features])
    return wide.unpivot([], features, "feature", "correlation").orderBy("correlation")


def stack_rows(columns: dict[str, Column], name: str, value: str) -> Column:
    """One (name, value) struct per column, ready to explode."""
    return F.explode(
        F.array(*[F.struct(F.lit(k).alias(name), c.alias(value)) for k, c in columns.items()])
    )


def long_values(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, position, value): one row per column, NaN as null."""
    values = F.array(*[null_if_nan(F.col(c).cast("double")) for c in columns])
    return df.select(*keep, F.posexplode(values).alias("position", "value"))


def value_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with ``lows`` and ``highs``: min and max of every column as arrays."""
    v = [null_if_nan(F.col(c).cast("double")) for c in columns]
    return df.agg(F.array(*[F.min(c) for c in v]).alias("lows"), F.array(*[F.max(c) for c in v]).alias("highs"))


def binned(long: DataFrame, ranges: DataFrame, n_bins: int) -> DataFrame:
    """Long values with their equal-width ``bin``; ``ranges`` is one row, read as a subquery."""
    r = ranges.select(F.struct("lows", "highs").alias("r")).scalar()
    i = F.col("position")
    placed = long.withColumn("_r", r).select(
        *long.columns, F.get(F.col("_r.lows"), i).alias("_low"), F.get(F.col("_r.highs"), i).alias("_high")
    )
    step = (F.col("_high") - F.col("_low")) / n_bins
    return placed.withColumn("bin", bin_index(F.col("value"), F.col("_low"), step, n_bins)).drop("_low", "_high")


def named_position(columns: list[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in columns]), F.col("position")).alias("feature")


def histogram(df: DataFrame, columns: list[str], n_bins: int = 40) -> DataFrame:
    """(feature, bin, bin_low, bin_high, n): equal-width counts, empty bins included.

    Two passes, the second with one small shuffle of at most bins x columns rows. A
    constant column gets a range of one around its value.
    """
    low, high = F.get("lows", F.col("position")), F.get("highs", F.col("position"))
    pad = F.when(low == high, 0.5).otherwise(0.0)
    per_column = value_ranges(df, columns).select("lows", "highs", F.posexplode("lows").alias("position", "_"))
    padded = per_column.select("position", (low - pad).alias("low"), (high + pad).alias("high"))
    ranges = padded.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "low"))), lambda s: s["low"]).alias("lows"),
        F.transform(F.array_sort(F.collect_list(F.struct("position", "high"))), lambda s: s["high"]).alias("highs"),
    )
    counts = (
        binned(long_values(df, columns), ranges, n_bins)
        .filter(F.col("value").isNotNull())
        .groupBy("position", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    step = (F.col("high") - F.col("low")) / n_bins
    grid = padded.filter(F.col("low").isNotNull()).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin")
    )
    return grid.join(counts, ["position", "bin"], "left").select(
        named_position(columns),
        "bin",
        (F.col("low") + F.col("bin") * step).alias("bin_low"),
        F.when(F.col("bin") == n_bins - 1, F.col("high")).otherwise(F.col("low") + (F.col("bin") + 1) * step).alias("bin_high"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )
