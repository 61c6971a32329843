"""Running totals in value order, without ordering the whole table in one task.

Everything rank-like here (AUC, KS, quantiles, earth-mover distance, mid-ranks) is read
off one table: the distinct values of each group with their counts and the counts up to
and including each value.

1. Equal values are counted together (map-side combine), so a value holding a large part
   of the rows becomes one row.
2. A group with many distinct values is cut into ranges at approximate quantiles. Groups
   below ``LARGE_GROUP`` distinct values stay whole.
3. Totals per range are accumulated over the ranges (few rows), and each range adds its
   own running totals. No task sees more than one range of one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from creditspark.functions.numeric import count_reached, null_if_nan
from creditspark.operators.skew import salted_join

LARGE_GROUP = 200_000


MAX_RANGES = 2_000


def _n_ranges(df: DataFrame) -> int:
    """A few ranges per shuffle partition; bounded, since the cut points travel as one array."""
    return min(4 * max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), MAX_RANGES)


def value_counts(df: DataFrame, value: str, measures: dict[str, Column], by: list[str]) -> DataFrame:
    """Distinct values per group with the summed measures; missing values are left out."""
    v = null_if_nan(F.col(value).cast("double"))
    return (
        df.select(*by, v.alias("value"), *[m.alias(k) for k, m in measures.items()])
        .filter(F.col("value").isNotNull())
        .groupBy(*by, "value")
        .agg(*[F.sum(k).alias(k) for k in measures])
    )


def _with_range(counts: DataFrame, by: list[str], large_group: int) -> DataFrame:
    n = _n_ranges(counts)
    # The measures take part in the size so that this branch reads the same
    # exchanged counts as the main one, and Spark runs that shuffle once.
    measures = [c for c in counts.columns if c not in (*by, "value")]
    present = F.greatest(*[F.sum(m) for m in measures], F.lit(0)) if len(measures) > 1 else F.sum(measures[0])
    cuts = F.percentile_approx("value", [i / n for i in range(1, n)], F.lit(10 * n))
    cuts = F.when((F.count(F.lit(1)) > large_group) & (present >= 0), cuts)
    if not by:
        cut = counts.withColumn("_cuts", counts.agg(cuts.alias("c")).scalar())
    else:
        per_group = counts.groupBy(*by).agg(cuts.alias("_cuts")).filter(F.col("_cuts").isNotNull())
        renamed = per_group.select(*[F.col(b).alias(f"_by_{b}") for b in by], "_cuts")
        match = [F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by]
        cut = counts.join(renamed, match, "left").drop(*[f"_by_{b}" for b in by])
    found = F.coalesce(count_reached(F.col("_cuts"), n - 1, F.col("value")), F.lit(0))
    return cut.withColumn("_range", found).drop("_cuts")


def running_totals(
    df: DataFrame,
    value: str,
    measures: dict[str, Column],
    by: list[str] | None = None,
    large_group: int | None = None,
) -> DataFrame:
    """Per group and distinct value: each measure, its running and group total, next value.

    Columns: ``by``, ``value``, ``m``, ``cum_m`` (inclusive), ``total_m`` for each
    measure ``m``, and ``next_value``.
    """
    by = list(by or [])
    counts = _with_range(value_counts(df, value, measures, by), by, large_group or LARGE_GROUP)
    ranges = counts.groupBy(*by, "_range").agg(
        F.min("value").alias("_first"), *[F.sum(m).alias(f"_sum_{m}") for m in measures]
    )
    upto = Window.partitionBy(*by).orderBy("_range")
    whole = Window.partitionBy(*by)
    offsets = ranges.select(
        *[F.col(b).alias(f"_by_{b}") for b in by],
        F.col("_range").alias("_at"),
        F.lead("_first").over(upto).alias("_next_first"),
        *[
            (F.sum(f"_sum_{m}").over(upto.rowsBetween(Window.unboundedPreceding, 0)) - F.col(f"_sum_{m}")).alias(f"_off_{m}")
            for m in measures
        ],
        *[F.sum(f"_sum_{m}").over(whole).alias(f"total_{m}") for m in measures],
    )
    inner = Window.partitionBy(*by, "_range").orderBy("value")
    local = counts.select(
        "*",
        F.lead("value").over(inner).alias("_local_next"),
        *[
            F.sum(m).over(inner.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_cum_{m}")
            for m in measures
        ],
    )
    match = [F.col("_range") == F.col("_at")] + [F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by]
    return local.join(offsets, match).select(
        *by,
        "value",
        *measures,
        *[(F.col(f"_cum_{m}") + F.col(f"_off_{m}")).alias(f"cum_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
        F.coalesce("_local_next", "_next_first").alias("next_value"),
    )


def score_curve(
    df: DataFrame, score: str, label: str, by: list[str] | None = None, large_group: int | None = None
) -> DataFrame:
    """Running positives and negatives by score (the ROC and class-CDF table).

    ``label`` is 1 for positives and 0 for negatives; rows without label are left out.
    """
    y = F.col(label)
    return running_totals(
        df.filter(y.isNotNull()),
        score,
        {"pos": F.when(y == 1, 1).otherwise(0).cast("long"), "neg": F.when(y == 1, 0).otherwise(1).cast("long")},
        by,
        large_group,
    )


def auc_columns() -> dict[str, Column]:
    """Aggregates over a score curve; the AUC is null when a class is empty."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    pairs = F.max("total_pos").cast("double") * F.max("total_neg").cast("double")
    wins = F.sum(pos * (F.col("cum_neg").cast("double") - neg / 2))
    gap = F.abs(
        F.col("cum_pos").cast("double") / F.col("total_pos") - F.col("cum_neg").cast("double") / F.col("total_neg")
    )
    both = (F.col("total_pos") > 0) & (F.col("total_neg") > 0)
    return {
        "auc_roc": F.try_divide(wins, pairs),
        "ks_statistic": F.coalesce(F.max(F.when(both, gap)), F.lit(0.0)),
        "n_positives": F.max("total_pos"),
        "n_samples": F.max(F.col("total_pos") + F.col("total_neg")),
    }


def rank_metrics(
    df: DataFrame, score: str, label: str, by: list[str] | None = None, large_group: int | None = None
) -> DataFrame:
    """AUC (ties count half), Gini and KS per group, from one score curve."""
    curve = score_curve(df, score, label, by, large_group)
    out = curve.groupBy(*(by or [])).agg(*[c.alias(k) for k, c in auc_columns().items()])
    return out.withColumn("gini", F.col("auc_roc") * 2 - 1)


def score_ranks(
    df: DataFrame,
    score: str,
    by: list[str] | None = None,
    large_group: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Every row with the mid-rank of its score within its group (null without score)."""
    by = list(by or [])
    curve = running_totals(df, score, {"n": F.lit(1).cast("long")}, by, large_group)
    key = df.withColumn("value", null_if_nan(F.col(score).cast("double")))
    ranks = curve.select(
        *by, "value", (F.col("cum_n") - (F.col("n") - 1).cast("double") / 2).alias("mid_rank")
    )
    counts = value_counts(df, score, {"n": F.lit(1).cast("long")}, by)
    return salted_join(key, ranks, [*by, "value"], "left", hot_rows, counts).drop("value")


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    by: list[str] | None = None,
    large_group: int | None = None,
) -> DataFrame:
    """Exact quantiles per group, interpolated between neighbouring values.

    Also returns ``n`` and ``mean``. The values are never gathered per group.
    """
    curve = running_totals(df, value, {"n": F.lit(1).cast("long")}, by, large_group)
    last = (F.col("total_n") - 1).cast("double")
    picks = []
    for name, q in probabilities.items():
        at = last * F.lit(q)
        picks.append(F.min(F.when(F.col("cum_n") > F.floor(at), F.col("value"))).alias(f"_{name}_lo"))
        picks.append(F.min(F.when(F.col("cum_n") > F.ceil(at), F.col("value"))).alias(f"_{name}_hi"))
    out = curve.groupBy(*(by or [])).agg(
        F.max("total_n").alias("n"),
        (F.sum(F.col("value") * F.col("n")) / F.max("total_n")).alias("mean"),
        *picks,
    )
    for name, q in probabilities.items():
        at = (F.col("n") - 1).cast("double") * F.lit(q)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out = out.withColumn(name, low + (high - low) * (at - F.floor(at)))
    return out.select(*(by or []), "n", "mean", *probabilities)
