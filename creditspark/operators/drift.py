"""Distribution comparison between a reference and a current table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from creditspark import schema as S
from creditspark.functions.numeric import null_if_nan, round_report
from creditspark.operators.columns import shared_columns
from creditspark.operators.curve import quantiles, running_totals
from creditspark.operators.profile import binned, long_values, named_position, stack_rows, value_ranges

# --- fixed values -------------------------------------------------------------
PSI_BINS = 10
PSI_SMOOTHING = 0.0001
DRIFT_P_VALUE = 0.05
DRIFT_DISTANCE = 0.1
DRIFT_SHARE = 0.5
MIN_STD = 0.001
# ------------------------------------------------------------------------------


def tagged(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Both tables stacked on the given columns, with ``is_ref`` telling them apart."""
    return reference.select(*columns, F.lit(True).alias("is_ref")).unionByName(
        current.select(*columns, F.lit(False).alias("is_ref"))
    )


def binned_counts(reference: DataFrame, current: DataFrame, features: list[str], n_bins: int = PSI_BINS) -> DataFrame:
    """(feature, bin, n_ref, n_cur): rows per equal-width bin over the joint range.

    All features share two passes: one for the ranges, one for the counts. Only
    features x bins rows are exchanged. Missing values fall into the null bin.
    """
    rows = tagged(reference, current, features)
    long = binned(long_values(rows, features, ("is_ref",)), value_ranges(rows, features), n_bins)
    return (
        long.select("is_ref", "position", F.when(F.col("value").isNotNull(), F.col("bin")).alias("bin"))
        .groupBy("position", "bin")
        .agg(F.count_if("is_ref").alias("n_ref"), F.count_if(~F.col("is_ref")).alias("n_cur"))
        .select(named_position(features), "bin", "n_ref", "n_cur")
    )


def psi(
    reference: DataFrame,
    current: DataFrame,
    features: list[str] | None = None,
    n_bins: int = PSI_BINS,
    decimals: int | None = 4,
) -> DataFrame:
    """(feature, psi, reason): population stability index of every feature in both tables.

    Empty bins carry the smoothing term. A feature without values on one side has no
    PSI, and the reason says which side is empty.
    """
    features = shared_columns(reference, current, features or S.NUMERIC_FEATURES)
    counts = binned_counts(reference, current, features, n_bins)
    per_feature = Window.partitionBy("feature")
    binned = F.col("bin").isNotNull()
    with_totals = counts.select(
        "feature",
        "bin",
        "n_ref",
        "n_cur",
        F.sum(F.when(binned, F.col("n_ref")).otherwise(0)).over(per_feature).alias("t_ref"),
        F.sum(F.when(binned, F.col("n_cur")).otherwise(0)).over(per_feature).alias("t_cur"),
    )

    def term(n_ref: Column, n_cur: Column, t_ref: Column, t_cur: Column) -> Column:
        spread = PSI_SMOOTHING * n_bins
        r = (n_ref + F.lit(PSI_SMOOTHING)) / (t_ref + F.lit(spread))
        c = (n_cur + F.lit(PSI_SMOOTHING)) / (t_cur + F.lit(spread))
        return (c - r) * F.log(c / r)

    t_ref, t_cur = F.max("t_ref"), F.max("t_cur")
    filled = F.sum(F.when(binned, term(F.col("n_ref"), F.col("n_cur"), F.col("t_ref"), F.col("t_cur"))))
    empty = (F.lit(n_bins) - F.count("bin")) * term(F.lit(0), F.lit(0), t_ref, t_cur)
    value = F.greatest(filled + empty, F.lit(0.0))
    reason = (
        F.when((t_ref == 0) & (t_cur == 0), "no values").when(t_ref == 0, "no reference values").when(t_cur == 0, "no current values")
    )
    out = with_totals.groupBy("feature").agg(value.alias("psi"), reason.alias("reason"))
    out = out.withColumn("psi", F.when(F.col("reason").isNull(), F.col("psi")))
    return out if decimals is None else out.withColumn("psi", round_report(F.col("psi"), decimals))


def _value_curve(reference: DataFrame, current: DataFrame, features: list[str], large_group: int | None) -> DataFrame:
    rows = tagged(reference, current, features)
    long = long_values(rows, features, ("is_ref",)).select("is_ref", named_position(features), "value")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return running_totals(
        long,
        "value",
        {"ref": F.when(F.col("is_ref"), one).otherwise(none), "cur": F.when(F.col("is_ref"), none).otherwise(one)},
        ["feature"],
        large_group,
    )


def _shares() -> tuple[Column, Column]:
    return (
        F.try_divide(F.col("cum_ref").cast("double"), F.col("total_ref")),
        F.try_divide(F.col("cum_cur").cast("double"), F.col("total_cur")),
    )


def kolmogorov_tail(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """Two-sided large-sample p-value of a two-sample KS statistic."""
    lam = F.sqrt(F.try_divide(n_ref.cast("double") * n_cur, n_ref + n_cur)) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def erfc(z: Column) -> Column:
    """Complementary error function of z >= 0: a power series below 1, a continued fraction from there."""
    root_pi = F.lit(math.sqrt(math.pi))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(40)),
        F.struct(z.alias("t"), z.alias("s")),
        lambda acc, n: F.struct(
            (-acc["t"] * z * z / n).alias("t"), (acc["s"] - acc["t"] * z * z / n / (2 * n + 1)).alias("s")
        ),
    )["s"]
    fraction = F.aggregate(F.sequence(F.lit(400), F.lit(1), F.lit(-1)), z, lambda acc, k: z + k / (2 * acc))
    return F.when(z < 1, 1 - 2 * series / root_pi).otherwise(F.exp(-z * z) / (root_pi * fraction))


def chi_square_tail(statistic: Column, df: Column) -> Column:
    """Upper tail of the chi-square distribution: its closed sum of about df / 2 positive terms, kept as logarithms.

    Nothing is subtracted and no term is left out, so small tails keep their digits at any
    number of degrees. An infinite statistic has tail 0.
    """
    odd = (df % 2).cast("double")
    x = F.least(F.greatest(statistic.cast("double"), F.lit(1e-300)), F.lit(1e300)) / 2
    steps = F.floor(df / 2).cast("int")  # terms x^(j + odd / 2) / gamma(j + 1 + odd / 2), j from 0
    first = F.when(odd == 1, F.log(x) / 2 - F.log(F.lit(math.sqrt(math.pi) / 2))).otherwise(F.lit(0.0)) - x
    none = F.struct(first.alias("t"), F.lit(float("-inf")).alias("s"))

    def add(acc: Column, j: Column) -> Column:
        term = F.when(j == 0, acc["t"]).otherwise(acc["t"] + F.log(x) - F.log(j + odd / 2))
        top = F.greatest(acc["s"], term)
        return F.struct(term.alias("t"), (top + F.log(F.exp(acc["s"] - top) + F.exp(term - top))).alias("s"))

    terms = F.when(steps > 0, F.sequence(F.lit(0), F.greatest(steps, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))
    total = F.exp(F.aggregate(terms, none, add)["s"]) + F.when(odd == 1, erfc(F.sqrt(x))).otherwise(F.lit(0.0))
    return (
        F.when((df <= 0) | (statistic <= 0), F.lit(1.0))
        .when(statistic == float("inf"), F.lit(0.0))
        .otherwise(F.least(total, F.lit(1.0)))
    )


def ks_drift(reference: DataFrame, current: DataFrame, features: list[str], large_group: int | None = None) -> DataFrame:
    """(feature, statistic, p_value, n_ref, n_cur): two-sample Kolmogorov-Smirnov test."""
    ref, cur = _shares()
    out = _value_curve(reference, current, features, large_group).groupBy("feature").agg(
        F.max(F.abs(ref - cur)).alias("statistic"),
        F.max("total_ref").alias("n_ref"),
        F.max("total_cur").alias("n_cur"),
    )
    return out.withColumn("p_value", kolmogorov_tail(F.col("statistic"), F.col("n_ref"), F.col("n_cur")))


def wasserstein_drift(
    reference: DataFrame, current: DataFrame, features: list[str], large_group: int | None = None
) -> DataFrame:
    """(feature, distance, statistic): earth-mover distance, and divided by the reference deviation."""
    ref, cur = _shares()
    gap = F.abs(ref - cur) * (F.col("next_value") - F.col("value"))
    out = _value_curve(reference, current, features, large_group).groupBy("feature").agg(F.sum(gap).alias("distance"))
    spread = reference.agg(
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in features]),
            F.array(*[F.stddev_pop(null_if_nan(F.col(c).cast("double"))) for c in features]),
        ).alias("m")
    ).scalar()
    return (
        out.withColumn("_std", F.try_element_at(spread, F.col("feature")))
        .withColumn("distance", F.coalesce("distance", F.lit(0.0)))
        .select("feature", "distance", (F.col("distance") / F.greatest("_std", F.lit(MIN_STD))).alias("statistic"))
    )


def category_counts(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """(feature, category, n_ref, n_cur, t_ref, t_cur) over the categories of both tables."""
    rows = tagged(reference, current, features)
    counts = (
        rows.select("is_ref", stack_rows({c: F.col(c).cast("string") for c in features}, "feature", "category").alias("s"))
        .select("is_ref", "s.feature", "s.category")
        .filter(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(F.count_if("is_ref").alias("n_ref"), F.count_if(~F.col("is_ref")).alias("n_cur"))
    )
    totals = counts.groupBy("feature").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    return counts.join(totals, "feature")


def categorical_drift(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Chi-square of the current counts against the reference shares, and Jensen-Shannon distance."""
    r, c = F.col("n_ref") / F.col("t_ref"), F.col("n_cur") / F.col("t_cur")
    mid = (r + c) / 2

    def part(share: Column) -> Column:
        return F.when(share > 0, share * F.log(share / mid)).otherwise(0.0)

    expected = r * F.col("t_cur")
    infinite = F.lit(float("inf"))
    cell = F.when(expected > 0, (F.col("n_cur") - expected) * (F.col("n_cur") - expected) / expected).otherwise(infinite)
    counts = category_counts(reference, current, features).filter((F.col("t_ref") > 0) & (F.col("t_cur") > 0))
    out = counts.groupBy("feature").agg(
        F.sum(cell).alias("chi_square"),
        (F.count(F.lit(1)) - 1).alias("degrees"),
        F.sqrt(F.greatest(F.sum(part(r) + part(c)) / 2, F.lit(0.0))).alias("js_distance"),
    )
    return out.withColumn("p_value", chi_square_tail(F.col("chi_square"), F.col("degrees")))


def column_kinds(df: DataFrame, target: str = S.TARGET_COLUMN, id_col: str = S.ID_COLUMN) -> tuple[list[str], list[str]]:
    """Numeric and categorical columns to test; dates and times count as numbers, text, booleans and the target as categories.

    Columns of other types (arrays, maps, structs, binaries) are not tested.
    """
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name == id_col:
            continue
        if f.name == target or isinstance(f.dataType, (T.StringType, T.BooleanType)):
            categorical.append(f.name)
        elif isinstance(f.dataType, (T.NumericType, *_TIMES)):
            numeric.append(f.name)
    return numeric, categorical


_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def comparable(df: DataFrame) -> DataFrame:
    """``df`` with dates and times as seconds and booleans as text, as the tests take them."""
    seconds = {f.name: F.unix_micros(F.col(f.name).cast("timestamp")) / 1e6 for f in df.schema if isinstance(f.dataType, _TIMES)}
    words = {f.name: F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, T.BooleanType)}
    return df.withColumns({**seconds, **words}) if seconds or words else df


def drift_columns(
    reference: DataFrame,
    current: DataFrame,
    numeric_test: str = "wasserstein",
    categorical_test: str = "jensen_shannon",
    p_value: float = DRIFT_P_VALUE,
    distance: float = DRIFT_DISTANCE,
) -> DataFrame:
    """(column_name, kind, test, score, drifted) for every column of both tables."""
    numeric, categorical = column_kinds(reference)
    reference, current = comparable(reference), comparable(current)
    numeric = shared_columns(reference, current, numeric)
    categorical = shared_columns(reference, current, categorical)
    parts = []
    if numeric:
        if numeric_test == "ks":
            num = ks_drift(reference, current, numeric).withColumn("score", F.col("p_value"))
            hit = F.col("score") < p_value
        else:
            num = wasserstein_drift(reference, current, numeric).withColumn("score", F.col("statistic"))
            hit = F.col("score") >= distance
        parts.append(num.select(F.col("feature").alias("column_name"), F.lit("num").alias("kind"), F.lit(numeric_test).alias("test"), "score", hit.alias("drifted")))
    if categorical:
        cat = categorical_drift(reference, current, categorical)
        if categorical_test == "chi_square":
            cat, hit = cat.withColumn("score", F.col("p_value")), F.col("p_value") < p_value
        else:
            cat, hit = cat.withColumn("score", F.col("js_distance")), F.col("js_distance") >= distance
        parts.append(cat.select(F.col("feature").alias("column_name"), F.lit("cat").alias("kind"), F.lit(categorical_test).alias("test"), "score", hit.alias("drifted")))
    out = parts[0]
    return out.unionByName(parts[1]) if len(parts) > 1 else out


def drift_report(columns: DataFrame, drift_share: float = DRIFT_SHARE) -> DataFrame:
    """One row: dataset flag, number and share of drifted columns, columns tested."""
    drifted = F.count_if("drifted")
    tested = F.count(F.lit(1))
    return columns.agg(
        F.coalesce(F.try_divide(drifted.cast("double"), tested) >= drift_share, F.lit(False)).alias("dataset_drift"),
        drifted.alias("drifted_columns"),
        F.coalesce(F.try_divide(drifted.cast("double"), tested), F.lit(0.0)).alias("share_of_drifted_columns"),
        tested.alias("n_features_tested"),
    )


def quality_rates(
    df: DataFrame,
    features: list[str],
    max_null: float = S.MAX_NULL_RATE,
    max_outlier: float = S.MAX_OUTLIER_RATE,
    large_group: int | None = None,
) -> DataFrame:
    """Null and outlier rate per numeric column against the declared limits.

    Outliers lie more than 1.5 interquartile ranges outside the quartiles. The quartiles
    are exact; their table has one row per column.
    """
    long = long_values(df, features).select(named_position(features), "value")
    quartiles = quantiles(long, "value", {"q1": 0.25, "q3": 0.75}, ["feature"], large_group)
    bounds = quartiles.agg(
        F.map_from_entries(F.collect_list(F.struct("feature", F.struct("q1", "q3")))).alias("b")
    ).scalar()
    flags = {}
    for c in features:
        v = null_if_nan(F.col(c).cast("double"))
        q = F.try_element_at(F.col("_b"), F.lit(c))
        reach = (q["q3"] - q["q1"]) * 1.5
        flags[c] = F.struct(
            F.avg(F.when(v.isNull(), 1.0).otherwise(0.0)).alias("null_rate"),
            F.coalesce(
                F.avg(F.when(v.isNotNull(), F.when((v < q["q1"] - reach) | (v > q["q3"] + reach), 1.0).otherwise(0.0))),
                F.lit(0.0),
            ).alias("outlier_rate"),
        )
    wide = df.select(*features).withColumn("_b", bounds).agg(*[f.alias(c) for c, f in flags.items()])
    return (
        wide.select(stack_rows({c: F.col(c) for c in features}, "feature", "r").alias("s"))
        .select(
            "s.feature",
            "s.r.null_rate",
            "s.r.outlier_rate",
            (F.col("s.r.null_rate") <= max_null).alias("null_rate_ok"),
            (F.col("s.r.outlier_rate") <= max_outlier).alias("outlier_rate_ok"),
        )
    )


def prediction_shift(
    reference: DataFrame, current: DataFrame, score: str, limit: float = S.MAX_PREDICTION_SHIFT
) -> DataFrame:
    """Shift of the mean prediction, and whether it stays within the limit."""
    means = tagged(reference, current, [score]).agg(
        F.avg(F.when(F.col("is_ref"), F.col(score))).alias("mean_ref"),
        F.avg(F.when(~F.col("is_ref"), F.col(score))).alias("mean_cur"),
    )
    shift = F.abs(F.col("mean_cur") - F.col("mean_ref"))
    return means.withColumn("shift", shift).withColumn("within_limit", F.col("shift") <= limit)
