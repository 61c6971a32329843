"""Equi-joins that stay balanced when single keys hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOT_ROWS = 1_000_000
SAMPLE_ONE_IN = 1_000


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int, one_in: int = SAMPLE_ONE_IN) -> DataFrame:
    """(keys, n): keys with about ``hot_rows`` rows or more, from a sample of the rows.

    The sample is chosen by a hash of the row's content, so every evaluation finds the
    same keys. Which keys are found decides only how the work is spread.
    """
    one_in = max(1, min(one_in, hot_rows // 100))
    picked = df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(one_in)) == 0)
    return (
        picked.groupBy(*keys)
        .agg((F.count(F.lit(1)) * one_in).alias("n"))
        .filter(F.col("n") >= hot_rows)
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    hot_rows: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join on equal keys (null matches null), with hot left keys spread over tasks.

    A key with more than ``hot_rows`` left rows gets one copy of its right rows per
    ``hot_rows`` left rows, and each left row picks one copy, so the result is that of
    the plain join. The list of hot keys has at most rows / hot_rows entries, which is
    what makes broadcasting it safe. ``counts`` (keys, n) replaces the sampled sizes
    where exact ones are at hand.
    """
    hot_rows = hot_rows or HOT_ROWS
    if how not in ("left", "inner", "left_semi"):
        raise ValueError(f"unsupported join {how}")
    most = 4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = hot_keys(left, keys, hot_rows) if counts is None else counts.filter(F.col("n") > hot_rows)
    hot = F.broadcast(
        sizes.select(
            *[F.col(k).alias(f"_hot_{k}") for k in keys],
            F.least(F.ceil(F.col("n") / hot_rows), F.lit(most)).cast("int").alias("_copies"),
        )
    )
    on_hot = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    drop_hot = [f"_hot_{k}" for k in keys] + ["_copies"]
    # Equal rows in different partitions get different salts.
    place = F.xxhash64(*[F.col(c) for c in left.columns], F.spark_partition_id())
    spread = F.coalesce(F.pmod(place, F.col("_copies")), F.lit(0)).cast("int")
    salted_left = left.join(hot, on_hot, "left").withColumn("_salt", spread).drop(*drop_hot)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_copies"), F.lit(1)) - 1))
    salted_right = (
        right.join(hot, on_hot, "left")
        .withColumn("_right_salt", copies)
        .drop(*drop_hot)
        .withColumnsRenamed({k: f"_right_{k}" for k in keys})
    )
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys] + [F.col("_salt") == F.col("_right_salt")]
    return salted_left.join(salted_right, on, how).drop("_salt", "_right_salt", *[f"_right_{k}" for k in keys])
