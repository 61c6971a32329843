"""PSI by the hour against a stored reference histogram, in batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from creditspark.operators.drift import PSI_BINS, PSI_SMOOTHING
from creditspark.streaming.monitor import bucket, started, timed

HISTOGRAM = "feature string, low double, step double, counts array<bigint>"


def _value(feature: str) -> Column:
    """NaN counts as missing."""
    return F.nanvl(F.col(feature).cast("double"), F.lit(None).cast("double"))


def _long(rows: DataFrame, features: list[str], *keep: str) -> DataFrame:
    """(feature, value) for each row and feature."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), _value(c).alias("value")) for c in features])
    return rows.select(*keep, F.explode(pairs).alias("x")).select(*keep, "x.feature", "x.value")


def _bin(value: Column, low: Column, step: Column, last: Column) -> Column:
    """The bin of ``value`` by ``low`` and ``step``; values beyond the reference fall into the first or ``last`` bin."""
    place = F.floor((value - low) / F.when(step > 0, step))
    beside = F.when(value > low, last).otherwise(F.lit(0))  # of a constant
    return F.least(F.greatest(F.coalesce(place, beside), F.lit(0)), last).cast("int")


def reference_histogram(reference: DataFrame, features: list[str], n_bins: int = PSI_BINS) -> DataFrame:
    """(feature, low, step, counts): equal bins over the range of each feature, and the rows in each; one row a feature.

    Two passes, one for the ranges and one for the counts. A feature without values has none.
    """
    long = _long(reference, features).where("value is not null")
    ranges = long.groupBy("feature").agg(F.min("value").alias("low"), ((F.max("value") - F.min("value")) / n_bins).alias("step"))
    own = ranges.withColumnRenamed("feature", "of")
    counted = (
        long.join(F.broadcast(own), F.col("feature") == F.col("of"))  # a row a feature
        .groupBy("feature", "low", "step", _bin(F.col("value"), F.col("low"), F.col("step"), F.lit(n_bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    at = F.map_from_entries(F.collect_list(F.struct("bin", "n")))
    filled = F.transform(F.sequence(F.lit(0), F.lit(n_bins - 1)), lambda b: F.coalesce(F.try_element_at("at", b), F.lit(0).cast("long")))
    return counted.groupBy("feature", "low", "step").agg(at.alias("at")).select("feature", "low", "step", filled.alias("counts"))


def save_histogram(histogram: DataFrame, path: str) -> None:
    histogram.coalesce(1).write.mode("overwrite").parquet(path)


def load_histogram(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTOGRAM).parquet(path)


def psi_of_counts(reference, current):
    """PSI of two arrays of counts of the same bins, with the smoothing term in every bin."""
    n = F.size(reference)
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, v: a + v)
    share = lambda x, t: (x + F.lit(PSI_SMOOTHING)) / (t + F.lit(PSI_SMOOTHING) * n)
    shares = F.arrays_zip(
        F.transform(reference, lambda x: share(x, total(reference))).alias("r"), F.transform(current, lambda x: share(x, total(current))).alias("c")
    )
    terms = F.transform(shares, lambda s: (s["c"] - s["r"]) * F.log(s["c"] / s["r"]))
    return F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, v: a + v), F.lit(0.0))


def _table_counts(rows: DataFrame, histogram: DataFrame, features: list[str], width: str) -> DataFrame:
    """(window_start, feature, n, counts, current): the reference's and the bucket's rows by bin."""
    bins = F.broadcast(histogram.withColumnRenamed("feature", "of"))  # a row a feature
    long = _long(rows, features, "ts").where("value is not null")
    place = _bin(F.col("value"), F.col("low"), F.col("step"), F.size("counts") - 1)
    binned = long.join(bins, F.col("feature") == F.col("of")).withColumn("bin", place)
    counts = binned.groupBy(bucket(width), "feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    whole = counts.groupBy("w", "feature").agg(F.sum("n").alias("n"), F.collect_list(F.struct("bin", "n")).alias("pairs"))
    met = started(whole, "feature", "n", "pairs").join(bins, F.col("feature") == F.col("of"))
    at = F.map_from_entries("pairs")
    current = F.transform(F.sequence(F.lit(0), F.size("counts") - 1), lambda b: F.coalesce(F.try_element_at(at, b.cast("int")), F.lit(0).cast("long")))
    return met.withColumn("current", current)


def _stream_counts(rows: DataFrame, histogram: DataFrame, features: list[str], width: str) -> DataFrame:
    """The same of a stream, from one state row for each bucket and feature, which has a count for each bin.

    So the histogram, a row a feature, is read when the stream is made, and no micro-batch joins it again.
    """
    known = {r.feature: r for r in histogram.collect()}
    bins = [f"n{b}" for b in range(max((len(r.counts) for r in known.values()), default=0))]

    def place(c: str) -> Column:
        r = known[c]
        return F.when(_value(c).isNotNull(), _bin(_value(c), F.lit(r.low), F.lit(r.step), F.lit(len(r.counts) - 1)))

    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), place(c).alias("bin")) for c in features if c in known])
    long = timed(rows).select(bucket(width), F.explode(pairs.cast("array<struct<feature:string,bin:int>>")).alias("x"))
    binned = long.select("w", "x.feature", "x.bin").where("bin is not null")
    counts = [F.count_if(F.col("bin") == b).alias(n) for b, n in enumerate(bins)]
    whole = started(binned.groupBy("w", "feature").agg(F.count(F.lit(1)).alias("n"), *counts), "feature", "n", *bins)
    references = F.map_from_arrays(
        F.lit([*known]).cast("array<string>"), F.array(*[F.lit(r.counts) for r in known.values()]).cast("array<array<bigint>>")
    )
    met = whole.withColumn("counts", references[F.col("feature")])
    return met.withColumn("current", F.slice(F.array(*bins).cast("array<bigint>"), F.lit(1), F.size("counts")))


def psi_by_time(rows: DataFrame, histogram: DataFrame, features: list[str], width: str = "1 hour") -> DataFrame:
    """(window_start, feature, n, psi): each feature's PSI against the stored histogram, per bucket of ``ts``.

    On a stream a bucket is given out once complete. On a table rows are counted by bucket, feature
    and bin, and the bins of a bucket, a few for each feature, are put together. A bucket without
    values of a feature has no row for it.
    """
    counted = (_stream_counts if rows.isStreaming else _table_counts)(rows, histogram, features, width)
    return counted.select("window_start", "feature", "n", psi_of_counts(F.col("counts"), F.col("current")).alias("psi"))
