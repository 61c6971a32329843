"""Reading and writing loan tables, split datasets and the prediction log."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from creditspark import schema as S
from creditspark.errors import IngestionError
from creditspark.functions.loan import date_path
from creditspark.session import stored


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sampling: float = 0.1,
    mode: str = "FAILFAST",
) -> DataFrame:
    """CSV with header. A schema makes this one pass; without it types are inferred.

    Columns of the schema are found by header name, in whatever order the file has them; others
    are left out, and a missing one is an IngestionError. Files of one input must share one
    header. A value that does not parse fails the read, or is null with ``mode`` PERMISSIVE.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).option("samplingRatio", sampling).csv(path)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = reader.csv(path).columns
    missing = [f for f in wanted.fieldNames() if f not in header]
    if missing:
        raise IngestionError(f"no column {', '.join(missing)} in {path}")
    declared = {f.name: f.dataType for f in wanted.fields}
    there = T.StructType([T.StructField(c, declared.get(c, T.StringType())) for c in header])
    rows = reader.option("enforceSchema", False).option("mode", mode).schema(there).csv(path)
    return rows.select(*wanted.fieldNames())


def scan_parquet(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.options(**options).parquet(path)


def scan(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read by suffix; a missing, unreadable, unknown or empty input is an IngestionError."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix not in ("csv", "parquet"):
        raise IngestionError(f"unsupported format '{suffix}' of {path}; expected csv or parquet")
    try:
        df = scan_csv(spark, path, schema) if suffix == "csv" else scan_parquet(spark, path)
        empty = df.isEmpty()
    except AnalysisException as exc:
        missing = "PATH_NOT_FOUND" in str(exc)
        raise IngestionError(f"{'no such input' if missing else 'cannot read'}: {path}") from exc
    except (Py4JJavaError, PySparkException) as exc:
        raise IngestionError(f"cannot read {path}: {exc}") from exc
    if empty:
        raise IngestionError(f"input has no rows: {path}")
    return df


def scan_glob(spark: SparkSession, directory: str, pattern: str, fmt: str = "parquet", **options) -> DataFrame:
    """All files of a folder whose names match; columns are merged by name."""
    reader = spark.read.format(fmt).options(**options).option("pathGlobFilter", pattern)
    if fmt == "parquet":
        reader = reader.option("mergeSchema", True)
    try:
        return reader.load(directory)
    except AnalysisException as exc:
        raise IngestionError(f"no {pattern} under {directory}") from exc


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*(partition_by or [])).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_sample_csv(df: DataFrame, path: str, order: str = S.ID_COLUMN, n: int = 200) -> None:
    """The first ``n`` rows in id order, as one small CSV fixture."""
    df.orderBy(order).limit(n).write.mode("overwrite").option("header", True).csv(path)


def write_splits(df: DataFrame, path: str) -> None:
    """One dataset with a folder per split, so that reading one split prunes the others."""
    write_parquet(df, path, ["split"])


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("split") == split).drop("split")


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def dated_log(df: DataFrame, period: str = "day") -> DataFrame:
    """Rows in the log's columns and types, with the folder date ``dt``."""
    present = {f: F.col(f) if f in df.columns else F.lit(None) for f in S.PREDICTION_LOG_SCHEMA.fieldNames()}
    rows = df.select(*[present[f.name].cast(f.dataType).alias(f.name) for f in S.PREDICTION_LOG_SCHEMA.fields])
    return rows.withColumn("dt", F.trunc(F.to_date("ts"), "month") if period == "month" else F.to_date("ts"))


def append_predictions(df: DataFrame, path: str, period: str = "day") -> None:
    """Append to the prediction log, one folder per UTC day or month.

    Existing files are not read. Rows are gathered by folder before writing, so that a
    folder gets few files; Spark splits a folder that is much larger than the others.
    """
    dated_log(df, period).hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(S.PREDICTION_LOG_SCHEMA.fields + [T.StructField("dt", T.DateType())])
    return spark.read.schema(schema).parquet(path)


def backfill_log(spark: SparkSession, path: str, labels: DataFrame) -> DataFrame:
    """Fill ``labels`` (loan_id, actual_default; an id once) into the stored log at ``path``; the dates rewritten.

    Only the folders of days with a labelled prediction are replaced, by dynamic partition
    overwrite; the files of all others stay. The new folders are written beside the log first,
    so the step that replaces them reads nothing that it overwrites, and may be repeated.
    """
    log = read_predictions(spark, path)
    fresh = labels.select(F.col("loan_id").alias("_id"), F.col("actual_default").alias("_new")).where("_id is not null")
    changes = F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("actual_default"))
    days = stored(log.join(fresh, F.col("loan_id") == F.col("_id")).where(changes).select("dt").distinct(), "days")
    touched = log.join(days, "dt", "left_semi")
    filled = touched.join(fresh, F.col("loan_id") == F.col("_id"), "left").withColumn("actual_default", F.coalesce("_new", "actual_default"))
    new = stored(filled.select(*log.columns), "backfilled")
    new.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)
    return days


def log_location(df: DataFrame, prefix: str = "predictions/") -> DataFrame:
    """The dated folder each prediction belongs to."""
    return df.withColumn("log_path", F.concat(F.lit(prefix), date_path(F.col("ts"))))
