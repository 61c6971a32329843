"""Joining predictions with labels that arrive later, and live AUC as labels arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from creditspark.operators.curve import auc_columns, running_totals, value_counts
from creditspark.session import stored
from creditspark.streaming.run import run_batches


def label_join(
    predictions: DataFrame,
    labels: DataFrame,
    key: str,
    min_delay: str,
    max_delay: str,
    how: str = "inner",
    watermark: str = "1 hour",
    salts: int = 1,
) -> DataFrame:
    """Predictions (``key``, ``ts``) with labels (``key``, ``label_ts``) inside the delay.

    Works on two streams, where watermarks on both sides let old state go, and on two
    tables. With ``how`` left, predictions without a label come too: on streams once both
    watermarks have passed the last time a label could count. With ``salts`` above one, a key's predictions are spread over that many
    parts, and labels are copied to each: for keys that hold much of the data.
    """
    if predictions.isStreaming:
        predictions = predictions.withWatermark("ts", watermark)
        labels = labels.withWatermark("label_ts", watermark)
    spread = F.pmod(F.xxhash64(*predictions.columns), F.lit(salts)).cast("int")
    left = predictions.withColumn("_salt", spread)
    right = labels.withColumnsRenamed({key: "_key"}).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    on = (
        (F.col(key) == F.col("_key"))
        & (F.col("_salt") == F.col("_part"))
        & (F.col("label_ts") >= F.col("ts") + F.expr(f"INTERVAL {min_delay}"))
        & (F.col("label_ts") <= F.col("ts") + F.expr(f"INTERVAL {max_delay}"))
    )
    return left.join(right, on, how).drop("_salt", "_part", "_key")


def live_auc_stream(labeled: DataFrame, by: list[str], score: str, label: str, store: str, out: str) -> None:
    """Keep the AUC of every group current while labelled predictions stream in.

    ``store`` holds the merged value counts of each group, as versions named by the batch that
    merged them. A micro-batch reads the newest version of the groups it touches, adds its own
    counts and writes their next; of each group the version before stays, for a repeated batch,
    and older ones are deleted. So what is read and kept does not grow with the age of the stream.
    """
    measures = {"pos": F.when(F.col(label) == 1, 1).otherwise(0).cast("long"), "neg": F.when(F.col(label) == 1, 0).otherwise(1).cast("long")}

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counts = stored(value_counts(batch.filter(F.col(label).isNotNull()), score, measures, by), "batch-counts")
        schema = T.StructType([*[f for f in counts.schema if f.name not in by], *[f for f in counts.schema if f.name in by], T.StructField("version", T.LongType())])
        kept = [f.name for f in schema if f.name != "version"]
        folders = group_folders(spark, store)
        newest = {g: max((v for v in versions if v < batch_id), default=None) for g, versions in folders.items()}
        touched = {group_path(by, r) for r in counts.select(*by).distinct().collect()}  # groups of one micro-batch
        before = [f"{store}/{g}/version={newest[g]}" for g in sorted(touched) if newest.get(g) is not None]
        merged = counts.select(*kept)
        if before:
            old = spark.read.schema(schema).option("basePath", store).parquet(*before).select(*kept)
            merged = merged.unionByName(old).groupBy(*by, "value").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).select(*kept)
        now = merged.withColumn("version", F.lit(batch_id).cast("long"))
        now.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by, "version").parquet(store)
        for g in touched:
            for v in folders.get(g, ()):
                if v < batch_id and v != newest[g]:
                    delete_folder(spark, f"{store}/{g}/version={v}")
        present = [f"{store}/{g}/version={batch_id}" for g in sorted(touched)]
        if present:
            rows = spark.read.schema(schema).option("basePath", store).parquet(*present).select(*kept)
            curve = running_totals(rows, "value", {"pos": F.col("pos"), "neg": F.col("neg")}, by)
            agg = auc_columns()
            result = curve.groupBy(*by).agg(agg["auc_roc"].alias("live_auc"), agg["n_samples"].alias("n_labeled"))
            result.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run_batches(labeled, step, "live-auc")


def group_path(by: list[str], row) -> str:
    """The folders of a group, as a partitioned write names them."""
    escape = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None else "".join(c if c not in _ESCAPED else f"%{ord(c):02X}" for c in str(v))
    return "/".join(f"{c}={escape(row[c])}" for c in by)


_ESCAPED = set('"#%\'*/:=?\\{[]^\x7f') | set(map(chr, range(1, 32)))


def _files(spark, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def group_folders(spark, store: str) -> dict[str, list[int]]:
    """The stored versions of each group: {folders of the group: [version]}; two or three a group."""
    fs, root = _files(spark, store)
    if not fs.exists(root):
        return {}
    out: dict[str, list[int]] = {}
    levels = [("", root)]
    while levels:
        name, folder = levels.pop()
        for child in fs.listStatus(folder):
            if child.isDirectory():
                own = child.getPath().getName()
                if own.startswith("version="):
                    out.setdefault(name, []).append(int(own[8:]))
                elif not own.startswith(("_", ".")):
                    levels.append((f"{name}/{own}" if name else own, child.getPath()))
    return out


def delete_folder(spark, path: str) -> None:
    fs, folder = _files(spark, path)
    fs.delete(folder, True)


def current_auc(spark, out: str, by: list[str]) -> DataFrame:
    """The newest AUC of every group."""
    results = spark.read.parquet(out)
    newest = F.max_by(F.struct("live_auc", "n_labeled"), "batch")
    return results.groupBy(*by).agg(newest.alias("r")).select(*by, "r.live_auc", "r.n_labeled")
