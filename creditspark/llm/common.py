"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once, its lineage cut, in the shared folder of ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="creditspark-llm-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


#: Rows up to which a side of a join is sent to every task; beyond, the join shuffles.
BROADCAST_ROWS = 50_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (computed, a few columns wide) marked for broadcast if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_of(batches, size: int = 512):
    """Slices of at most ``size`` rows, as tuples of Python lists (one per column)."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            part = batch.slice(start, size)
            yield tuple(column.to_pylist() for column in part.columns)
