"""Session defaults and the shared folder for checkpoints and stream state."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "creditspark"):
    """Session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    ``spark.checkpoint.dir`` decides. Where it is unset, a local session gets a
    fresh temporary folder; a cluster session without it is an error, since a
    folder on one machine would be lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="creditspark-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    import uuid

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df, name: str):
    """``df`` written once under the shared folder and read back: for a table that a query uses several times."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
