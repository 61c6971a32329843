"""Reading tables as streams and running a stream over what is available."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from creditspark.session import fresh_dir


def stream_table(spark: SparkSession, path: str, **options) -> DataFrame:
    """A parquet table as a file stream; the schema comes from the table.

    The path goes in as a pattern matching only itself: a file source takes a single
    file that way, where a plain path has to be a folder.
    """
    schema = spark.read.parquet(path).schema
    path = path.rstrip("/")
    return spark.readStream.schema(schema).options(**options).parquet(f"{path[:-1]}[{path[-1]}]")


class Played(NamedTuple):
    """A folder of files in stretches of time, ``files`` of them a stretch."""

    path: str
    files: int


def timed_files(rows: DataFrame, ts: str, name: str, parts: int = 4, close_after: str = "1 day", files: int | None = None) -> Played:
    """A finite table laid out to be played back as a stream: stretches of time, oldest first, of ``files`` files each.

    A stretch is written by as many tasks as it has files (by default those of the table's scan),
    and filled up with empty files where rows are few, so that a micro-batch is a stretch. Rows
    without a time go with the first stretch. A last file holds one row ``close_after`` behind the
    newest time, null otherwise. It moves the watermark past all others, so every bucket with data
    closes and is given out; its own never is. This is how a run over data at hand is flushed.
    """
    spark, path = rows.sparkSession, fresh_dir(rows.sparkSession, name)
    first, last = rows.agg(F.min(ts), F.max(ts)).first()
    files = files or rows.rdd.getNumPartitions()
    if first is None:
        rows.limit(0).write.parquet(path)
        return Played(path, files)
    edges = [first + (last - first) * i / parts for i in range(1, parts)]
    written = 0
    for k, (low, high) in enumerate(zip([None, *edges], [*edges, None])):
        within = (F.lit(True) if low is None else F.col(ts) >= F.lit(low)) & (F.lit(True) if high is None else F.col(ts) < F.lit(high))
        within = within | F.col(ts).isNull() if k == 0 else F.coalesce(within, F.lit(False))
        part = rows.where(within)
        (part.repartition(files) if files > 1 else part.coalesce(1)).write.mode("append").parquet(path)
        written += files
        while len(spark.read.schema(rows.schema).parquet(path).inputFiles()) < written:
            rows.limit(0).coalesce(1).write.mode("append").parquet(path)
    end = (F.lit(last) + F.expr(f"interval {close_after}")).cast(rows.schema[ts].dataType)
    empty = [end.alias(c) if c == ts else F.lit(None).cast(t.dataType).alias(c) for c, t in zip(rows.columns, rows.schema)]
    spark.range(1).select(*empty).write.mode("append").parquet(path)
    return Played(path, files)


def play(spark: SparkSession, played: Played, schema) -> DataFrame:
    """What ``timed_files`` laid out as a stream, a stretch at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", played.files).parquet(played.path)


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def keyed_state(spark: SparkSession, keys: int | None = None) -> Iterator[None]:
    """Streams started within use the state store that typed state and timers need.

    Where at most ``keys`` keys can occur, they have no more state partitions than that: each one
    starts a Python worker and a store of its own in every micro-batch, with or without a key.
    """
    wanted = {STATE_STORE: ROCKSDB}
    if keys is not None:
        wanted[PARTITIONS] = str(max(1, min(keys, int(spark.conf.get(PARTITIONS)))))
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def append_available(stream: DataFrame, name: str, partition_by: list[str] | None = None, keyed: bool = False, keys: int | None = None) -> str:
    """Run the stream over the data at hand; the folder it appended to."""
    path = fresh_dir(stream.sparkSession, name)
    checkpoint = fresh_dir(stream.sparkSession, f"{name}-state")
    with keyed_state(stream.sparkSession, keys) if keyed else nullcontext():
        query = file_sink(stream, path, checkpoint, partition_by).trigger(availableNow=True).start()
    query.awaitTermination()
    return path


def follow(stream: DataFrame, name: str) -> DataFrame:
    """A second stream over what the first one appends."""
    path = append_available(stream, name)
    return stream.sparkSession.readStream.schema(stream.schema).parquet(path)


def file_sink(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> DataStreamWriter:
    """Exactly-once append of a stream to a parquet folder."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return writer.partitionBy(*partition_by) if partition_by else writer


def run_available(stream: DataFrame, name: str, keyed: bool = False, keys: int | None = None) -> DataFrame:
    """Run the stream over the data at hand and return what it appended, as a table."""
    return stream.sparkSession.read.schema(stream.schema).parquet(append_available(stream, name, keyed=keyed, keys=keys))


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], name: str) -> None:
    """Run ``step`` on every micro-batch of the data at hand."""
    checkpoint = fresh_dir(stream.sparkSession, f"{name}-state")
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
