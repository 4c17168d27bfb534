"""Streaming sources and runners.

A socket or an in-memory queue (the reference's sources) needs a server or driver
state; here a stream is a landing folder read with the file source, which is
replayable from its checkpoint.  ``stage_batches`` fills a landing folder from a
DataFrame in one partitioned write (a test / demo fixture: in production an
upstream writer fills the folder).  Runners use ``trigger(availableNow=True)`` and wait
until the stream has read what there is; ``processing_time`` starts a stream with a fixed
batch interval and returns it running.  There is no time limit unless the caller sets one.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stage_batches(df: DataFrame, landing: str, batch_col: str, fmt: str = "parquet") -> StructType:
    """Write ``df`` into ``landing`` as ``<batch_col>=<v>/`` folders; returns the schema
    the stream must be read with (partition column included)."""
    writer = df.write.mode("overwrite").partitionBy(batch_col)
    if fmt == "text":
        writer.text(landing)
    else:
        writer.format(fmt).save(landing)
    return df.schema


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """A streaming DataFrame over a landing folder (replaces socket / queue streams).

    Without ``max_files_per_trigger`` a micro-batch is whatever has landed since the last.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def run_data_batches(
    df: DataFrame,
    batch_col: str,
    landing: str,
    build: Callable[[DataFrame], DataFrame],
    fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    fmt: str = "parquet",
) -> None:
    """One micro-batch per data batch, whatever the number of files.

    The input is written once, partitioned by ``batch_col``, beside the landing folder; its
    folders are then moved into it one at a time, in ascending order of the value, and after
    each the stream (``build`` over the landing folder) runs once from the same checkpoint.
    """
    spark = df.sparkSession
    staged = f"{landing.rstrip('/')}-staged"
    stage_batches(df, staged, batch_col, fmt)
    values = spark.read.format(fmt).schema(df.schema).load(staged).select(batch_col).distinct().orderBy(batch_col)
    names = [r[0] for r in values.select(F.col(batch_col).cast("string")).collect()]  # one row a batch
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = {unquote(s.getPath().getName().partition("=")[2]): s.getPath() for s in fs.listStatus(path(staged)) if s.isDirectory()}
    fs.mkdirs(path(landing))
    for name in names:
        folder = folders["__HIVE_DEFAULT_PARTITION__" if name is None else name]
        if not fs.rename(folder, path(f"{landing.rstrip('/')}/{folder.getName()}")):
            raise RuntimeError(f"{folder} could not be moved into {landing}")
        run_foreach_batch(build(file_stream(spark, landing, df.schema, fmt)), fn, checkpoint)


def _trigger(writer, processing_time: str | None):
    return writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)


def run_to_sink(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    fmt: str = "parquet",
    timeout: float | None = None,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Append a stream to a file sink (exactly once via the sink's log + checkpoint)."""
    writer = stream.writeStream.format(fmt).option("path", sink).option("checkpointLocation", checkpoint).outputMode("append")
    q = _trigger(writer, processing_time).start()
    _await(q, timeout, processing_time)
    return q


def run_foreach_batch(
    stream: DataFrame,
    fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    timeout: float | None = None,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Run ``fn(batch_df, batch_id)`` per micro-batch; ``fn`` must be idempotent per
    ``batch_id`` (a restarted batch is replayed)."""
    writer = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    q = _trigger(writer, processing_time).start()
    _await(q, timeout, processing_time)
    return q


def _await(q: StreamingQuery, timeout: float | None, processing_time: str | None) -> None:
    if processing_time and timeout is None:
        return
    finished = q.awaitTermination(timeout) if timeout is not None else q.awaitTermination() or True
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    if not finished and processing_time is None:
        q.stop()
        raise TimeoutError(f"stream did not finish within {timeout}s")
