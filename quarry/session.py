"""Session and shared-folder helpers.

The library never creates a session by itself; ``local_session`` is for tests, the
bench and the driver contract.  Intermediate files (checkpoints, staged streams,
round trips) always live under the cluster's shared checkpoint folder, read from
``spark.checkpoint.dir``.  A folder of our own is only set when that setting is
empty *and* the master is local (tests), never on a cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Spark deletes a job's shuffle files once it has ended; else they stay until the driver collects garbage
FREE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def local_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app: str = "quarry",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session configured the way the library expects (tests / bench)."""
    master = master or os.environ.get("QUARRY_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only in local mode."""
    sc = spark.sparkContext
    current = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; a cluster job needs a shared folder for "
            "checkpoints and staged data"
        )
    path = tempfile.mkdtemp(prefix="quarry-ck-")
    sc.setCheckpointDir(path)
    spark.conf.set(CHECKPOINT_CONF, path)
    return path


def _scratch_root(spark: SparkSession) -> str:
    # checkpoint dirs handed out by SparkContext get a uuid subfolder; keep ours beside it
    return f"{ensure_checkpoint_dir(spark)}/quarry-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the application's own scratch folder, which lies in the
    shared checkpoint folder.  Results may still read it: the application that made it
    clears it with ``clear_scratch`` once they are written."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _written(df: DataFrame, path: str, rows_a_file: int | None, during: dict[str, str] | None) -> DataFrame:
    conf, during = df.sparkSession.conf, during or {}
    before = {k: conf.get(k, None) for k in during}
    for k, v in during.items():
        conf.set(k, v)
    try:
        (df.write.options(maxRecordsPerFile=rows_a_file, compression="zstd") if rows_a_file else df.write).parquet(path)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str, rows_a_file: int | None = None, during: dict[str, str] | None = None) -> DataFrame:
    """``df`` written once under ``scratch_path`` and read back, so that several uses share it.  Where
    rows are large, ``rows_a_file`` bounds what Spark's reader holds at once; ``during`` are settings
    that hold while it is written."""
    return _written(df, scratch_path(df.sparkSession, name), rows_a_file, during)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Latest:
    """A stored table of which only the last version is kept: ``put`` writes the next one, which may
    be made from the one before, and then deletes that."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.path = spark, name, None

    def put(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        out = _written(df, path, None, FREE)
        if self.path:
            _delete(self.spark, self.path)
        self.path = path
        return out


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has left under ``scratch_path``; other applications'
    folders stay."""
    _delete(spark, _scratch_root(spark))
