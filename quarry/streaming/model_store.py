"""A versioned model table that a learner writes and a scoring stream reads.

A version is a folder ``version=<n>`` of weight rows.  It counts only once its marker file
``committed/<n>`` exists, which is written last and at once (a file of its own, created by a
rename on shared storage), so a reader sees a whole version or none.  Sending a version again
overwrites it by itself.

``latest`` reads the newest committed version; ``score_stream`` does so at the start of each
micro-batch, so a scoring stream beside a learner picks up new weights without a restart, and
every row of a micro-batch is scored by one version, whose number it carries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import sgd


class ModelStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def write(self, version: int, weights: Sequence[float]) -> None:
        """The version's rows, not yet committed."""
        rows = [(i, float(w)) for i, w in enumerate(weights)]
        self.spark.createDataFrame(rows, "place int, weight double").write.mode("overwrite").parquet(f"{self.path}/version={version}")

    def commit(self, version: int) -> None:
        """Make a written version the newest if its number is."""
        mark, fs = self._file(f"committed/{version:012d}")
        if fs.exists(mark):
            return
        temporary, _ = self._file(f"committing/{version:012d}")
        fs.mkdirs(mark.getParent())
        fs.mkdirs(temporary.getParent())
        fs.create(temporary, True).close()
        if not fs.rename(temporary, mark) and not fs.exists(mark):
            raise RuntimeError(f"version {version} of {self.path} could not be committed")

    def save(self, version: int, weights: Sequence[float]) -> None:
        self.write(version, weights)
        self.commit(version)

    def versions(self) -> list[int]:
        folder, fs = self._file("committed")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder)) if fs.exists(folder) else []

    def weights(self, version: int) -> list[float]:
        rows = self.spark.read.parquet(f"{self.path}/version={version}").collect()  # as many as features
        return [r.weight for r in sorted(rows, key=lambda r: r.place)]

    def latest(self) -> tuple[int, list[float]] | None:
        """(version, weights) of the newest committed version."""
        known = self.versions()
        return (known[-1], self.weights(known[-1])) if known else None


def score_stream(
    store: ModelStore, features: Sequence[str], keep: Sequence[str], sink: str, loss: str = "logistic"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body: ``keep``, ``version`` and ``prediction`` of each row, under
    ``batch_id=<b>``; a replayed micro-batch is written again as a whole.  Fails while there is
    no version: the batch is then read again."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        model = store.latest()
        if model is None:
            raise RuntimeError(f"no committed version in {store.path}")
        version, weights = model
        scored = batch.select(*keep, F.lit(version).alias("version"), sgd.predict(features, weights, loss).alias("prediction"))
        scored.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    return per_batch
