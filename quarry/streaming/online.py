"""Stateless stream transforms and online regression over micro-batches
(R03-R09, V10).

``activity_cleanse`` is the per-record cleansing of the activity stream as column
expressions; it works on batch and streaming DataFrames alike.

``OnlineSGD`` is the ``foreachBatch`` body of an online logistic / linear model:
for micro-batch ``b`` it loads the weights written by the latest batch before ``b``
(zeros at the start), scores ``b`` with them (predictions and MSE are written
first, so a batch is always scored by a model that has not seen it), runs the SGD
steps on ``b`` and writes the new weights under ``batch_id=b``.  Every output is
keyed by ``batch_id`` and overwritten on replay, so a restart from the checkpoint
does not double-count.  The only driver-side state is ``d`` weights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.sampling import hash_split_flag
from quarry.operators import sgd

# Activity codes kept and their 0/1 labels.
KEEP_CODES = {"4": 0.0, "5": 1.0}
_READ = [f"{c} is not null" for c in ("key", "x1", "x2", "x3", "x4")]


def activity_cleanse(lines: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Drop lines with ``Nan``, split on spaces, drop code ``0`` (field 1), keep fields
    1, 2, 4, 5, 6, keep codes 4 / 5 relabelled 0 / 1; field 0 is the row key (R03, B7).
    ``keep`` columns pass through unchanged.  Lines whose key or readings are no numbers, or
    missing, are left to ``activity_rejects``."""
    return _activity(lines, col, keep).where(" and ".join(_READ))


def activity_rejects(lines: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and the lines with a code to be kept that ``activity_cleanse`` cannot read."""
    passed = list(dict.fromkeys([*keep, col]))
    return _activity(lines, col, passed).where(f"not ({' and '.join(_READ)})").select(*passed)


def _activity(lines: DataFrame, col: str, keep: Sequence[str]) -> DataFrame:
    f = F.split(F.col(col), " ")
    kept = lines.where(~F.col(col).contains("Nan")).select(*keep, f.alias("f")).where(F.get("f", 1) != "0")
    code = F.get("f", 1)
    label = F.when(code == "4", F.lit(KEEP_CODES["4"])).when(code == "5", F.lit(KEEP_CODES["5"]))
    return kept.where(code.isin(*KEEP_CODES)).select(
        *keep,
        F.get("f", 0).try_cast("bigint").alias("key"),
        label.alias("label"),
        *[F.get("f", i).try_cast("double").alias(f"x{j}") for j, i in enumerate((2, 4, 5, 6), start=1)],
    )


def split_test_train(batch: DataFrame, key: str, seed: int, test_fraction: float) -> DataFrame:
    """Per-batch split (R04/R05) in one pass: test = hash sample, train = the rest."""
    flag = hash_split_flag(key, seed, test_fraction)  # never null: the rest is its complement
    return batch.withColumn("part", F.when(flag, F.lit("test")).otherwise(F.lit("train")))


class OnlineSGD:
    """``foreachBatch`` body for online logistic / linear regression."""

    def __init__(
        self,
        store: str,
        features: Sequence[str],
        label: str,
        key: str,
        loss: str = "logistic",
        step: float = 0.1,
        iterations: int = 1,
        fraction: float = 1.0,
        seed: int = 0,
    ):
        self.store = store.rstrip("/")
        self.features, self.label, self.key = list(features), label, key
        self.loss, self.step, self.iterations = loss, step, iterations
        self.fraction, self.seed = fraction, seed

    @property
    def weights_path(self) -> str:
        return f"{self.store}/weights"

    @property
    def metrics_path(self) -> str:
        return f"{self.store}/metrics"

    @property
    def predictions_path(self) -> str:
        return f"{self.store}/predictions"

    def _previous(self, spark, batch_id: int) -> list[float]:
        """Weights before ``batch_id``; only a stream's first batch starts from zeros, so a
        later batch that cannot read them fails instead of starting the model anew."""
        if batch_id == 0:
            return [0.0] * len(self.features)
        w = spark.read.parquet(self.weights_path).where(F.col("batch_id") < batch_id)
        row = w.orderBy(F.desc("batch_id")).limit(1).collect()
        if not row:
            raise RuntimeError(f"no weights before batch {batch_id} in {self.weights_path}")
        return list(row[0]["weights"])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        data = batch.select(self.key, self.label, *self.features).persist()
        try:
            w = self._previous(spark, batch_id)
            pred = sgd.predict(self.features, w, self.loss)
            err = pred - F.col(self.label)
            scored = data.select(self.key, self.label, pred.alias("prediction"))
            scored.write.mode("overwrite").parquet(f"{self.predictions_path}/batch_id={batch_id}")
            # the batch id is the partition folder, not a data column
            metrics = data.agg(F.count(err).alias("n"), F.avg(err * err).alias("mse"))
            metrics.write.mode("overwrite").parquet(f"{self.metrics_path}/batch_id={batch_id}")
            n = spark.read.parquet(f"{self.metrics_path}/batch_id={batch_id}").first()["n"]
            if n:
                hist = sgd.sgd_steps(
                    data, self.features, self.label, w, self.iterations, self.step, self.loss,
                    fraction=self.fraction, key=self.key, seed=self.seed * 1_000_003 + batch_id,
                )
                w = hist[-1]
            spark.createDataFrame([(w, n)], "weights array<double>, n bigint").write.mode("overwrite").parquet(
                f"{self.weights_path}/batch_id={batch_id}"
            )
        finally:
            data.unpersist()
