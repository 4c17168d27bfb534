from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.streaming import online
from quarry.streaming.sources import file_stream, run_foreach_batch, run_to_sink, stage_batches


def _lines(spark):
    rows = [
        ("1 4 7 x 2.5 3 4", 0), ("2 5 8 x 1.5 1 2", 0), ("3 0 9 x 1.0 1 1", 1),
        ("4 4 1 x Nan 2 2", 1), ("5 2 1 x 3.0 3 3", 1), ("6 5 2 x 0.5 0 1", 2),
    ]
    return spark.createDataFrame(rows, "value string, batch int")


def test_cleanse_rules(spark):
    got = online.activity_cleanse(_lines(spark)).collect()
    assert sorted((r.key, r.label) for r in got) == [(1, 0.0), (2, 1.0), (6, 1.0)]


def test_restart_from_checkpoint_does_not_double_count(spark):
    landing = scratch_path(spark, "t-landing")
    schema = stage_batches(_lines(spark), landing, "batch", fmt="text")
    sink, ck = scratch_path(spark, "t-sink"), scratch_path(spark, "t-ck")
    for _ in range(2):  # the second run finds every file already committed
        stream = online.activity_cleanse(file_stream(spark, landing, schema, fmt="text"))
        run_to_sink(stream, sink, ck)
    assert spark.read.parquet(sink).count() == 3


def test_online_sgd_store_is_idempotent(spark):
    landing = scratch_path(spark, "t-sgd")
    rows = [(i, float(i % 2), float(i % 5) / 5, float(i % 3) / 3, i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, "key long, label double, a double, b double, batch int")
    schema = stage_batches(df, landing, "batch")
    learner = online.OnlineSGD(scratch_path(spark, "t-store"), ["a", "b"], "label", "key", step=0.5, iterations=3)
    run_foreach_batch(file_stream(spark, landing, schema), learner, scratch_path(spark, "t-sgd-ck"))
    first = sorted(tuple(r.weights) for r in spark.read.parquet(learner.weights_path).collect())
    # replaying a batch id rewrites its own folder with the same weights
    learner(spark.read.parquet(landing).where("batch = 0"), 0)
    w = spark.read.parquet(learner.weights_path)
    assert w.count() == len(first)
