"""Two streams, versions of a model, timed runs."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.streaming import joins, model_store, timed
from quarry.streaming.sources import file_stream, run_foreach_batch, run_to_sink

SHAPE = "id long, k string, at timestamp"


def rows(spark, values):
    return spark.createDataFrame(values, "id long, k string, at string").withColumn("at", F.to_timestamp("at"))


def hour(h, m=0):
    return f"2024-01-01 {h:02d}:{m:02d}:00"


def land(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def run_subtract(spark, left, right, sink, ck, within="30 minutes"):
    rest = joins.subtract_streams(file_stream(spark, left, SHAPE), file_stream(spark, right, SHAPE), ["k"], "at", within)
    run_to_sink(rest, sink, ck)


def test_subtract_equals_the_anti_join_across_a_restart(spark):
    early_l = rows(spark, [(1, "a", hour(1)), (2, "b", hour(1)), (3, None, hour(2)), (4, "c", hour(2)), (4, "c", hour(2))])
    late_l = rows(spark, [(5, "a", hour(4)), (6, "d", hour(5)), (7, "e", hour(5))])
    early_r = rows(spark, [(1, "a", hour(1, 20)), (2, "b", hour(1, 40)), (3, None, hour(2, 10))])
    late_r = rows(spark, [(4, "d", hour(5, 30)), (5, "e", hour(5, 31)), (6, "a", hour(6))])
    left, right, sink, ck = (scratch_path(spark, n) for n in ("l", "r", "s", "c"))
    land(early_l, left), land(early_r, right)
    run_subtract(spark, left, right, sink, ck)
    land(late_l.union(joins.closing_row(late_l, "at", "2100-01-01 00:00:00")), left)
    land(late_r.union(joins.closing_row(late_r, "at", "2100-01-01 00:00:00")), right)
    run_subtract(spark, left, right, sink, ck)
    got = sorted(r.id for r in spark.read.schema(SHAPE).parquet(sink).where("id is not null").collect())
    batch = joins.subtract_streams(early_l.union(late_l), early_r.union(late_r), ["k"], "at", "30 minutes")
    want = sorted(r.id for r in batch.collect())
    assert got == want == [2, 4, 4, 5, 7]
    run_subtract(spark, left, right, sink, ck)  # nothing new: nothing twice
    assert spark.read.schema(SHAPE).parquet(sink).where("id is not null").count() == len(want)


def test_late_rows_of_two_streams(spark):
    """Behind the watermark a left row without a partner that is still held comes out at once,
    and a right row takes nothing away any more."""
    left, right, sink, ck = (scratch_path(spark, n) for n in ("l", "r", "s", "c"))
    land(rows(spark, [(1, "a", hour(1)), (2, "z", hour(9))]), left)
    land(rows(spark, [(1, "q", hour(9))]), right)
    run_subtract(spark, left, right, sink, ck)
    out = lambda: sorted(r.id for r in spark.read.schema(SHAPE).parquet(sink).where("id is not null").collect())
    assert out() == [1]  # the watermark is past its window
    land(rows(spark, [(3, "b", hour(2))]), left)
    land(rows(spark, [(2, "a", hour(1)), (3, "b", hour(2))]), right)
    run_subtract(spark, left, right, sink, ck)
    end = rows(spark, [(None, None, "2100-01-01 00:00:00")])
    land(end, left), land(end, right)
    run_subtract(spark, left, right, sink, ck)
    assert out().count(1) == 1 and 2 in out()


def test_a_version_counts_once_it_is_committed(spark):
    store = model_store.ModelStore(spark, scratch_path(spark, "model"))
    assert store.latest() is None
    store.write(1, [1.0, 2.0])
    assert store.latest() is None
    store.commit(1)
    store.save(1, [1.0, 2.0])  # sent again
    store.write(2, [9.0, 9.0])
    assert store.latest() == (1, [1.0, 2.0]) and store.versions() == [1]
    store.save(10, [3.0, 4.0])
    assert store.latest() == (10, [3.0, 4.0])


def test_scoring_beside_a_learner_sees_whole_versions(spark):
    store = model_store.ModelStore(spark, scratch_path(spark, "model"))
    landing, sink, ck = (scratch_path(spark, n) for n in ("land", "sink", "ck"))
    score = model_store.score_stream(store, ["x", "y"], ["id"], sink, loss="linear")
    data = spark.range(10).select("id", F.lit(1.0).alias("x"), F.lit(1.0).alias("y"))
    with pytest.raises(Exception, match="no committed version"):
        land(data, landing)
        run_foreach_batch(file_stream(spark, landing, data.schema), score, ck)
    stop = threading.Event()

    def learn():
        version = 1
        while not stop.is_set():
            store.save(version, [float(version)] * 2)  # prediction 2 * version
            version += 1

    learner = threading.Thread(target=learn)
    learner.start()
    try:
        while store.latest() is None:
            time.sleep(0.05)
        for _ in range(4):
            land(data, landing)
            run_foreach_batch(file_stream(spark, landing, data.schema), score, ck)
    finally:
        stop.set()
        learner.join()
    got = spark.read.parquet(sink)
    assert got.count() == 50 and got.where("prediction <> 2 * version").count() == 0
    assert got.groupBy("batch_id").agg(F.count_distinct("version").alias("v")).where("v <> 1").count() == 0


def test_timed_run_stops_between_batches(spark):
    landing, sink, ck = (scratch_path(spark, n) for n in ("land", "sink", "ck"))
    data = spark.range(30).select("id")
    land(data, landing)
    stream = lambda: file_stream(spark, landing, "id long", max_files_per_trigger=1)
    seen = timed.run_timed(timed.sink_writer(stream(), sink, ck), "200 milliseconds", batches=1, timeout=60)
    assert [s["rows"] for s in seen] == [30]
    for _ in range(2):
        land(data, landing)
    seen = timed.run_timed(timed.sink_writer(stream(), sink, ck), "200 milliseconds", quiet=2, timeout=60)
    assert [s["rows"] for s in seen] == [30, 30]  # two triggers
    assert spark.read.parquet(sink).count() == 90 and spark.read.parquet(sink).distinct().count() == 30
    with pytest.raises(ValueError):
        timed.run_timed(None, "1 second")
