"""Inputs whose nulls, names or sizes once changed an answer."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import evaluate, hashing, relational, sgd, topn
from quarry.session import scratch_path
from quarry.sources import files, sinks
from quarry.streaming import online


def test_rows_without_a_score_are_no_points(spark):
    rows = [(0.9, 1), (0.8, 0), (None, 1), (0.5, None)]
    df = spark.createDataFrame(rows, "score double, label int")
    assert evaluate.area_under_roc(df, "score", "label").first().auc == 1.0
    points = {(r.threshold, r.tp, r.fp) for r in evaluate.roc_curve(df, "score", "label").collect()}
    assert points == {(0.9, 1, 0), (0.8, 1, 1), (None, 0, 0), (None, 1, 1)}
    assert evaluate.binary_curve(df, "score", "label").count() == 2
    assert evaluate.best_f1_threshold(df, "score", "label").first().threshold == 0.9


def test_rows_without_a_prediction_are_missing(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (0, 0), (None, 1)], "label int, prediction int")
    r = evaluate.confusion_counts(df, "label", "prediction").first()
    assert (r.total, r.correct, r.wrong, r.missing, r.wrong_ratio) == (2, 2, 0, 2, 0.0)
    assert evaluate.accuracy(df, "label", "prediction").first().accuracy == 1.0
    w = evaluate.weighted_precision_recall(df, "label", "prediction").first()
    assert (w.weighted_precision, w.weighted_recall) == (1.0, 1.0)
    assert evaluate.accuracy(df.limit(0), "label", "prediction").first().accuracy is None


def test_gradient_counts_rows_that_have_one(spark):
    rows = [(1, 1.0, 1.0), (2, 1.0, 1.0), (3, None, 1.0), (4, 1.0, None)]
    df = spark.createDataFrame(rows, "k long, x double, y double")
    known = df.dropna()
    args = (["x"], "y", [0.0], 1, 2.5, "linear")
    assert sgd.sgd_steps(df, *args) == sgd.sgd_steps(known, *args) == [[2.5]]
    with pytest.raises(ValueError):
        sgd.sgd_steps(df, *args, fraction=0.5)


def test_malformed_activity_lines_are_rejects(spark):
    lines = ["1 4 7 x 2.5 3 4", "x 5 8 x 1.5 1 2", "3 4 9 x oops 1 1", "4 5 1 x", "5 0 1 x y z", "6 5 2 x 0.5 0 1"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [r.key for r in online.activity_cleanse(df).collect()] == [1, 6]
    assert [r.value for r in online.activity_rejects(df).collect()] == lines[1:4]


def test_json_field_named_like_a_column(spark):
    df = spark.createDataFrame([(1, '{"ID": 5, "v": 2}')], "id long, j string")
    with pytest.raises(ValueError, match="ID"):
        files.json_from_lines(df, "j")
    assert files.json_from_lines(df.withColumnRenamed("id", "key"), "j").first() == (1, 5, 2)


def test_text_scan_in_more_parts(spark):
    path = sinks.write_text(spark.range(500).select(F.col("id").cast("string").alias("value")).coalesce(1), scratch_path(spark, "hint"))
    assert files.read_text(spark, path, min_partitions=10).rdd.getNumPartitions() == 10
    assert files.read_text(spark, path).rdd.getNumPartitions() < 10
    assert files.read_text(spark, path, min_partitions=10).distinct().count() == 500


def test_selection_equals_the_limit_form(spark):
    rows = [(float(x % 97) - 40.5 if x % 11 else None, x % 13 - 6) for x in range(3000)] + [(0.0, 0), (-0.0, 0), (float("inf"), 1), (1e300, 1), (-1e-300, 1)]
    df = spark.createDataFrame(rows, "x double, i int")
    for k in (1, 2, 40, 1365, 2700, 2732, 5000):
        for c in ("x", "i"):
            assert topn.kth_largest_selected(df, c, k).first() == topn.kth_largest(df, c, k).first()
    assert topn.kth_largest_selected(df.limit(0), "x", 3).first().kth_value is None
    with pytest.raises(ValueError):
        topn.kth_largest_selected(df, "x", 0)
    plan = topn.kth_largest_selected(df, "x", 1500)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Sort" not in plan


def test_subtract_sends_a_repeated_row_once(spark, monkeypatch):
    monkeypatch.setattr(relational, "RUN_ROWS", 1000)
    left = spark.range(20000).select(F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id")).alias("a b"), F.lit("x").alias("n"))
    right = spark.createDataFrame([(3, "x"), (5, "y")], ["a b", "n"])
    got = relational.subtract_rows(left, right)
    assert got.columns == left.columns
    counts = got.groupBy("a b").count().where("`a b` is null").first()
    assert counts["count"] == 10000 and got.count() == 19999
    assert relational.subtract_rows(left, left).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # collapsed before the exchange


def test_hashed_entries(spark):
    df = spark.createDataFrame([(1, "x", "y", 2.0), (2, None, "y", None), (3, "x", None, 0.0)], "k int, c string, d string, n double")
    wide = {(r.k, r["index"]): r.value for r in hashing.entries(df, ["k"], ["c", "d"], ["n"]).collect()}
    assert len(wide) == 5 and {k for k, _ in wide} == {1, 2, 3} and all(0 <= i < hashing.WIDTH for _, i in wide)
    for width in (1, 2, 3, 50):  # what meets in one place adds up
        small = {}
        for r in hashing.entries(df, ["k"], ["c", "d"], ["n"], width).collect():
            assert (r.k, r["index"]) not in small and r.value != 0
            small[r.k, r["index"]] = r.value
        assert sum(v for (k, _), v in small.items() if k == 1) == sum(v for (k, _), v in wide.items() if k == 1)
    row = hashing.sparse_vectors(df, hashing.hashed_entries(["c", "d"], ["n"])).where("k = 1").first().features
    assert row.size == hashing.WIDTH and dict(zip(row.indices.tolist(), row.values.tolist())) == {i: v for (k, i), v in wide.items() if k == 1}


def test_hashed_tokens_count(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", None, "c", "a"]), (2, []), (3, None)], "k int, t array<string>")
    got = {r.k: r.e for r in df.select("k", hashing.hashed_tokens(F.col("t")).alias("e")).collect()}
    assert sorted(e.value for e in got[1]) == [1.0, 1.0, 3.0] and got[2] == got[3] == []
    assert [e["index"] for e in got[1]] == sorted(e["index"] for e in got[1])
    one = df.select("k", hashing.hashed_tokens(F.col("t"), 1).alias("e")).first().e
    assert [(e["index"], e.value) for e in one] == [(0, 5.0)]
