"""Inputs on which rows, fields or digits were once lost, and shapes at their limits."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions.sampling import hash_bucket
from quarry.functions.text import jvm_split, jvm_trim
from quarry.operators import aggregate, evaluate, models, text, topn, window
from quarry.session import scratch_path
from quarry.sources import files, parse, sinks
from quarry.streaming import online
from quarry.streaming.sources import run_data_batches


def test_json_schema_sees_every_row(spark):
    rows = [(i, '{"a":1}') for i in range(1200)] + [(1200, '{"a":1,\n"b":2}'), (1201, None), (1202, "{broken")]
    got = files.json_from_lines(spark.createDataFrame(rows, "id int, j string"), "j")
    assert {"a", "b"} <= set(got.columns) and got.count() == 1203
    assert got.where("b = 2").count() == 1
    with pytest.raises(ValueError):
        files.infer_json_schema(spark.createDataFrame([(None,)], "j string"), "j")


def test_split_keeps_null_keys_and_small_fractions(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "k int")
    a, b = models.hash_split(df, "k", 0.5, 3)
    assert a.count() + b.count() == 3
    many = spark.range(200_000)
    assert 20 < models.hash_split(many, "id", 0.0004, 1)[0].count() < 200
    assert df.where(hash_bucket("k", 1).isNull()).count() == 0


@pytest.mark.parametrize("n", [3, 999, 1000, 1500])
def test_top_n_of_a_hot_group(spark, n):
    df = spark.range(6000).select(F.when(F.col("id") % 4 < 3, 0).otherwise(F.col("id") % 7).alias("g"), "id")
    order = [F.desc("id")]
    got = topn.top_n_within_group(df, ["g"], order, n)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan if n < 1000 else "_salt" in plan
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order))).where(F.col("rank") <= n)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_statistics_are_not_cut(spark):
    df = spark.createDataFrame([(0.001, 1e-8, "x"), (0.002, 3e-8, None)], "a double, b double, s string")
    assert aggregate.column_moments(df, ["a"]).first().total == pytest.approx(0.003)
    stats = {r.summary: r.b for r in aggregate.describe_typed(df, ["b"]).collect()}
    assert stats["mean"] == pytest.approx(2e-8)
    mixed = {r.summary: (r.a, r.s) for r in aggregate.describe_typed(df, ["a", "s"]).collect()}
    assert mixed["count"] == ("2", "1") and mixed["min"][1] == "x" and mixed["mean"][1] is None
    want = {r.summary: (r.a, r.s) for r in df.describe("a", "s").collect()}
    assert mixed == want


def test_words_are_split_before_lower_casing(spark):
    df = spark.createDataFrame([("fooXbar X baz",), ("ΟΔΟΣXΑ \tThe\x01 the",), (None,), ("",)], "t string")
    got = {r.word: r.n for r in text.word_count_filtered(df, "t", "X", ["baz"]).collect()}
    assert got == {"foo": 1, "bar": 1, "οδος": 1, "α": 1, "the": 2}
    plain = {r.word: r.n for r in text.word_count(df, "t").collect()}
    assert plain["\tthe\x01"] == 1 and "" not in plain


def test_jvm_rules(spark):
    rows = [("a b \n",), ("",), ("  ",), (" a",), (None,), ("a  ",)]
    got = spark.createDataFrame(rows, "s string").select("s", jvm_split("s", " ").alias("p"), jvm_trim("s").alias("t")).collect()
    assert [r.p for r in got] == [["a", "b", "\n"], [""], [], ["", "a"], None, ["a"]]
    assert [r.t for r in got] == ["a b", "", "", "a", None, "a"]


def test_regression_metrics_of_large_close_values(spark):
    rows = [(1e9 + i % 7, 1e9 + i % 7 + 0.01 * (i % 3)) for i in range(300)] + [(1.0, None), (None, 2.0)]
    m = evaluate.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    pairs = [(y - 1e9, p - 1e9) for y, p in rows[:300]]
    mean = sum(y for y, _ in pairs) / 300
    ss_res = sum((y - p) ** 2 for y, p in pairs)
    assert m.mse == pytest.approx(ss_res / 300, rel=1e-4)
    assert m.r2 == pytest.approx(1 - ss_res / sum((y - mean) ** 2 for y, _ in pairs), rel=1e-6)
    one = evaluate.regression_metrics(spark.createDataFrame([(1.0, 2.0), (1.0, None)], "y double, p double"), "y", "p").first()
    assert one.mse == 1.0


def test_auc_of_very_many_pairs(spark, monkeypatch):
    counts = spark.createDataFrame([(0.9, 5_000_000_000, 0), (0.1, 0, 5_000_000_000)], "threshold double, pos long, neg long")
    monkeypatch.setattr(evaluate, "score_counts", lambda *a: counts)
    assert evaluate.area_under_roc(counts, "s", "l").first().auc == 1.0
    ends = evaluate.roc_curve(counts, "s", "l").where("threshold is null").orderBy("tpr").collect()
    assert [(r.tpr, r.fpr) for r in ends] == [(0.0, 0.0), (1.0, 1.0)]


def test_documents_that_share_an_id_stay_apart(spark):
    docs = spark.createDataFrame([(1, "big cat"), (1, "big dog 12")], "id int, t string")
    words = spark.createDataFrame([("cat", "feline", 1)], "word string, canonical string, entry_order int")
    got = text.dictionary_substitute(docs, "id", F.split("t", " "), words)
    assert sorted(map(tuple, got.collect())) == [(1, "#big#dog"), (1, "#big#feline")]
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning(_row") == 1


def test_csv_keeps_line_breaks_and_quotes(spark):
    rows = [(1, 'a "quoted", text\nwith a break'), (2, " blanks "), (3, None), (4, "back\\slash")]
    path = sinks.write_csv(spark.createDataFrame(rows, "id int, t string"), scratch_path(spark, "csv"))
    got = files.read_csv(spark, path, schema="id int, t string", multi_line=True)
    assert sorted(map(tuple, got.collect())) == rows


def test_labelled_lines(spark):
    df = spark.createDataFrame([("1|2 3",), ("x|2 3",), ("1|2 y",), ("1",), (None,), ("1|2|3",)], "v string")
    parsed, rejects = parse.parse_labelled(df, "v", r"\|", label=0, feature_sep=" ")
    assert [(r.label, r.features) for r in parsed.collect()] == [(1.0, [2.0, 3.0])] and rejects.count() == 5
    df = spark.createDataFrame([("2,3,1",), ("1",), ("2,,1",)], "v string")
    parsed, rejects = parse.parse_labelled(df, "v", ",", label=-1)
    assert [(r.label, r.features) for r in parsed.collect()] == [(1.0, [2.0, 3.0])] and rejects.count() == 2


@pytest.mark.parametrize("block", [10, 25, 1000, None])
def test_range_window_of_a_hot_key(spark, block):
    rows = [(0 if i % 10 else i % 3, None if i % 97 == 0 else float((i * 37) % 200) / 2, None if i % 11 == 0 else float(i)) for i in range(900)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, g int, v double, x double")
    w = Window.partitionBy("g").orderBy("v").rangeBetween(-10, 10)
    want = {r.id: r.relative for r in df.withColumn("relative", F.col("x") - F.avg("x").over(w)).collect()}
    got = window.relative_to_range_avg(df, ["g"], "v", "x", block=block).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.relative is None) == (want[r.id] is None)
        assert r.relative is None or math.isclose(r.relative, want[r.id], abs_tol=1e-9)


def _online(spark, files_per_batch, name):
    rows = [(i, float(i % 2), float(i % 5) / 5, float(i % 3) / 3, i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, "key long, label double, a double, b double, batch int").repartition(files_per_batch)
    learner = online.OnlineSGD(scratch_path(spark, name), ["a", "b"], "label", "key", step=0.5, iterations=3)
    run_data_batches(df, "batch", scratch_path(spark, f"{name}-in"), lambda s: s, learner, scratch_path(spark, f"{name}-ck"))
    return learner


def test_a_micro_batch_is_a_data_batch_whatever_its_files(spark):
    found = []
    for n in (1, 3, 7):
        learner = _online(spark, n, f"online{n}")
        w = spark.read.parquet(learner.weights_path).orderBy("batch_id").collect()
        found.append([(r.batch_id, r.n, [round(x, 10) for x in r.weights]) for r in w])
        predicted = spark.read.parquet(learner.predictions_path)
        assert predicted.count() == 90 and predicted.select("key").distinct().count() == 90
    assert found[0] == found[1] == found[2] and [r[:2] for r in found[0]] == [(0, 30), (1, 30), (2, 30)]


def test_a_later_batch_never_starts_from_zero(spark):
    learner = online.OnlineSGD(scratch_path(spark, "lost"), ["a"], "label", "key")
    batch = spark.createDataFrame([(1, 1.0, 2.0)], "key long, label double, a double")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|Path does not exist"):
        learner(batch, 5)


def test_folds_do_not_depend_on_the_layout(spark):
    df = spark.range(500)
    folds = [sorted(map(tuple, models.hash_folds(df.repartition(n), "id", 3, 1).collect())) for n in (1, 5)]
    assert folds[0] == folds[1] and {f for _, f in folds[0]} == {0, 1, 2}
