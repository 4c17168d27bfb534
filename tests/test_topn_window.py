from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators import topn, window
from quarry.plans import q_topn
from quarry.plans.strategies import global_position, prefix_sums


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_salted_equals_plain_and_uses_group_limit(spark):
    rev = q_topn.supplier_part_revenue(spark, SF_SMALL)
    order = [F.desc("revenue"), F.asc("l_partkey")]
    plain = topn.top_n_within_group(rev, ["l_suppkey"], order, 3)
    for buckets in (1, 3, 10):
        salted = topn.top_n_within_group(rev, ["l_suppkey"], order, 3, salt_buckets=buckets, salt_cols=["l_partkey"])
        assert sorted(salted.collect()) == sorted(plain.collect())
    assert "WindowGroupLimit" in _plan(plain)


def test_top_n_keys_with_rows_keeps_all_rows_of_tied_keys(spark):
    df = spark.createDataFrame([(5, "a"), (5, "b"), (4, "c"), (3, "d"), (3, "e")], "k int, v string")
    got = sorted((r.k, r.v, r.key_rank) for r in topn.top_n_keys_with_rows(df, "k", 2).collect())
    assert got == [(4, "c", 2), (5, "a", 1), (5, "b", 1)]


def test_top_n_unique_last_seen_wins(spark):
    df = spark.createDataFrame([(10, "x", 1), (10, "y", 2), (7, "z", 3), (9, "w", 4)], "k int, name string, seq int")
    got = [(r.k, r.name) for r in topn.top_n_unique(df, "k", 2, ["name"], "seq").collect()]
    assert got == [(10, "y"), (9, "w")]


def test_kth_largest_with_fewer_rows_is_min(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (2.0,)], "x double")
    assert topn.kth_largest(df, "x", 2000).first()[0] == 1.0
    assert topn.kth_largest(df, "x", 2).first()[0] == 2.0


def test_global_position_is_dense_and_ordered(spark):
    df = spark.range(0, 3000).select((F.col("id") % 17).alias("g"), F.col("id"))
    pos = global_position(df.repartition(5), [F.asc("g"), F.desc("id")])
    want = df.withColumn("pos", F.row_number().over(Window.orderBy(F.asc("g"), F.desc("id"))))
    assert sorted(pos.collect()) == sorted(want.collect())


def test_prefix_sums_match_running_window(spark):
    df = spark.range(0, 500).select("id", (F.col("id") % 7).alias("v"))
    got = prefix_sums(df.repartition(3), [F.asc("id")], ["v"]).select("id", "v_cum")
    want = df.select("id", F.sum("v").over(Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)).alias("v_cum"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_skew_safe_moving_window_equals_plain(spark):
    # one hot key holding most rows, plus small keys; a tiny block forces many halos
    rows = [(0 if i % 10 else i % 7 + 1, i, float((i * 37) % 101)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    order = [F.asc("t")]
    plain = window.relative_to_moving_avg(df, ["k"], order, "v", skew_safe=False)
    safe = window.relative_to_moving_avg(df, ["k"], order, "v", block=32)
    norm = lambda d: sorted((r.k, r.t, round(r.relative, 9)) for r in d.collect())
    assert norm(safe) == norm(plain)
