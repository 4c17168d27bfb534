from pyspark.sql import functions as F

from quarry.operators import relational as rel


def test_ratio_zero_and_null(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 1, 0), ("c", None, 3), ("d", 2, None)], "p string, n int, d int")
    got = {r.p: r.r for r in df.select("p", rel.ratio("n", "d").alias("r")).collect()}
    assert got == {"a": 0.5, "b": None, "c": None, "d": None}


def test_encode_unknown_and_null_get_default(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "t string")
    got = [r[0] for r in df.select(rel.encode_categories("t", {"x": 0, "y": 1})).collect()]
    assert got == [0, 1, 2, 2]


def test_filter_not_true_drops_nulls(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, h boolean")
    assert [r.id for r in rel.filter_not_true(df, "h").collect()] == [2]


def test_subtract_keeps_other_duplicates_and_is_null_safe(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, None), (3, None)], "id int, v string")
    right = spark.createDataFrame([(2, "b"), (None, "c")], "id int, v string")
    got = sorted(rel.subtract_rows(left, right).collect(), key=str)
    assert [tuple(r) for r in got] == [(1, "a"), (1, "a"), (3, None), (3, None)]


def test_drop_duplicates_keeps_smallest(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 9), (2, "c", 1)], "k int, v string, w int")
    got = {r.k: (r.v, r.w) for r in rel.drop_duplicates_by(df, ["k"], ["v"]).collect()}
    assert got == {1: ("a", 9), 2: ("c", 1)}


def test_filter_pushdown_reaches_scan(spark):
    from conftest import SF_SMALL
    from quarry.tables import read_table

    plan = rel.filter_min(read_table(spark, SF_SMALL, "part"), "p_size", 25)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p_size), GreaterThanOrEqual(p_size,25)]" in plan
