"""Models that are solved exactly, against Spark ML and against themselves on parts."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from quarry.operators import linear, logistic, models

X = ["a", "b", "c"]


def planted(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.1] + [0.0, 100.0, 3.0]
    y = x @ [2.0, -0.5, 4.0] + 7 + rng.normal(size=n)
    z = (x @ [1.0, -0.2, 3.0] + 11 + rng.logistic(size=n) > 0).astype(float)
    rows = [(i, *map(float, x[i]), float(y[i]), float(z[i])) for i in range(n)]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, y double, z double").persist()


@pytest.mark.parametrize("reg,l1", [(0.0, 0.0), (0.3, 0.8), (1.0, 0.0), (0.5, 1.0), (50.0, 1.0)])
def test_elastic_net_equals_spark_ml(spark, reg, l1):
    df = planted(spark)
    fit = linear.elastic_net(linear.moments(df, X, "y")[None], reg, l1)
    vec = VectorAssembler(inputCols=X, outputCol="features").transform(df)
    ml = LinearRegression(regParam=reg, elasticNetParam=l1, labelCol="y", maxIter=2000, tol=1e-14, solver="normal").fit(vec)
    assert np.allclose([*fit.coefficients, fit.intercept], [*ml.coefficients, ml.intercept], rtol=1e-6, atol=1e-6)
    error = linear.mean_squared_error(linear.moments(df, X, "y")[None], fit)
    direct = df.select(F.avg(F.pow(linear.predicted(X, fit) - F.col("y"), 2))).first()[0]
    assert error == pytest.approx(direct, rel=1e-9)


def test_folds_equal_fits_on_their_rows(spark):
    df = planted(spark)
    grid = [(0.1, 0.5), (0.0, 0.0)]
    got = linear.fold_errors(df, X, "y", "k", 3, 42, grid)
    assert len(got) == 6
    for reg, l1, fold, rmse in got:
        folded = models.hash_folds(df, "k", 3, 42)
        fit = linear.elastic_net(linear.moments(folded.where(F.col("fold") != fold), X, "y")[None], reg, l1)
        held = folded.where(F.col("fold") == fold)
        direct = held.select(F.sqrt(F.avg(F.pow(linear.predicted(X, fit) - F.col("y"), 2)))).first()[0]
        assert rmse == pytest.approx(direct, rel=1e-9)


def test_linear_edges(spark):
    shape = "k long, a double, b double, y double"
    rows = [(1, 1.0, 5.0, 2.0), (2, 2.0, 5.0, 4.0), (3, 3.0, 5.0, 6.0), (4, None, 5.0, 99.0), (5, 1.0, 5.0, None)]
    fit = linear.elastic_net(linear.moments(spark.createDataFrame(rows, shape), ["a", "b"], "y")[None])
    assert fit.coefficients == pytest.approx((2.0, 0.0)) and fit.intercept == pytest.approx(0.0)  # nulls out, no spread
    flat = linear.elastic_net(linear.moments(spark.createDataFrame([(1, 1.0, 2.0, 3.0), (2, 4.0, 5.0, 3.0)], shape), ["a", "b"], "y")[None])
    assert flat.coefficients == (0.0, 0.0) and flat.intercept == 3.0
    none = linear.moments(spark.createDataFrame([], shape), ["a", "b"], "y")[None]
    assert linear.elastic_net(none) is None and linear.validated_grid(none, none, [(0.1, 0.0)]) == [(0.1, 0.0, None)]


@pytest.mark.parametrize("reg,l1", [(0.01, 0.5), (0.05, 0.0), (0.02, 1.0), (0.0, 0.0)])
def test_logistic_equals_spark_ml(spark, reg, l1):
    df = planted(spark)
    fit = logistic.fit(df, X, "z", reg, l1)
    vec = VectorAssembler(inputCols=X, outputCol="features").transform(df)
    ml = LogisticRegression(regParam=reg, elasticNetParam=l1, labelCol="z", maxIter=3000, tol=1e-14).fit(vec)
    assert np.allclose([*fit.coefficients, fit.intercept], [*ml.coefficients, ml.intercept], rtol=1e-4, atol=1e-5)
    assert fit.objective[-1] == pytest.approx(ml.summary.objectiveHistory[-1], abs=1e-9)
    assert fit.objective[-1] <= ml.summary.objectiveHistory[-1] + 1e-12
    assert all(a >= b - 1e-12 for a, b in zip(fit.objective[:-1], fit.objective[1:], strict=True))


def test_logistic_takes_arrays_and_skips_nulls(spark):
    df = planted(spark).withColumn("v", F.array(*X))
    more = df.union(df.limit(3).withColumn("z", F.lit(None).cast("double"))).union(
        df.limit(3).withColumn("v", F.array(F.lit(None).cast("double"), F.col("b"), F.col("c")))
    )
    one, two = logistic.fit(df, X, "z", 0.01, 0.5), logistic.fit(more, "v", "z", 0.01, 0.5)
    assert np.allclose(one.coefficients, two.coefficients, rtol=1e-6)
    assert logistic.fit(df.limit(0), X, "z") is None
    same = logistic.fit(df.withColumn("b", F.lit(2.0)), X, "z", 0.01, 0.5)
    assert same.coefficients[1] == 0.0


def test_smoothing_sweep_equals_single_fits(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for d in range(120):
        quality = int(rng.integers(0, 2))
        labels.append((d, quality))
        for t in set(rng.integers(quality * 5, 30 + quality * 5, 8).tolist()):
            rows.append((d, f"t{t}", int(rng.integers(1, 4))))
    tf = spark.createDataFrame(rows, "doc_id long, term string, tf long")
    docs = spark.createDataFrame([*labels, (999, 1)], "doc_id long, quality int")  # one without terms
    got = {(r.smoothing, r.seed): r.accuracy for r in models.naive_bayes_sweep(tf, docs, "doc_id", "quality", [0.01, 0.5, 1.0], [1, 2]).collect()}
    assert len(got) == 6
    for (smoothing, seed), accuracy in got.items():
        train, test = models.hash_split(docs, "doc_id", 0.7, seed)
        scored = models.naive_bayes_fit_score(
            tf.join(train.select("doc_id"), "doc_id"), train, tf.join(test.select("doc_id"), "doc_id"), test, "doc_id", "quality", [0, 1], smoothing
        )
        direct = scored.select(F.avg((F.col("quality") == F.col("prediction")).cast("double"))).first()[0]
        assert accuracy == pytest.approx(direct)
