import math

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from quarry.operators import anomaly, evaluate, features, models, sgd


def test_auc_matches_spark_and_is_rank_invariant(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), int(y), float(round(s, 2))) for i, (y, s) in enumerate(zip(rng.integers(0, 2, 800), rng.random(800)))]
    df = spark.createDataFrame(rows, "id long, label int, score double")
    ours = evaluate.area_under_roc(df, "score", "label").first()[0]
    ref = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(
        df.withColumn("label", F.col("label").cast("double"))
    )
    assert abs(ours - ref) < 1e-9
    moved = evaluate.area_under_roc(df.withColumn("score", F.exp(F.col("score") * 3)), "score", "label").first()[0]
    assert abs(moved - ours) < 1e-12


def test_sgd_equals_mllib(spark):
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.regression import LabeledPoint

    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    y = (x @ np.array([1.5, -2.0]) + rng.normal(scale=0.5, size=200) > 0).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "x1 double, x2 double, y double")
    ours = sgd.sgd_steps(df, ["x1", "x2"], "y", [0.0, 0.0], 5, 1.0, loss="logistic")[-1]
    rdd = spark.sparkContext.parallelize([LabeledPoint(c, [a, b]) for (a, b), c in zip(x, y)], 2)
    ref = LogisticRegressionWithSGD.train(rdd, iterations=5, step=1.0, miniBatchFraction=1.0, regParam=0.0,
                                          regType=None, intercept=False, convergenceTol=0.0)
    assert np.allclose(ours, ref.weights.toArray(), atol=1e-12)


def _tiny_docs(spark):
    texts = [
        (1, "the cat sat on the mat", 1), (2, "dogs chase cats in the park", 0), (3, "a cat and a dog", 1),
        (4, "stocks fell as markets slid", 0), (5, "the market rallied on cat food stocks", 0), (6, "cat cat cat", 1),
    ]
    return spark.createDataFrame(texts, "doc_id long, text string, label int")


def test_exact_naive_bayes_equals_spark_ml(spark):
    docs = _tiny_docs(spark)
    toks = features.tokenize(docs, "text")
    tf = features.term_frequency(toks, "doc_id", "tokens")
    ours = models.naive_bayes_exact(tf, docs.select("doc_id", "label"), "doc_id", "label", [0, 1])
    cv = features.count_vectorizer_model(toks, "tokens")
    data = cv.transform(toks).withColumn("label", F.col("label").cast("double"))
    pred = models.naive_bayes_ml(1.0).fit(data).transform(data)
    ref = {r.doc_id: (r.prediction, r.rawPrediction.toArray()) for r in pred.collect()}
    for r in ours.collect():
        assert r.prediction == ref[r.doc_id][0]
        assert math.isclose(r.score_0, ref[r.doc_id][1][0], abs_tol=1e-9)
        assert math.isclose(r.score_1, ref[r.doc_id][1][1], abs_tol=1e-9)


def test_tf_idf_equals_spark_idf(spark):
    from pyspark.ml.feature import IDF

    toks = features.tokenize(_tiny_docs(spark), "text")
    ours = {(r.doc_id, r.term): r.tfidf for r in features.tf_idf(features.term_frequency(toks, "doc_id", "tokens"), "doc_id").collect()}
    cv = features.count_vectorizer_model(toks, "tokens")
    vec = cv.transform(toks)
    idf = IDF(inputCol="counts", outputCol="w").fit(vec).transform(vec)
    for r in idf.collect():
        v = r.w
        for i, val in zip(v.indices, v.values):
            assert math.isclose(ours[(r.doc_id, cv.vocabulary[i])], val, abs_tol=1e-12)


def test_standardize_zero_variance_divides_by_one(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = features.standardize(df, ["a", "b"]).select("z_a", "z_b").collect()
    assert sorted(tuple(r) for r in got) == [(-1.0, 0.0), (1.0, 0.0)]


def test_anomaly_flags_the_outlier(spark):
    rows = [(float(i % 5), float(i % 3)) for i in range(60)] + [(50.0, 40.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    s = anomaly.anomaly_scores(df, ["a", "b"], k=1).collect()
    flagged = [r for r in s if r.is_anomaly]
    assert len(flagged) == 1 and flagged[0].a == 50.0
    assert all(r.distance >= 0 for r in s)
