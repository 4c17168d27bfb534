"""Fitted models on planted frames: finite, better than the majority, the same on two runs."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

import __spark_entry__ as ent
from quarry.operators import features, models

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x @ np.array([2.0, -1.0, 0.5]) + rng.normal(scale=0.3, size=400) > 0.4).astype(float)
    rows = [(i, *map(float, a), float(b), float(a @ [1, 2, 3]) + 4) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double, z double")
    return features.assemble(["a", "b", "c"]).transform(df).cache()


def _accuracy(estimator, planted):
    train, test = models.hash_split(planted, "id", 0.7, 5)
    scores = []
    for _ in range(2):
        out = estimator.fit(train).transform(test)
        scores.append(out.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0])
    rest = test.agg(F.avg("label")).first()[0]
    assert scores[0] == scores[1]
    return scores[0], max(rest, 1 - rest)


@pytest.mark.parametrize(
    "estimator",
    [
        lambda: models.logistic(max_iter=20),
        lambda: models.logistic(max_iter=20, reg=0.01, elastic=0.5),
        lambda: MultilayerPerceptronClassifier(layers=[3, 4, 2], seed=3, maxIter=60),
        lambda: GBTClassifier(maxIter=5, maxDepth=3, seed=3),
    ],
    ids=["logistic", "elastic", "mlp", "gbt"],
)
def test_classifiers_beat_the_majority(planted, estimator):
    found, majority = _accuracy(estimator(), planted)
    assert found > majority + 0.1


def test_linear_fit_equals_the_normal_equations(spark, planted):
    rows = planted.select("a", "b", "c", "z").collect()
    x = np.array([[r.a, r.b, r.c, 1.0] for r in rows])
    want = np.linalg.inv(x.T @ x) @ (x.T @ np.array([r.z for r in rows]))
    model = LinearRegression(regParam=0.0, labelCol="z", solver="normal").fit(planted)
    got = {r.feature: r.weight for r in models.coefficients_frame(spark, ["a", "b", "c"], model).collect()}
    assert np.allclose([got["a"], got["b"], got["c"], got["(intercept)"]], want, atol=1e-8)


def test_elastic_net_shrinks(planted):
    sizes = [np.abs(LinearRegression(regParam=r, elasticNetParam=0.8, labelCol="z").fit(planted).coefficients.toArray()).sum() for r in (0.0, 0.3, 1.0)]
    assert sizes[0] > sizes[1] > sizes[2] >= 0


def test_kmeans_finds_planted_clusters(spark):
    rows = [(float(c * 10 + i % 3), float(c * 10 - i % 2)) for c in range(3) for i in range(30)]
    df = features.assemble(["a", "b"]).transform(spark.createDataFrame(rows, "a double, b double"))
    got = KMeans(k=3, seed=1).fit(df).transform(df).groupBy("prediction").count().collect()
    assert sorted(r["count"] for r in got) == [30, 30, 30]


def _topics(spark):
    words = {0: "cat dog bird fish", 1: "bank loan rate bond"}
    rows = [(i, words[i % 2].split() * 3) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, tokens array<string>")


def test_lda_separates_planted_topics(spark):
    docs = _topics(spark)
    vectoriser = features.count_vectorizer_model(docs, "tokens")
    counts = vectoriser.transform(docs)
    assert len(vectoriser.vocabulary) == 8
    fits = [models.lda(k=2, max_iter=20, doc_concentration=[0.1, 0.1], topic_concentration=0.1).fit(counts) for _ in range(2)]
    assert np.allclose(fits[0].topicsMatrix().toArray(), fits[1].topicsMatrix().toArray())
    top = [np.argmax(r.topicDistribution.toArray()) for r in fits[0].transform(counts).orderBy("doc_id").collect()]
    assert len(set(top[::2])) == 1 and len(set(top[1::2])) == 1 and top[0] != top[1]
    assert np.isfinite(fits[0].logPerplexity(counts))


def test_the_vocabulary_is_whole(spark):
    many = spark.range(3000).select(F.array(F.concat(F.lit("w"), "id")).alias("tokens"))
    assert len(features.count_vectorizer_model(many, "tokens").vocabulary) == 3000
    assert len(features.count_vectorizer_model(many, "tokens", vocab_size=10).vocabulary) == 10


def test_word2vec_is_a_mean_of_word_vectors(spark):
    docs = _topics(spark)
    model = features.word2vec_model(docs, "tokens", size=4, partitions=2)
    vectors = {r.word: r.vector.toArray() for r in model.getVectors().collect()}
    row = model.transform(docs).first()
    assert np.allclose(row.w2v.toArray(), np.mean([vectors[w] for w in row.tokens], axis=0), atol=1e-6)


def test_sweeps_score_the_validation_part(planted):
    train, test = models.hash_split(planted, "id", 0.7, 5)
    rmse = models.validated_sweep(
        train, test, [LinearRegression(regParam=r, labelCol="z") for r in (0.0, 1.0)], RegressionEvaluator(labelCol="z", metricName="rmse")
    )
    assert rmse[0] < 1e-6 < rmse[1]
    accuracy = models.validated_sweep(train, test, [models.logistic(5)], MulticlassClassificationEvaluator(metricName="accuracy"))
    assert 0.5 < accuracy[0] <= 1
    assert len(models.SMOOTHING_GRID) == 100 and models.SMOOTHING_GRID[0] == 0.01 and models.SMOOTHING_GRID[-1] == 1.0


def test_scored_documents_are_not_trained_on(spark):
    tf = spark.createDataFrame([(1, "good", 2), (2, "bad", 2), (3, "good", 1), (4, "new", 5)], "doc_id long, term string, tf long")
    train = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    test = spark.createDataFrame([(3,), (4,), (5,)], "doc_id long")
    out = models.naive_bayes_fit_score(tf.where("doc_id < 3"), train, tf.where("doc_id >= 3"), test, "doc_id", "quality", [0, 1])
    got = {r.doc_id: (r.prediction, r.score_0, r.score_1) for r in out.collect()}
    assert got[3][0] == 1 and got[4][1] == got[4][2] and got[5][1] == got[5][2]  # unknown terms say nothing


def test_registered_sweep_runs_the_whole_grid(spark, monkeypatch):
    """Eight iteration counts, a row each; the fits themselves are cut to one iteration here."""
    asked, lda = [], models.lda
    monkeypatch.setattr(models, "lda", lambda k, n, **kw: asked.append(n) or lda(k, 1, **kw))
    rows = ent.queries()["lda_sweep"](spark, SF).collect()
    assert [r.iterations for r in rows] == asked == [5, 10, 20, 40, 60, 120, 200, 500]
