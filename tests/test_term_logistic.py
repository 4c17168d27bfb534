"""Logistic regression on term counts as tables: Spark ML's weights, descent and predictions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from quarry.operators import features, models, term_logistic

SF = "/root/testdata/sf0.001"


def _docs(spark, n=60):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        words = [f"w{j}" for j in rng.integers(0, 15, 12)] + (["once" + str(i)] if i % 4 == 0 else [])
        share = sum(w in ("w1", "w2", "w3") for w in words)
        rows.append((i, float(share + rng.normal() > 2.5), ["same", *words]))
    rows[5] = (5, 1.0, [])
    return spark.createDataFrame(rows, "doc_id long, label double, tokens array<string>").repartition(3, "doc_id")


def test_weights_and_descent_are_those_of_spark(spark, monkeypatch):
    monkeypatch.setattr(term_logistic, "BUCKET_PAIRS", 20)
    docs = _docs(spark)
    counts = features.count_vectorizer_model(docs, "tokens")
    want = models.logistic(features="counts").fit(counts.transform(docs))
    got = term_logistic.fit(docs, "tokens", "label")
    weights = {r.term: r.weight for r in got.table.collect()}
    assert set(weights) == set(counts.vocabulary)
    assert np.allclose([weights[t] for t in counts.vocabulary], want.coefficients.toArray(), rtol=1e-4, atol=1e-5)
    assert np.isclose(got.intercept, want.intercept, rtol=1e-4)
    assert len(got.objective) == want.summary.totalIterations + 1
    assert np.allclose(got.objective[:8], want.summary.objectiveHistory[:8], rtol=1e-8)

    new = spark.createDataFrame([(1, ["w1", "w2", "new"]), (1, ["w9"]), (None, []), (3, None)], "doc_id long, tokens array<string>")
    scored = got.scored(new, "tokens", ["doc_id"]).collect()
    margins = sorted(r.margin for r in scored)
    base = got.intercept
    assert np.allclose(margins, sorted([weights["w1"] + weights["w2"] + base, weights["w9"] + base, base, base]))
    assert all(r.prediction == float(r.margin > 0) for r in scored)


def test_one_label_and_wrong_labels(spark):
    docs = _docs(spark)
    assert term_logistic.fit(docs.where("label = 1"), "tokens", "label").intercept == float("inf")
    with pytest.raises(ValueError):
        term_logistic.fit(docs.withColumn("label", F.lit(2.0)), "tokens", "label")
    with pytest.raises(ValueError):
        term_logistic.fit(docs.where("false"), "tokens", "label")


def test_descent_without_terms_keeps_the_log_odds(spark):
    docs = _docs(spark).withColumn("tokens", F.array().cast("array<string>"))
    share = docs.agg(F.avg("label")).first()[0]
    assert np.isclose(term_logistic.fit(docs, "tokens", "label").intercept, np.log(share / (1 - share)))


def test_the_query_keeps_no_vocabulary_on_the_driver(spark, monkeypatch):
    """As Spark ML's fit predicts, without its vectors as wide as the vocabulary."""
    from quarry.plans import q_models

    docs = q_models._tokens(q_models._labelled_docs(spark, SF).withColumn("label", F.col("quality").cast("double")))
    train, test = models.hash_split(docs, "doc_id", 0.7, 777)
    counts = features.count_vectorizer_model(train, "filtered")
    out = models.logistic(features="counts").fit(counts.transform(train)).transform(counts.transform(test))
    want = {r.doc_id: r.prediction for r in out.collect() if abs(r.rawPrediction[1]) > 1e-3}

    def refuse(*args, **kw):
        raise AssertionError("a vocabulary on the driver")

    monkeypatch.setattr(features, "count_vectorizer_model", refuse)
    monkeypatch.setattr(models, "logistic", refuse)
    got = {r.doc_id: r.prediction for r in ent.queries()["text_classify_lr"](spark, SF).collect()}
    assert len(got) == test.count() and want.items() <= got.items()


def test_the_facts_score_every_held_out_row(spark, monkeypatch, tmp_path):
    """Rows that share their id too, and without a vocabulary on the driver."""
    texts = [(i, f"word{i % 7} other{i % 5} {'good' if i % 2 else 'bad'}") for i in range(40)] + [(3, "again")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    _, test = models.hash_split(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", 0.7, 777)

    def refuse(*args, **kw):
        raise AssertionError("a vocabulary on the driver")

    monkeypatch.setattr(features, "count_vectorizer_model", refuse)
    rows = ent.queries()["text_classify_lr_facts"](spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in test.collect()) and all(r.valid for r in rows)


def test_steps_send_bytes_and_keep_one_state(spark):
    """Arrays between blocks and buckets go as bytes; the states of past steps are deleted."""
    import os

    from quarry.session import scratch_path

    root = os.path.dirname(scratch_path(spark, "x"))
    before = set(os.listdir(root))
    model = term_logistic.fit(_docs(spark), "tokens", "label", iterations=3)
    made = sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before)
    assert len(model.objective) == 4 and made.count("gradients") == 1
    numbered = next(x for x in set(os.listdir(root)) - before if x.startswith("numbered"))
    kinds = dict(spark.read.parquet(f"{root}/{numbered}").dtypes)
    assert {kinds[c] for c in kinds if c != "block"} == {"binary"}


@pytest.fixture
def dealt_parts(spark, monkeypatch):
    """Parts of blocks and of buckets that a fit reads in each step, with 40 shuffle partitions and many blocks."""
    seen, whole = [], term_logistic._descended

    def watched(held, buckets, *args):
        seen.append((held.rdd.getNumPartitions(), buckets.rdd.getNumPartitions()))
        return whole(held, buckets, *args[:-2], 2, args[-1])

    monkeypatch.setattr(term_logistic, "_descended", watched)
    monkeypatch.setattr(term_logistic, "BUCKET_PAIRS", 5)
    monkeypatch.setattr(term_logistic.lda, "BLOCK_TOKENS", 14)
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "40")
    yield seen
    spark.conf.set(name, before)


def test_steps_have_no_task_for_each_block(spark, dealt_parts, monkeypatch):
    least = 2 * spark.sparkContext.defaultParallelism
    docs = _docs(spark)
    few = term_logistic.fit(docs, "tokens", "label")
    monkeypatch.setattr(term_logistic, "TASK_ENTRIES", 50)
    many = term_logistic.fit(docs, "tokens", "label")
    assert dealt_parts[0] == (least, least) and all(n > least for n in dealt_parts[1])
    assert np.allclose(few.objective, many.objective)


def test_the_facts_have_no_task_for_each_block(spark, dealt_parts, tmp_path):
    texts = [(i, f"word{i % 7} other{i % 5} only{i} {'good' if i % 2 else 'bad'}") for i in range(90)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(90)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = ent.queries()["text_classify_lr_facts"](spark, str(tmp_path)).collect()
    assert rows and all(r.valid for r in rows)
    assert max(dealt_parts[0]) == 2 * spark.sparkContext.defaultParallelism
