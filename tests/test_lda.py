"""Topic models whose vocabulary is a table, against Spark ML's and a plain computation."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import features, lda, models

WORDS = {0: "cat dog bird fish", 1: "bank loan rate bond"}


def planted(spark, n=40):
    rows = [(i, (WORDS[i % 2].split() * 2)[: 5 + i % 4]) for i in range(n)]
    return spark.createDataFrame([*rows, (7, ["cat", "bank", "cat"]), (None, ["dog"]), (None, []), (99, [])], "id long, tokens array<string>").repartition(3)


def test_digamma_and_trigamma():
    x = np.array([0.01, 0.5, 1.0, 3.7, 250.0])
    step = 1e-5 * x
    slope = [(math.lgamma(a + h) - math.lgamma(a - h)) / (2 * h) for a, h in zip(x, step)]
    assert np.allclose(lda.digamma(x), slope, rtol=1e-6)
    assert np.allclose(lda.trigamma(x), (lda.digamma(x + step) - lda.digamma(x - step)) / (2 * step), rtol=1e-5)
    assert lda.digamma(np.array([1.0]))[0] == pytest.approx(-0.5772156649015329, abs=1e-10)


def test_blocks_hold_every_document(spark, monkeypatch):
    docs = planted(spark)
    for tokens in (lda.BLOCK_TOKENS, 11):
        monkeypatch.setattr(lda, "BLOCK_TOKENS", tokens)
        got = []
        rows = lda.blocks(docs, "id", "tokens").collect()
        for b in rows:
            for i, key in enumerate(b.ids):
                own = range(b.starts[i], b.starts[i + 1])
                got.append((key, sorted(t for j in own for t in [b.terms[b.at[j]]] * b.n[j])))
        key = lambda r: (str(r[0]), r[1])
        assert sorted(got, key=key) == sorted(((r.id, sorted(r.tokens)) for r in docs.collect()), key=key)
        assert len({b.block for b in rows}) == len(rows) and (tokens > 11 or len(rows) > 10)


def test_shares_equal_those_of_spark_ml(spark):
    docs = planted(spark)
    vectoriser = features.count_vectorizer_model(docs, "tokens")
    counts = vectoriser.transform(docs)
    model = models.lda(k=2, max_iter=8, doc_concentration=[0.4, 0.2], topic_concentration=0.1).fit(counts)
    x = model.topicsMatrix().toArray()
    table = spark.createDataFrame([(t, x[i].tolist()) for i, t in enumerate(vectoriser.vocabulary)], "term string, x array<double>")
    alpha = tuple(model.estimatedDocConcentration().toArray())
    topics = lda.Topics(table, tuple(x.sum(axis=0)), alpha)
    order = lambda rows: sorted(rows, key=lambda r: (str(r[0]), r[1]))
    got = order([(r.id, r.shares) for r in topics.shares(lda.blocks(docs, "id", "tokens")).collect()])
    want = order([(r.id, r.topicDistribution.toArray().tolist()) for r in model.transform(counts).collect()])
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want], atol=2e-3)
    heaviest = [(r.topic, [vectoriser.vocabulary[i] for i in r.termIndices]) for r in model.describeTopics(3).collect()]
    described = topics.described(3)
    assert [(t, [d[2] for d in described if d[0] == t]) for t in (0, 1)] == heaviest


def test_a_fit_takes_the_steps_of_online_lda(spark, monkeypatch):
    """Two iterations, document by document, from the same draws."""
    docs, alpha, eta, k = planted(spark), np.array([0.4, 0.2]), 0.1, 2
    held = lda.blocks(docs, "id", "tokens")
    start = {r.term: np.array(r.x) for r in lda._drawn(held, k, 1).collect()}
    names = sorted(start)
    x, own = np.stack([start[n] for n in names]), [r.tokens for r in docs.collect() if r.tokens]
    for i in (1, 2):
        rate = (1024 + i) ** -0.51
        beta = np.exp(lda.digamma(x) - lda.digamma(x.sum(axis=0)))
        stats, logs = np.zeros_like(x), np.zeros(k)
        for tokens in own:
            at = [names.index(t) for t in tokens]
            gamma = np.ones(k)
            while True:
                theta = np.exp(lda.digamma(gamma) - lda.digamma(gamma.sum()))
                new = theta * (beta[at] / (beta[at] @ theta)[:, None]).sum(axis=0) + alpha
                done, gamma = np.abs(new - gamma).mean() <= 1e-3, new
                if done:
                    break
            e = lda.digamma(gamma) - lda.digamma(gamma.sum())
            theta, logs = np.exp(e), logs + e
            for a in at:
                stats[a] += theta * beta[a] / (beta[a] @ theta)
        x = (1 - rate) * x + rate * (stats + eta)
        n = len(own)
        g = logs - n * (lda.digamma(alpha) - lda.digamma(alpha.sum()))
        hessian = n * (lda.trigamma(alpha.sum()) - np.diag(lda.trigamma(alpha)))
        alpha = alpha - rate * np.linalg.solve(hessian, g)
    for layout in (held, lda.blocks(docs.repartition(7), "id", "tokens")):
        got = lda.fit(layout, 2, [0.4, 0.2], eta)
        rows = {r.term: r.x for r in got.table.collect()}
        assert np.allclose([rows[t] for t in names], x, atol=1e-9) and np.allclose(got.alpha, alpha)
        assert np.allclose(got.totals, x.sum(axis=0))


def test_planted_topics_are_found(spark):
    held = lda.blocks(planted(spark), "id", "tokens")
    topics = lda.fit(held, 20, [0.1, 0.1], 0.1)
    shares = {r.id: r.shares for r in topics.shares(held).collect() if r.id not in (None, 7, 99)}
    top = [int(np.argmax(shares[i])) for i in sorted(shares)]
    assert len({t for i, t in zip(sorted(shares), top) if i % 2}) == 1 and len(set(top)) == 2


def test_draws_have_mean_one_and_shape_100(spark):
    many = spark.range(4000).select("id", F.array(F.concat(F.lit("w"), "id")).alias("tokens"))
    x = np.array([r.x for r in lda._drawn(lda.blocks(many, "id", "tokens"), 2, 1).collect()])
    assert x.shape == (4000, 2) and abs(x.mean() - 1) < 0.01 and abs(x.std() - 0.1) < 0.005
    assert abs(np.corrcoef(x.T)[0, 1]) < 0.06


def test_documents_without_terms(spark):
    none = spark.createDataFrame([(1, []), (2, [])], "id long, tokens array<string>")
    for docs in (none, none.limit(0)):
        held = lda.blocks(docs, "id", "tokens")
        topics = lda.fit(held, 2, [3.0, 3.0], 3.0)
        assert topics.described(5) == []
        assert {r.id: r.shares for r in topics.shares(held).collect()} == {r.id: [0.0, 0.0] for r in docs.collect()}


def test_queries_keep_words_off_the_driver(spark, monkeypatch):
    from pyspark.ml.feature import CountVectorizer

    import __spark_entry__ as ent

    monkeypatch.setattr(CountVectorizer, "fit", lambda *a, **k: pytest.fail("a vocabulary on the driver"))
    rows = ent.queries()["lda_topics"](spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.topic, r["rank"]) for r in rows) == [(t, i) for t in range(3) for i in range(5)]


def test_blocks_reach_across_batches(spark, monkeypatch):
    """Small Arrow batches make neither small blocks nor another setting for the session."""
    monkeypatch.setattr(lda, "BATCH_ROWS", 3)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs, before = planted(spark), spark.conf.get(name)
    rows = lda.blocks(docs.coalesce(1), "id", "tokens").collect()
    assert len(rows) == 1 and len(rows[0].ids) == docs.count() and spark.conf.get(name) == before


def test_iterations_leave_no_tables_and_no_row_for_each_term(spark):
    import os

    from quarry.session import scratch_path

    held = lda.blocks(planted(spark).repartition(3), "id", "tokens")
    root = os.path.dirname(scratch_path(spark, "x"))
    made = []
    for n in (1, 4):
        before = set(os.listdir(root))
        topics = lda.fit(held, n, [0.4, 0.2], 0.1)
        made.append(sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before))
    assert made[0] == made[1] and made[0].count("lda-weights") == 1
    rows = lda._statistics(topics.seen, topics.weights, np.array(topics.totals), np.array(topics.alpha))
    assert "Generate" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 2 * held.where("size(terms) > 0").count()  # one bucket, and the documents' sums
    assert topics.table.count() == held.select(F.explode("terms")).distinct().count()


def test_documents_of_all_sizes_are_inferred_alike(monkeypatch):
    rng = np.random.default_rng(3)
    sizes = rng.permutation([0, 0, 1, 1, 2, 3, 5, 8, 40, 41])
    starts = np.append(0, np.cumsum(sizes))
    beta, alpha = rng.gamma(1.0, 1.0, (50, 3)), np.array([0.4, 0.2, 0.3])
    at, n = rng.integers(0, 50, starts[-1]), rng.integers(1, 4, starts[-1])
    want = np.ones((len(sizes), 3))
    for i in np.flatnonzero(sizes):
        own, moved = slice(starts[i], starts[i + 1]), True
        while moved:
            theta = np.exp(lda.digamma(want[i]) - lda.digamma(want[i].sum()))
            new = theta * ((n[own] / (beta[at[own]] @ theta)) @ beta[at[own]]) + alpha
            moved, want[i] = np.abs(new - want[i]).mean() > 1e-3, new
    for cached in (1, 10, lda.CACHED):
        monkeypatch.setattr(lda, "CACHED", cached)
        assert np.allclose(lda.inferred(beta, alpha, starts, at, n), want)


def test_bytes_come_back_as_they_were():
    import pyarrow as pa

    x = np.arange(12, dtype=np.int32)
    t = pa.table({"x": pa.concat_arrays([lda.bytes_of(x, np.array([0, 5, 5, 12])), pa.array([None], pa.binary())]).slice(1)})
    assert lda.numbers(t, "x", np.int32).tolist() == x[5:].tolist()
    assert lda.numbers(t.slice(0, 0), "x", np.int32).size == 0
    for values in ([], [0, 255], [7, 70_000, 2**40]):
        got = lda.unpacked(pa.table({"x": lda.packed(np.array(values, np.int64))}), "x")
        assert got.tolist() == values


def test_facts_of_every_document(spark, monkeypatch, tmp_path):
    """Over many blocks and buckets, with ids that repeat or are null and texts without words."""
    import __spark_entry__ as ent

    monkeypatch.setattr(lda, "BUCKET_PAIRS", 20)
    monkeypatch.setattr(lda, "BLOCK_TOKENS", 60)
    texts = [(i % 25 if i % 7 else None, f"word{i % 11} other{i % 5} only{i} again{i % 3}" if i % 9 else "") for i in range(40)]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(lda, "_met", lambda *a: pytest.fail("a row for each term of a block"))
    rows = ent.queries()["lda_doc_topics_facts"](spark, str(tmp_path)).collect()
    assert all(r.valid for r in rows) and sorted(str(r.doc_id) for r in rows) == sorted(str(t[0]) for t in texts)


def test_heaviest_terms_are_those_of_the_whole_table(spark, monkeypatch):
    """Over many buckets, with ties."""
    monkeypatch.setattr(lda, "BUCKET_PAIRS", 2)
    topics = lda.fit(lda.blocks(planted(spark), "id", "tokens"), 2, [0.4, 0.2], 0.1)
    assert topics.weights.where("bucket >= 0").count() > 2
    for most in (1, 3, 20):
        assert topics.described(most) == lda.Topics(topics.table, topics.totals, topics.alpha).described(most)
    tied = topics.weights.withColumn("x", F.when(F.col("bucket") >= 0, F.unhex(F.repeat(F.lit("000000000000F03F"), (F.length("x") / 8).cast("int")))))
    even = lda.Topics(lda._terms(topics.seen, tied, 2), (1.0, 1.0), topics.alpha, topics.seen, tied)
    assert [d[2] for d in even.described(3)] == ["bank", "bird", "bond"] * 2
