"""Counts, dictionary lookups and parts that are made inside the rows, without shuffled tokens."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from quarry.operators import cooccurrence, features, models, text

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def docs(spark, again):
    rows = [(1, "a b a"), (2, ""), (3, None), (4, " "), (5, "the b c c c"), (6, "b")]
    rows += [(1, "a c"), (5, "c"), (None, "a a"), (None, "a d"), (6, "b")] if again else []
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("again", [False, True])
@pytest.mark.parametrize("stop", [None, ["the", "b"]])
def test_terms_of_documents_equal_the_grouped_rows(spark, again, stop):
    d, tokens = docs(spark, again), features.whitespace_tokens("text")
    want = features.term_counts(features.exploded_terms(d, "doc_id", tokens, stop), "doc_id")
    got = features.document_terms(d, "doc_id", tokens, stop)
    key = lambda r: (r.doc_id is None, r.doc_id, r.term)
    assert got.dtypes == want.dtypes and sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    assert again or "Exchange hashpartitioning" not in plan(got)


def test_null_tokens_and_empty_tables_have_no_terms(spark):
    d = spark.createDataFrame([(1, [None, "x", None, "x"]), (2, []), (3, None)], "doc_id long, t array<string>")
    assert features.document_terms(d, "doc_id", F.col("t")).collect() == [(1, "x", 2)]
    assert features.document_terms(d.limit(0), "doc_id", F.col("t")).collect() == []


def test_ngrams_shuffle_partial_counts_alone(spark):
    assert plan(ent.queries()["ngrams"](spark, SF)).count("Exchange hashpartitioning") == 1


def test_term_frequency_shuffles_no_term(spark):
    assert "Exchange hashpartitioning" not in plan(ent.queries()["term_frequency"](spark, SF))


def test_the_class_sums_are_written_once(spark):
    tf = spark.createDataFrame([(1, "good", 2), (2, "bad", 2), (3, "good", 1)], "doc_id long, term string, tf long")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    out = models.naive_bayes_fit_score(tf, labels, tf, spark.createDataFrame([(3,)], "doc_id long"), "doc_id", "quality", [0, 1])
    assert any("class-sums" in f for f in out.inputFiles()) and out.first().prediction == 1


def test_a_sweep_shuffles_no_row_of_sums(spark):
    """Sums under all values are made behind the exchange of a document's rows, in any number of batches."""
    rows = [(i, f"t{(i * 7 + j) % 11}", 1 + j % 3) for i in range(60) for j in range(i % 5)]
    tf = spark.createDataFrame(rows, "doc_id long, term string, tf long")
    labels = spark.createDataFrame([(i, i * 3 % 2) for i in range(60)], "doc_id long, quality int")
    grid, kept = (0.1, 0.5, 2.0), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = []
    for size in ("3", kept):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            swept = models.naive_bayes_sweep(tf, labels, "doc_id", "quality", grid, (1, 2))
            assert "MapInArrow" in plan(swept)
            found.append({(r.smoothing, r.seed): r.accuracy for r in swept.collect()})
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert found[0] == found[1] and len(found[0]) == 6
    for (x, seed), accuracy in found[0].items():
        train, test = models.hash_split(labels, "doc_id", 0.7, seed)
        part = tf.join(train.select("doc_id"), "doc_id", "left_semi")
        scored = models.naive_bayes_fit_score(part, train, tf, test, "doc_id", "quality", [0, 1], x)
        known = scored.agg(F.avg((F.col("prediction") == F.col("quality")).cast("double"))).first()[0]
        assert accuracy == pytest.approx(known)


def test_dictionary_words_are_found_inside_the_rows(spark):
    texts = [(1, ["b", "7", "x", "b", "é"]), (1, ["12", "3"]), (None, []), (3, None), (4, [None, "7", "", "b c"])]
    d = spark.createDataFrame(texts, "doc_id long, t array<string>")
    entries = [("b", "B", 2), ("b", "late", 3), ("7", "seven", 1), ("é", "e", 4), (None, "none", 5), ("x", None, 6)]
    words = spark.createDataFrame(entries, "word string, canonical string, entry_order int")
    inside = text.dictionary_substitute(d, "doc_id", F.col("t"), words, lookup_rows=100)
    joined = text.dictionary_substitute(d, "doc_id", F.col("t"), words, max_broadcast_rows=0, lookup_rows=4)
    assert sorted(map(str, inside.collect())) == sorted(map(str, joined.collect()))
    assert "#B#seven#x#B#e" in [r.substituted for r in inside.collect()]
    assert plan(inside).split("Subquery")[0].count("Exchange") == 0
    none = text.dictionary_substitute(d, "doc_id", F.col("t"), words.limit(0), lookup_rows=100)
    assert "#b#x#b#é" in [r.substituted for r in none.collect()]


def test_parts_hold_a_bounded_number_of_rows(spark):
    d = spark.range(0, 5000, 1, 1).withColumn("key", F.col("id").cast("string"))
    sizes = [r["count"] for r in models.in_bounded_parts(d, "key", 500).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 5000 and len(sizes) == 10 and max(sizes) < 1000
    assert models.in_bounded_parts(d, "key") is d


def test_pairs_are_counted_once_for_all_that_reads_them(spark):
    pairs = cooccurrence.pair_counts(spark.createDataFrame([("a b a c",)], "t string"), F.split("t", " "))
    matrix = cooccurrence.mutual_information(pairs)
    assert "Generate" not in plan(matrix) and any("pair-counts" in f for f in matrix.inputFiles())
