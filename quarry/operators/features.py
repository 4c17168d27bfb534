"""Feature engineering.

Text features use Spark ML transformers (``Tokenizer``, ``RegexTokenizer``,
``StopWordsRemover``, ``NGram``, ``HashingTF``, ``IDF``, ``CountVectorizer``,
``Word2Vec``); categorical features use ``StringIndexer`` / ``OneHotEncoder`` /
``VectorAssembler`` in one ``Pipeline`` (one fit job per stage, multi-column).

Exact twins in long form ``(doc, term, value)`` are built with joins and grouped
counts, so they stay distributed and can be checked against SQL; the vector forms
are model inputs.  Standardisation uses scalar subqueries (Catalyst merges them into
one aggregate job) instead of a cross join with a statistics row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    Binarizer,
    CountVectorizer,
    HashingTF,
    IndexToString,
    NGram,
    OneHotEncoder,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
    Word2Vec,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import jvm_split
from quarry.plans.strategies import broadcast_if_small, global_position


def default_stop_words() -> list[str]:
    """Spark's default English stop-word list (same as ``loadDefaultStopWords``)."""
    text = resources.files("quarry.functions").joinpath("english_stop_words.txt").read_text()
    return [w for w in text.splitlines() if w]


def tokenize(df: DataFrame, col: str, out: str = "tokens") -> DataFrame:
    """Lower-case and split on single whitespace."""
    return Tokenizer(inputCol=col, outputCol=out).transform(df)


def tokenize_regex(df: DataFrame, col: str, out: str = "tokens", pattern: str = "\\W") -> DataFrame:
    """Lower-case, split on a gap pattern, drop empty tokens."""
    return RegexTokenizer(inputCol=col, outputCol=out, pattern=pattern, gaps=True, minTokenLength=1).transform(df)


def remove_stop_words(
    df: DataFrame, col: str, out: str = "filtered", extra: Sequence[str] = ()
) -> DataFrame:
    """Drop stop words, case-insensitively (E03); ``extra`` adds to the default list."""
    words = default_stop_words() + [w for w in extra if w not in default_stop_words()]
    return StopWordsRemover(inputCol=col, outputCol=out, stopWords=words).transform(df)


def ngrams(df: DataFrame, col: str, n: int = 2, out: str = "ngrams") -> DataFrame:
    """Space-joined word n-grams (E05); fewer than ``n`` tokens give an empty array."""
    return NGram(n=n, inputCol=col, outputCol=out).transform(df)


def hashing_tf(df: DataFrame, col: str, num_features: int = 1 << 18, out: str = "tf") -> DataFrame:
    """Hashed term frequencies."""
    return HashingTF(inputCol=col, outputCol=out, numFeatures=num_features).transform(df)


def whitespace_tokens(col: Column | str) -> Column:
    """Built-in twin of ``Tokenizer``: lower-case, JVM split on single whitespace.

    Plain column expressions (codegen, no UDF), for pipelines that only need the
    tokens and not an ML stage.
    """
    c = F.col(col) if isinstance(col, str) else col
    return jvm_split(F.lower(c), "\\s")


def exploded_terms(
    df: DataFrame, id_col: str, tokens: Column, stop_words: Sequence[str] | None = None
) -> DataFrame:
    """``(id, term)`` rows; stop words removed by a broadcast ``left_anti`` join.

    ``explode_outer`` + a null filter instead of ``explode``: ``explode`` makes
    Catalyst infer a ``size(tokens) > 0`` filter that evaluates the tokenizer a
    second time.  The stop words come from the caller as a list, so their number is known
    and bounds the broadcast.
    """
    terms = df.select(id_col, F.explode_outer(tokens).alias("term")).where(F.col("term").isNotNull())
    return _without(terms, stop_words) if stop_words else terms


def _without(terms: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    stop = terms.sparkSession.createDataFrame([(w,) for w in dict.fromkeys(stop_words)], "term string")
    return terms.join(broadcast_if_small(stop, known_max_rows=len(stop_words)), "term", "left_anti")


def _counted(sorted_tokens: str) -> Column:
    """The runs of equal elements of a sorted array column: array of (term, tf)."""
    s = F.col(sorted_tokens)
    length = lambda at, j: F.coalesce(F.get(F.col("_starts"), j + 1), F.size(s)) - at
    return F.transform("_starts", lambda at, j: F.struct(F.get(s, at).alias("term"), length(at, j).cast("bigint").alias("tf")))


def document_terms(
    docs: DataFrame, id_col: str, tokens: Column, stop_words: Sequence[str] | None = None
) -> DataFrame:
    """``(id, term, tf)``: ``term_counts`` of ``exploded_terms``, counted inside each row.

    A row's tokens are sorted and their runs counted, so no token is shuffled.  Rows that share
    their id (null is an id too) are counted by an exchange, and only those; the ids that repeat
    are found by a job over the id column while the plan is built.
    """
    runs = docs.select(id_col, F.sort_array(F.array_compact(tokens)).alias("_tokens"))
    starts = F.transform("_tokens", lambda t, i: F.when((i == 0) | (t != F.get("_tokens", i - 1)), i))
    runs = runs.select(id_col, "_tokens", F.array_compact(starts).alias("_starts"))
    # inline_outer for the reason given in exploded_terms
    counted = runs.select(id_col, F.inline_outer(_counted("_tokens"))).where(F.col("term").isNotNull())
    if stop_words:
        counted = _without(counted, stop_words).select(id_col, "term", "tf")
    again = docs.groupBy(F.col(id_col).alias("_again")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_again")
    if again.isEmpty():
        return counted
    shared = F.col(id_col).eqNullSafe(F.col("_again"))
    ids = broadcast_if_small(again)
    merged = counted.join(ids, shared, "left_semi").groupBy(id_col, "term").agg(F.sum("tf").alias("tf"))
    return counted.join(ids, shared, "left_anti").unionByName(merged)


def token_slices(batch: pa.RecordBatch, name: str, tokens: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``tokens`` elements in the list column ``name``, or one row."""
    ends = np.cumsum(batch.column(name).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + tokens, "right")))
        yield batch.slice(first, last - first)
        first = last


def term_counts(terms: DataFrame, id_col: str) -> DataFrame:
    """``(id, term, tf)`` from ``(id, term)`` rows (partial aggregate)."""
    return terms.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_frequency(df: DataFrame, id_col: str, tokens: str) -> DataFrame:
    """Exact term counts per document, long form ``(id, term, tf)`` (E06 twin)."""
    return (
        df.select(id_col, F.explode(tokens).alias("term"))
        .groupBy(id_col, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def tf_idf(tf: DataFrame, id_col: str, n_docs: Column | None = None) -> DataFrame:
    """TF-IDF in long form with Spark's ``IDF`` formula ``ln((m + 1) / (df + 1))``.

    ``m`` is the number of documents -- pass it (e.g. ``docs.select(count).scalar()``,
    which also counts documents without any term, as ``IDF`` does); by default the
    documents present in ``tf``.  ``df`` is the number of documents holding the term.
    """
    m = n_docs if n_docs is not None else tf.select(F.count_distinct(id_col)).scalar()
    dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))
    idf = F.log((m + F.lit(1.0)) / (F.col("doc_freq") + F.lit(1.0)))
    # one row per term: AQE broadcasts it at runtime when its measured size is small,
    # else keeps the shuffle join and splits hot terms
    return tf.join(dfreq, "term").select(
        id_col, "term", "tf", "doc_freq", idf.alias("idf"), (F.col("tf") * idf).alias("tfidf")
    )


def vocabulary(tf: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``CountVectorizer`` vocabulary (E09): terms by corpus count desc, then term.

    ``(term, term_index, corpus_count, doc_freq)``; the index is a distributed
    position, not a single-partition window.
    """
    counts = tf.groupBy("term").agg(
        F.sum("tf").alias("corpus_count"), F.count(F.lit(1)).alias("doc_freq")
    )
    ranked = global_position(counts, [F.desc("corpus_count"), F.asc("term")], pos_col="_p")
    return ranked.select("term", (F.col("_p") - 1).alias("term_index"), "corpus_count", "doc_freq")


def count_vectorizer_model(df: DataFrame, col: str, out: str = "counts", vocab_size: int | None = None, min_df: float = 1.0):
    """Fitted ``CountVectorizer`` (sparse count vectors for model input).

    Without ``vocab_size`` the vocabulary is as large as the number of distinct terms: the
    ML default keeps 262,144 and drops the rest without a word.  The model holds its
    vocabulary on the driver; for an unbounded one use ``hashing_tf`` or the long form.
    """
    if vocab_size is None:
        vocab_size = max(1, df.select(F.explode_outer(col).alias("t")).agg(F.count_distinct("t")).first()[0])
    return CountVectorizer(inputCol=col, outputCol=out, vocabSize=vocab_size, minDF=min_df).fit(df)


def word2vec_model(df: DataFrame, col: str, size: int = 100, min_count: int = 1, max_iter: int = 1, seed: int = 42, out: str = "w2v", partitions: int = 8):
    """``Word2Vec``; a document vector is the mean of its word vectors.

    Training runs in ``partitions`` parts, a parameter of the model: the result depends on
    it and must not change with the number of cores.  (Spark's default of one would put the
    whole corpus in one task.)  Its vocabulary lives on the driver; ``min_count`` bounds it.
    """
    return Word2Vec(
        inputCol=col, outputCol=out, vectorSize=size, minCount=min_count, maxIter=max_iter,
        seed=seed, numPartitions=partitions,
    ).fit(df)


def string_indexer(input_cols: Sequence[str], output_cols: Sequence[str], handle_invalid: str = "error") -> StringIndexer:
    """Most frequent value -> 0.0, ties alphabetical.

    ``handle_invalid="keep"`` maps values unseen at fit time to one extra index (use it
    when the indexer is fitted on a training split only).
    """
    return StringIndexer(
        inputCols=list(input_cols), outputCols=list(output_cols),
        stringOrderType="frequencyDesc", handleInvalid=handle_invalid,
    )


def index_to_string(col: str, out: str, labels: Sequence[str]) -> IndexToString:
    """Index back to its label."""
    return IndexToString(inputCol=col, outputCol=out, labels=list(labels))


def one_hot(input_cols: Sequence[str], output_cols: Sequence[str], drop_last: bool = True) -> OneHotEncoder:
    """One-hot encoding, last category dropped by default."""
    return OneHotEncoder(inputCols=list(input_cols), outputCols=list(output_cols), dropLast=drop_last)


def assemble(input_cols: Sequence[str], out: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """Columns into one vector (E13); ``handle_invalid='skip'`` drops rows with nulls."""
    return VectorAssembler(inputCols=list(dict.fromkeys(input_cols)), outputCol=out, handleInvalid=handle_invalid)


def binarize(df: DataFrame, col: str, threshold: float, out: str) -> DataFrame:
    """1.0 where ``col > threshold`` else 0.0."""
    return Binarizer(threshold=threshold, inputCol=col, outputCol=out).transform(df)


def standardize(df: DataFrame, cols: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Z-scores with the **population** stddev; a zero stddev divides by 1.

    Means and stddevs are scalar subqueries: one aggregate job, inlined as literals,
    no cross join and nothing collected by the caller.
    """
    out = df
    for c in cols:
        mean = df.select(F.avg(c)).scalar()
        sd = df.select(F.stddev_pop(c)).scalar()
        scale = F.when((sd.isNull()) | (sd == 0), F.lit(1.0)).otherwise(sd)
        out = out.withColumn(f"{prefix}{c}", (F.col(c) - mean) / scale)
    return out


def categorical_pipeline(cat_cols: Sequence[str], num_cols: Sequence[str], out: str = "features") -> Pipeline:
    """Index -> one-hot -> assemble chain for click-through style data.

    Input columns are de-duplicated (a repeated column would make the indexer fail).
    """
    cats = list(dict.fromkeys(cat_cols))
    idx = [f"{c}_index" for c in cats]
    vec = [f"{c}_vec" for c in cats]
    return Pipeline(stages=[
        string_indexer(cats, idx),
        one_hot(idx, vec),
        assemble([*vec, *num_cols], out=out, handle_invalid="skip"),
    ])
