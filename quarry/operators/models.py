"""Models, tuning and inspection.

Estimators are Spark ML (distributed fits, ``Pipeline`` / ``CrossValidator`` /
``TrainValidationSplit``).  Multinomial naive Bayes is also written as joins and
grouped sums over the long ``(doc, term, tf)`` form, which gives the same model as
``pyspark.ml.classification.NaiveBayes`` on count vectors and can be checked in SQL.

Splits are hash splits on the row key (``functions.sampling``), never
``randomSplit``: the same rows land in the same split on every rerun, partitioning
and engine.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.clustering import LDA
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from quarry.functions.sampling import hash_bucket, hash_split_flag
from quarry.plans.strategies import broadcast_if_small
from quarry.session import stored


def hash_split(df: DataFrame, key: str, fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by a hash of ``key``."""
    flag = hash_split_flag(key, seed, fraction)
    return df.where(flag), df.where(~flag)


#: rows a part of a tree's training data holds; as dense bins of a few hundred features, 100 MB
ROWS_PER_PART = 100_000


def in_bounded_parts(df: DataFrame, key: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """The rows in parts of about ``rows_per_part``, for fits that keep a wide copy of every part.

    A part of the scan is bounded in bytes of the file, and its rows may be a hundred times wider
    as features.  The parts are hashes of ``key``, sorted by it, so that what a fit samples does not
    depend on the files.  Tables within the bound stay as they are.
    """
    parts = -(-df.count() // rows_per_part)
    return df.repartition(parts, key).sortWithinPartitions(key) if parts > 1 else df


def coefficients_frame(spark: SparkSession, names: Sequence[str], model) -> DataFrame:
    """Model weights as ``(feature, weight)`` rows plus the intercept."""
    rows = [(n, float(w)) for n, w in zip(names, model.coefficients.toArray())]
    rows.append(("(intercept)", float(model.intercept)))
    return spark.createDataFrame(rows, "feature string, weight double")


def objective_history(spark: SparkSession, model) -> DataFrame:
    """Training trace ``(iteration, loss)`` of a fitted model with a summary."""
    hist = model.summary.objectiveHistory
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, loss double")


def logistic(max_iter: int = 100, reg: float = 0.0, elastic: float = 0.0, features: str = "features", label: str = "label") -> LogisticRegression:
    return LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic, featuresCol=features, labelCol=label)


def naive_bayes_fit_score(
    train: DataFrame,
    train_labels: DataFrame,
    test: DataFrame,
    test_docs: DataFrame,
    id_col: str,
    label_col: str,
    classes: Sequence,
    smoothing: float = 1.0,
    value: str = "tf",
) -> DataFrame:
    """Fit multinomial naive Bayes on ``train`` (id, term, value) with ``train_labels`` and
    score the documents of ``test_docs`` by their rows in ``test`` (M05).

    ``pi_c = ln(n_c + λ) - ln(n + Kλ)``; ``theta_cj = ln(N_cj + λ) - ln(N_c + λV)``
    with ``V`` the number of distinct training terms; values may be counts or weights.
    Terms that no training document has are left out of a score.  A term absent from a
    class contributes ``ln(λ) - ln(N_c + λV)``, so the per-class term table is pivoted once
    and joined on the term.  Returns the columns of ``test_docs``, ``score_<i>`` and
    ``prediction``; a document without known terms is scored by the class sizes alone.
    """
    lam, k = float(smoothing), len(classes)
    lt = train.join(train_labels.select(id_col, label_col), id_col)
    # the sizes of the classes come from this table too, not from the rows again
    per_term = stored(lt.groupBy("term").pivot(label_col, list(classes)).agg(F.sum(value)), "class-sums")
    logs = [F.log(F.coalesce(F.col(f"`{c}`"), F.lit(0)) + F.lit(lam)).alias(f"_l{i}") for i, c in enumerate(classes)]
    known = per_term.select("term", *logs)
    doc = test.join(known, "term").groupBy(id_col).agg(
        *[F.sum(F.col(value) * F.col(f"_l{i}")).alias(f"_s{i}") for i in range(k)], F.sum(value).alias("_tot")
    )
    v = per_term.select(F.count("term")).scalar()
    n = train_labels.select(F.count(F.lit(1))).scalar()
    out = test_docs.join(doc, id_col, "left")
    for i, c in enumerate(classes):
        n_c = train_labels.where(F.col(label_col) == F.lit(c)).select(F.count(F.lit(1))).scalar()
        big_n = per_term.select(F.sum(f"`{c}`")).scalar()
        pi = F.log(n_c + F.lit(lam)) - F.log(n + F.lit(k * lam))
        denom = F.log(F.coalesce(big_n, F.lit(0)) + F.lit(lam) * v)
        score = pi + F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) - F.coalesce(F.col("_tot"), F.lit(0)) * denom
        out = out.withColumn(f"score_{i}", score)
    best = F.lit(classes[0])
    best_score = F.col("score_0")
    for i in range(1, k):
        better = F.col(f"score_{i}") > best_score
        best = F.when(better, F.lit(classes[i])).otherwise(best)
        best_score = F.greatest(best_score, F.col(f"score_{i}"))
    return out.withColumn("prediction", best).drop(*[f"_s{i}" for i in range(k)], "_tot")


def naive_bayes_sweep(
    tf: DataFrame,
    labels: DataFrame,
    id_col: str,
    label_col: str,
    smoothings: Sequence[float],
    seeds: Sequence[int],
    fraction: float = 0.7,
    value: str = "tf",
) -> DataFrame:
    """``(smoothing, seed, accuracy)`` of two-class multinomial naive Bayes for every smoothing
    value on every hash split: the models of ``naive_bayes_fit_score``, and none is fitted (M15).

    The smoothing enters a score only through the logarithms of a term's class sums, so one
    table (seed, term) -> class sums is joined with the test rows once.  The joined rows are dealt
    by document, and the sums under all values are made behind that exchange: before it they would
    be as many numbers for every document and task.  ``label_col`` is 0 or 1, ``tf`` is (id, term, value); terms
    that no training document has are left out, ties go to class 0, an empty test part has no
    row.
    """
    grid = [float(x) for x in smoothings]
    splits = F.explode(F.array(*[F.struct(F.lit(s).alias("seed"), hash_split_flag(id_col, s, fraction).alias("train")) for s in seeds]))
    docs = labels.select(id_col, label_col, splits.alias("s")).select(id_col, label_col, "s.seed", "s.train")
    train = tf.join(docs.where("train"), id_col)
    one = F.col(label_col) == 1
    total = lambda only: F.coalesce(F.sum(F.when(only, F.col(value))), F.lit(0)).cast("double")
    per_term = train.groupBy("seed", "term").agg(total(~one).alias("n0"), total(one).alias("n1"))
    size = per_term.groupBy("seed").agg(F.count(F.lit(1)).alias("v"), F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    sizes = docs.where("train").groupBy("seed").agg(F.count_if(~one).alias("d0"), F.count_if(one).alias("d1")).join(size, "seed", "left")
    test = tf.join(docs.where("not train").select(id_col, "seed"), id_col).join(per_term, ["seed", "term"])
    test = test.select("seed", id_col, F.col(value).cast("double").alias("value"), "n0", "n1").repartition("seed", id_col)
    parts = _gains(test.sortWithinPartitions("seed", id_col), id_col, grid)
    sums = [F.sum(F.get("gain", i)).alias(f"g{i}") for i in range(len(grid))]
    scored = parts.groupBy("seed", id_col).agg(F.sum("length").alias("length"), *sums)
    found = docs.where("not train").join(scored, ["seed", id_col], "left").join(broadcast_if_small(sizes, len(seeds)), "seed")

    def margin(i: int, x: float):
        prior = F.log(F.col("d1") + F.lit(x)) - F.log(F.col("d0") + F.lit(x))
        t0, t1, v = (F.coalesce(c, F.lit(0.0)) for c in ("t0", "t1", "v"))
        base = F.log(t1 + F.lit(x) * v) - F.log(t0 + F.lit(x) * v)
        return prior + F.coalesce(f"g{i}", F.lit(0.0)) - F.coalesce("length", F.lit(0)) * F.coalesce(base, F.lit(0.0))

    right = [F.avg(((margin(i, x) > 0) == one).cast("double")).alias(f"a{i}") for i, x in enumerate(grid)]
    rows = F.array(*[F.struct(F.lit(x).alias("smoothing"), F.col(f"a{i}").alias("accuracy")) for i, x in enumerate(grid)])
    return found.groupBy("seed").agg(*right).select("seed", F.inline(rows)).select("smoothing", "seed", "accuracy")


def _gains(rows: DataFrame, id_col: str, grid: Sequence[float]) -> DataFrame:
    """(seed, id, length, gain): sums over a document's rows (seed, id, value, n0, n1), which stand
    together; ``gain`` has one for each smoothing value.  A document has a row for each batch."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.array(grid)
        for b in batches:
            if not b.num_rows:
                continue
            seed, ids = (b.column(i).dictionary_encode().indices.to_numpy() for i in (0, 1))
            new = (seed[1:] != seed[:-1]) | (ids[1:] != ids[:-1])
            at = np.flatnonzero(np.concatenate([[True], new]))
            value, n0, n1 = (b.column(i).to_numpy()[:, None] for i in (2, 3, 4))
            gain = np.add.reduceat(value * (np.log(n1 + x) - np.log(n0 + x)), at)
            first = b.select([0, 1]).take(pa.array(at))
            sums = [pa.array(np.add.reduceat(value[:, 0], at)), pa.array(list(gain), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*first.columns, *sums], ["seed", id_col, "length", "gain"])

    kept = rows.schema
    schema = StructType([kept["seed"], kept[id_col], StructField("length", DoubleType()), StructField("gain", ArrayType(DoubleType()))])
    return rows.mapInArrow(add, schema)


def naive_bayes_exact(
    tf: DataFrame, labels: DataFrame, id_col: str, label_col: str, classes: Sequence, smoothing: float = 1.0
) -> DataFrame:
    """Naive Bayes on counts, fitted on and scoring the labelled documents themselves."""
    docs = labels.select(id_col, label_col)
    return naive_bayes_fit_score(tf, docs, tf, docs, id_col, label_col, classes, smoothing)


def naive_bayes_ml(smoothing: float = 1.0, features: str = "counts", label: str = "label") -> NaiveBayes:
    return NaiveBayes(smoothing=smoothing, modelType="multinomial", featuresCol=features, labelCol=label)


def lda(
    k: int = 3,
    max_iter: int = 5,
    features: str = "counts",
    seed: int = 1,
    doc_concentration: Sequence[float] | None = None,
    topic_concentration: float | None = None,
    sampling: float = 1.0,
) -> LDA:
    """Online LDA (M08).  ``sampling`` is the share of documents an iteration sees (Spark's
    default is 5 %, so a few iterations would leave most of the corpus unread); the
    concentrations are Spark's defaults (``1 / k``) unless given."""
    est = LDA(
        k=k, maxIter=max_iter, optimizer="online", featuresCol=features, seed=seed, checkpointInterval=10,
        subsamplingRate=sampling,
    )
    if doc_concentration is not None:
        est = est.setDocConcentration(list(doc_concentration))
    if topic_concentration is not None:
        est = est.setTopicConcentration(topic_concentration)
    return est


def hash_folds(df: DataFrame, key: str, folds: int, seed: int, out: str = "fold") -> DataFrame:
    """A fold number per row from a hash of its key, for ``CrossValidator(foldCol=...)``:
    the same folds on every layout of the data (M13)."""
    return df.withColumn(out, hash_bucket(key, seed, folds).cast("int"))


def validated_sweep(train: DataFrame, validation: DataFrame, estimators: Sequence, evaluator, parallelism: int = 4) -> list[float]:
    """The metric of each estimator, fitted on ``train``, on ``validation``."""
    return parallel_fits([lambda e=e: float(evaluator.evaluate(e.fit(train).transform(validation))) for e in estimators], parallelism)


#: smoothing values of the naive Bayes sweep: 0.01, 0.02, ... 1.00
SMOOTHING_GRID = tuple(round(0.01 * i, 2) for i in range(1, 101))
#: iteration counts of the LDA sweep (fixed values)
ITERATION_GRID = (5, 10, 20, 40, 60, 120, 200, 500)


def lda_sweep(
    train: DataFrame,
    held: DataFrame,
    iterations: Sequence[int] = ITERATION_GRID,
    k: int = 3,
    doc_concentration: Sequence[float] | None = None,
    topic_concentration: float | None = None,
) -> list[tuple[int, float, float]]:
    """(iterations, log likelihood, log perplexity) on held-out count vectors."""
    out = []
    for n in iterations:
        model = lda(k, n, doc_concentration=doc_concentration, topic_concentration=topic_concentration).fit(train)
        out.append((n, float(model.logLikelihood(held)), float(model.logPerplexity(held))))
    return out


def parallel_fits(jobs, parallelism: int = 4) -> list:
    """Run independent fit closures from a driver thread pool; Spark schedules their
    jobs concurrently (M15)."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(lambda f: f(), jobs))
