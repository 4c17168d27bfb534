"""Model evaluation as exact aggregates.

Curves are computed on distinct scores: one grouped count of positives and
negatives per score, then running sums along the descending score (distributed
prefix sums, no single-partition window).  Rows without a score, a prediction or a label
are left out of every metric; ``confusion_counts`` says how many there were.  AUC is the tie-aware rank statistic
``Σ_s pos_s · (neg_below_s + neg_s / 2) / (P · N)``, the same number as the
trapezoid area under the exact ROC curve.  Counts, accuracy and regression metrics
are one aggregate each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.plans.strategies import prefix_sums


def _lab(label: str) -> Column:
    return F.col(label).cast("int")


def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """``(threshold, pos, neg)`` per distinct score; labels are 0/1.  Rows with a null score or
    label are in neither."""
    return df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.sum(_lab(label)).cast("bigint").alias("pos"),
        F.sum(1 - _lab(label)).cast("bigint").alias("neg"),
    )


def binary_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact ROC / PR points, one per distinct score.

    ``(threshold, tp, fp, tpr, fpr, precision, recall)`` where a row predicts
    positive when ``score >= threshold``.
    """
    g = score_counts(df, score, label)
    total_p = g.select(F.sum("pos")).scalar()
    total_n = g.select(F.sum("neg")).scalar()
    cum = prefix_sums(g, [F.desc("threshold")], ["pos", "neg"])
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    return cum.select(
        "threshold",
        "pos",
        "neg",
        tp.alias("tp"),
        fp.alias("fp"),
        F.try_divide(tp.cast("double"), total_p).alias("tpr"),
        F.try_divide(fp.cast("double"), total_n).alias("fpr"),
        F.try_divide(tp.cast("double"), (tp + fp).cast("double")).alias("precision"),
        F.try_divide(tp.cast("double"), total_p).alias("recall"),
        F.lit(total_p).alias("_p"),
        F.lit(total_n).alias("_n"),
    )


def roc_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """``(threshold, tp, fp, tpr, fpr)``: the points of ``binary_curve`` between the end
    points (0, 0), where nothing is predicted positive, and (1, 1); their threshold is null."""
    c = binary_curve(df, score, label)
    points = c.select("threshold", "tp", "fp", "tpr", "fpr")
    totals = score_counts(df, score, label).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    kind = points.schema["threshold"].dataType
    zero, one = F.lit(0).cast("bigint"), F.lit(1.0)
    start = F.struct(F.lit(None).cast(kind).alias("threshold"), zero.alias("tp"), zero.alias("fp"), (one * 0).alias("tpr"), (one * 0).alias("fpr"))
    end = F.struct(F.lit(None).cast(kind).alias("threshold"), F.col("p").alias("tp"), F.col("n").alias("fp"), one.alias("tpr"), one.alias("fpr"))
    ends = totals.select(F.explode(F.array(start, end)).alias("e")).select("e.*")
    return points.unionByName(ends)


def area_under_roc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Tie-aware AUC (V03, V12) as a one-row DataFrame."""
    c = binary_curve(df, score, label)
    contrib = F.col("pos") * ((F.col("_n") - F.col("fp")) + F.col("neg") * 0.5)
    pairs = F.first("_p").cast("double") * F.first("_n").cast("double")  # beyond a bigint at scale
    return c.agg(F.try_divide(F.sum(contrib), pairs).alias("auc"))


def best_f1_threshold(df: DataFrame, score: str, label: str) -> DataFrame:
    """Threshold with the highest F1 (V11); ties go to the larger threshold."""
    c = binary_curve(df, score, label)
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return (
        c.select("threshold", f1.alias("f1"))
        .where(F.col("f1").isNotNull())
        .orderBy(F.desc("f1"), F.desc("threshold"))
        .limit(1)
    )


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """tp / fp / tn / fn, total, correct, wrong and wrong ratio in one pass.
    ``total`` counts the rows that have both; ``missing`` are the others."""
    y, p = _lab(label), _lab(prediction)
    both = y.isNotNull() & p.isNotNull()
    return df.agg(
        F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"),
        F.count(F.when((y == 0) & (p == 1), 1)).alias("fp"),
        F.count(F.when((y == 0) & (p == 0), 1)).alias("tn"),
        F.count(F.when((y == 1) & (p == 0), 1)).alias("fn"),
        F.count(F.when(both, 1)).alias("total"),
        F.count(F.when(y == p, 1)).alias("correct"),
        F.count(F.when(y != p, 1)).alias("wrong"),
        F.count(F.when(~both, 1)).alias("missing"),
    ).withColumn("wrong_ratio", F.try_divide(F.col("wrong").cast("double"), F.col("total")))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of rows with ``label == prediction`` (V06 micro precision, V07), of those that
    have both; null without any."""
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def weighted_precision_recall(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Support-weighted precision and recall over classes.

    A class that is never predicted has precision 0, as in Spark's
    ``MulticlassMetrics``.
    """
    df = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    n = df.select(F.count(F.lit(1))).scalar()
    support = df.groupBy(F.col(label).alias("cls")).agg(F.count(F.lit(1)).alias("support"))
    predicted = df.groupBy(F.col(prediction).alias("cls")).agg(F.count(F.lit(1)).alias("predicted"))
    tp = df.where(F.col(label) == F.col(prediction)).groupBy(F.col(label).alias("cls")).agg(
        F.count(F.lit(1)).alias("tp")
    )
    per = support.join(predicted, "cls", "left").join(tp, "cls", "left").fillna(0, ["predicted", "tp"])
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), F.lit(0.0))
    rec = F.try_divide(F.col("tp").cast("double"), F.col("support"))
    w = F.col("support") / n
    return per.agg(F.sum(w * prec).alias("weighted_precision"), F.sum(w * rec).alias("weighted_recall"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """MSE, RMSE, MAE, r² and mean residual in one aggregate.

    Rows with a null label or prediction have no residual and are left out.  The total
    sum of squares comes from ``var_pop``, which stays exact where the values are large
    and close together.
    """
    res = F.col(label) - F.col(prediction)
    agg = df.agg(
        F.count(res).alias("n"),
        F.sum(res * res).alias("ss_res"),
        F.sum(F.abs(res)).alias("sae"),
        F.sum(res).alias("sr"),
        F.var_pop(F.when(res.isNotNull(), F.col(label))).alias("var"),
    )
    ss_tot = F.col("var") * F.col("n")
    mse = F.try_divide(F.col("ss_res"), F.col("n"))
    return agg.select(
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.try_divide(F.col("sae"), F.col("n")).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.col("ss_res"), ss_tot)).alias("r2"),
        F.try_divide(F.col("sr"), F.col("n")).alias("mean_residual"),
    )
