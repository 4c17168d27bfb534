"""Distance-based anomaly scoring (M07 with k = 1, M11, K02, T09).

Standardise the columns (population stddev, zero -> 1), take the single k-means
centre (k = 1 is the column mean, which Spark's ``KMeans`` does not accept), score
each row by its squared distance to the centre, and flag rows whose distance
reaches the k-th largest distance.  Statistics and the threshold are scalar
subqueries; the threshold subquery ships only ``k`` values per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def single_center(df: DataFrame, cols: Sequence[str], prefix: str = "center_") -> DataFrame:
    """The k = 1 k-means centre: one row with the mean of every column, and ``n``."""
    return df.agg(*[F.avg(c).alias(f"{prefix}{c}") for c in cols], F.count(F.lit(1)).alias("n"))


def standard_distance(df: DataFrame, cols: Sequence[str], alias: str = "distance") -> DataFrame:
    """Squared distance of each row to the centre of the z-scores, in one pass over ``df``
    for the statistics and one for the rows.

    The centre of z-scores (population stddev) is zero, so no pass looks for it: the
    distance is the sum of the squared z-scores.  All means and stddevs are one row of
    one aggregate, read as one scalar subquery.
    """
    stats = df.select(
        F.struct(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
            *[F.stddev_pop(c).alias(f"d{i}") for i, c in enumerate(cols)],
        ).alias("s")
    ).scalar()
    dist = F.lit(0.0)
    for i, c in enumerate(cols):
        sd = stats[f"d{i}"]
        scale = F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
        dist = dist + F.pow((F.col(c) - stats[f"m{i}"]) / scale, 2)
    return df.withColumn(alias, dist)


def squared_distance(df: DataFrame, cols: Sequence[str], alias: str = "distance") -> DataFrame:
    """Squared Euclidean distance of each row to the column-mean centre."""
    dist = F.lit(0.0)
    for c in cols:
        centre = df.select(F.avg(c)).scalar()
        dist = dist + F.pow(F.col(c) - centre, 2)
    return df.withColumn(alias, dist)


def distance_threshold(df: DataFrame, cols: Sequence[str], k: int = 2000):
    """The k-th largest squared distance as a scalar column (T09 over M11 scores)."""
    scored = standard_distance(df, cols, "_d")
    return scored.select("_d").orderBy(F.desc("_d")).limit(k).select(F.min("_d")).scalar()


def anomaly_scores(
    df: DataFrame, cols: Sequence[str], k: int = 2000, alias: str = "distance"
) -> DataFrame:
    """Rows with their distance, the threshold (k-th largest distance; with fewer than
    k rows the smallest) and ``is_anomaly = distance >= threshold``."""
    scored = standard_distance(df, cols, alias)
    return scored.withColumn("threshold", distance_threshold(df, cols, k)).withColumn(
        "is_anomaly", F.col(alias) >= F.col("threshold")
    )


def anomaly_model(df: DataFrame, cols: Sequence[str], k: int = 2000) -> DataFrame:
    """The model artefact as a one-row table: centre (raw units) and threshold."""
    centre = single_center(df, cols).drop("n")
    return centre.select("*", distance_threshold(df, cols, k).alias("threshold"))
