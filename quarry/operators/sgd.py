"""Gradient steps as native aggregates.

With the features as columns and the weights as literals, one SGD iteration is one
``agg``: ``err = σ(w·x) - y`` (logistic) or ``w·x - y`` (linear), ``g_i = Σ err·x_i``,
``n`` the number of rows with a gradient, that is without a null; then ``w_i -= step / sqrt(t) · g_i / n``.  The driver keeps only the
``d`` weights.  A mini-batch fraction is a hash sample of ``(row key, round, t)``,
so a rerun draws the same rows.  This equals ``pyspark.mllib``'s
``LogisticRegressionWithSGD`` / ``LinearRegressionWithSGD`` without regularisation,
with mini-batch fraction 1.0 (see tests).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def margin(features: Sequence[str], weights: Sequence[float], intercept: float = 0.0) -> Column:
    """``w·x + b`` as a column expression with literal weights."""
    m = F.lit(float(intercept))
    for f, w in zip(features, weights):
        m = m + F.col(f) * F.lit(float(w))
    return m


def predict(features: Sequence[str], weights: Sequence[float], loss: str) -> Column:
    """Prediction with literal weights: probability (logistic) or value (linear)."""
    m = margin(features, weights)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-m)) if loss == "logistic" else m


def _sample_flag(key: str | None, seed: int, t: int, fraction: float) -> Column:
    if fraction >= 1.0:
        return F.lit(True)
    if key is None:
        raise ValueError("a sample needs the rows' key")
    h = F.xxhash64(F.col(key), F.lit(seed), F.lit(t))
    return F.pmod(h, F.lit(1_000_000)) < F.lit(int(fraction * 1_000_000))


def sgd_steps(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    weights: Sequence[float],
    iterations: int,
    step: float,
    loss: str = "logistic",
    fraction: float = 1.0,
    key: str | None = None,
    seed: int = 0,
) -> list[list[float]]:
    """Run ``iterations`` SGD steps from ``weights``; returns the weights after each.

    Each step is one aggregate job over ``df`` (persist ``df`` around the call when it
    is expensive).  A step whose sample is empty leaves the weights unchanged.
    """
    if loss not in ("logistic", "linear"):
        raise ValueError("loss must be 'logistic' or 'linear'")
    w = [float(x) for x in weights]
    history = []
    for t in range(1, iterations + 1):
        err = predict(features, w, loss) - F.col(label)
        part = df.where(_sample_flag(key, seed, t, fraction))
        row = part.agg(F.count(err).alias("n"), *[F.sum(err * F.col(f)).alias(f"g{i}") for i, f in enumerate(features)]).first()
        n = row["n"]
        if n:
            lr = step / math.sqrt(t)
            w = [wi - lr * (row[f"g{i}"] or 0.0) / n for i, wi in enumerate(w)]
        history.append(list(w))
    return history
