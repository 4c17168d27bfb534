"""Linear models from sums of products: one scan for any number of penalties and folds.

A least-squares fit needs the data only through its centred moments: the number of rows, the
means, and the covariances of features and label.  ``moments`` gets them in one aggregate,
optionally per group (a fold, a split); moments of disjoint parts are merged exactly, so the
training part of every fold and the error on every held-out part follow from the same numbers.

``elastic_net`` minimises, with features and label divided by their population deviations,

    1/2n * sum (y - x.w - b)^2 + reg / sd(y) * ((1 - l1) / 2 * |w|^2 + l1 * |w|_1)

which is the objective of Spark ML's ``LinearRegression`` with its normal-equation solver, by
cyclic coordinate descent on the matrix of the moments (as wide as the features, whatever the
rows).  Rows with a null in any feature or the label are left out.  A feature or a label
without spread has coefficient 0; without rows a fit is null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.sampling import hash_bucket
from quarry.operators.sgd import margin

SWEEPS, TOLERANCE = 10_000, 1e-14


@dataclass(frozen=True)
class Moments:
    """Rows, means, and sums of centred products of the features and, last, the label."""

    n: int
    mean: np.ndarray
    spread: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, gap = self.n + other.n, other.mean - self.mean
        cross = np.outer(gap, gap) * (self.n * other.n / n)
        return Moments(n, self.mean + gap * (other.n / n), self.spread + other.spread + cross)


@dataclass(frozen=True)
class LinearFit:
    coefficients: tuple[float, ...]
    intercept: float


def moments(df: DataFrame, features: Sequence[str], label: str, by: str | None = None) -> dict:
    """Moments of each group of ``by`` (of all rows under the key None without it).

    One aggregate with a covariance for each pair of columns; the driver gets one row a group,
    so ``by`` must be bounded (folds, splits).
    """
    names = [*features, label]
    known = F.lit(True)
    for c in names:
        known = known & F.col(c).isNotNull()
    x = [F.when(known, F.col(c).cast("double")) for c in names]
    d = len(names)
    cells = [F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i in range(d) for j in range(i + 1)]
    found = df.groupBy(*([F.col(by).alias("by")] if by else [])).agg(
        F.count(x[0]).alias("n"), *[F.avg(v).alias(f"m{i}") for i, v in enumerate(x)], *cells
    )
    out = {}
    for r in found.collect():
        n, spread = r["n"], np.zeros((d, d))
        if n:
            for i in range(d):
                for j in range(i + 1):
                    spread[i, j] = spread[j, i] = r[f"c{i}_{j}"] * n
        mean = np.array([r[f"m{i}"] or 0.0 for i in range(d)])
        out[r["by"] if by else None] = Moments(n, mean, spread)
    return out


def elastic_net(m: Moments, reg: float = 0.0, l1: float = 0.0, sweeps: int = SWEEPS) -> LinearFit | None:
    """The fit on what ``m`` sums up; ``l1`` is the share of the absolute penalty."""
    if not m.n:
        return None
    sd = np.sqrt(np.maximum(np.diag(m.spread), 0) / m.n)
    scale = np.where(sd > 0, sd, 1.0)
    a = m.spread / m.n / np.outer(scale, scale)
    d = len(sd) - 1
    if sd[d] == 0:
        return LinearFit((0.0,) * d, float(m.mean[d]))
    hard, soft = reg * l1 / sd[d], reg * (1 - l1) / sd[d]
    w = _descend(a[:d, :d], a[:d, d], hard, soft, np.zeros(d), sweeps)
    coefficients = w * sd[d] / scale[:d]
    return LinearFit(tuple(map(float, coefficients)), float(m.mean[d] - coefficients @ m.mean[:d]))


def _descend(a: np.ndarray, b: np.ndarray, hard: float, soft: float, w: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """argmin of w.a.w / 2 - b.w + hard * |w|_1 + soft / 2 * |w|^2, coordinate by coordinate."""
    w = w.copy()
    for _ in range(sweeps):
        change = 0.0
        for j in range(len(w)):
            if a[j, j] + soft <= 0:
                continue
            z = b[j] - a[j] @ w + a[j, j] * w[j]
            new = np.sign(z) * max(abs(z) - hard, 0.0) / (a[j, j] + soft)
            change = max(change, abs(new - w[j]))
            w[j] = new
        if change <= TOLERANCE * max(1.0, np.abs(w).max(initial=0.0)):
            break
    return w


def mean_squared_error(m: Moments, fit: LinearFit) -> float | None:
    """The error of ``fit`` on the rows that ``m`` sums up."""
    if not m.n:
        return None
    c = np.append(-np.array(fit.coefficients), 1.0)  # the residual, before the intercept
    return float(c @ m.spread @ c / m.n + (c @ m.mean - fit.intercept) ** 2)


def predicted(features: Sequence[str], fit: LinearFit) -> Column:
    return margin(features, fit.coefficients, fit.intercept)


def validated_grid(train: Moments, held: Moments, grid: Sequence[tuple[float, float]]) -> list[tuple[float, float, float | None]]:
    """(reg, l1, rmse on ``held``) of every penalty, fitted on ``train``."""
    out = []
    for reg, l1 in grid:
        fit = elastic_net(train, reg, l1)
        error = mean_squared_error(held, fit) if fit else None
        out.append((reg, l1, None if error is None else max(error, 0.0) ** 0.5))
    return out


def fold_errors(
    df: DataFrame, features: Sequence[str], label: str, key: str, folds: int, seed: int, grid: Sequence[tuple[float, float]]
) -> list[tuple[float, float, int, float | None]]:
    """(reg, l1, fold, rmse) for every penalty and fold, from one scan: a fold's training part
    is the merged moments of the others.  Folds are a hash of the row key."""
    parts = moments(df.withColumn("_fold", hash_bucket(key, seed, folds).cast("int")), features, label, "_fold")
    empty = Moments(0, np.zeros(len(features) + 1), np.zeros((len(features) + 1,) * 2))
    out = []
    for fold in range(folds):
        train = sum((m for f, m in sorted(parts.items()) if f != fold), empty)
        out += [(reg, l1, fold, e) for reg, l1, e in validated_grid(train, parts.get(fold, empty), grid)]
    return out
