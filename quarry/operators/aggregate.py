"""Grouped and global aggregates.

Every aggregate here is algebraic (partial on the map side, final after the
shuffle), so a hot group costs one partial row per map task.  Column moments are
computed in one pass with numerically stable built-ins (``stddev_pop``), not with
the ``n*Σx² - (Σx)²`` form that can go negative.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

_AGGS = {
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "count": F.count,
    "stddev": F.stddev_samp,
    "stddev_pop": F.stddev_pop,
    "variance": F.var_samp,
    "first": F.first,
}


def agg_spec(df: DataFrame, group_cols: Sequence[str], spec: Mapping[str, str] | Sequence[tuple[str, str]]) -> DataFrame:
    """Aggregates given as data (A04): ``{col: fn}`` or ``[(col, fn), ...]``.

    Output columns are named ``<fn>_<col>`` so that several functions on one column
    do not collide.
    """
    pairs = list(spec.items()) if isinstance(spec, Mapping) else list(spec)
    exprs = []
    for col, fn in pairs:
        if fn not in _AGGS:
            raise ValueError(f"unknown aggregate {fn!r}")
        if col not in df.columns:
            raise ValueError(f"unknown column {col!r}")
        exprs.append(_AGGS[fn](F.col(col)).alias(f"{fn}_{col}"))
    return df.groupBy(*group_cols).agg(*exprs)


def describe_typed(df: DataFrame, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """``describe()`` (A01): count, mean, stddev (sample), min, max per column, one row per
    statistic.  One aggregate job, then an unpivot.

    Numeric columns give typed doubles (rounded only if ``digits`` is given).  If any column
    is not numeric, all values are strings, as in ``DataFrame.describe``: such a column has
    a count, a smallest and a largest value and no moments.
    """
    stats = ["count", "mean", "stddev", "min", "max"]
    numeric = {c for c in cols if isinstance(df.schema[c].dataType, NumericType)}
    kind = "double" if len(numeric) == len(set(cols)) else "string"
    fns = {
        "count": F.count,
        "mean": lambda c: F.avg(c) if c in numeric else F.lit(None),
        "stddev": lambda c: F.stddev_samp(c) if c in numeric else F.lit(None),
        "min": F.min,
        "max": F.max,
    }
    wide = df.agg(*[fns[s](c).cast(kind).alias(f"{s}__{c}") for s in stats for c in cols])
    rows = [
        F.struct(F.lit(s).alias("summary"), *[F.col(f"{s}__{c}").alias(c) for c in cols])
        for s in stats
    ]
    out = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if digits is not None and kind == "double":
        out = out.select("summary", *[F.round(c, digits).alias(c) for c in cols])
    return out


def column_moments(df: DataFrame, cols: Sequence[str], exact_scale: int | None = None, digits: int | None = None) -> DataFrame:
    """Per column: n, sum, sum of squares, mean, population stddev.

    With ``exact_scale`` the sums are taken in decimal (exact for data with that many
    decimals at most: more are cut off) and shown as double; ``digits`` rounds the output.  Long form ``(column, n, total, total_sq, mean,
    stddev_pop)``.
    """
    def rounded(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    def dec(c: str) -> Column:
        return F.col(c).cast(f"decimal(18,{exact_scale})") if exact_scale is not None else F.col(c)

    aggs = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"n__{c}"),
            F.sum(dec(c)).cast("double").alias(f"s__{c}"),
            F.sum(dec(c) * dec(c)).cast("double").alias(f"q__{c}"),
            F.avg(c).alias(f"m__{c}"),
            F.stddev_pop(c).alias(f"d__{c}"),
        ]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n__{c}").alias("n"),
            rounded(F.col(f"s__{c}")).alias("total"),
            rounded(F.col(f"q__{c}")).alias("total_sq"),
            rounded(F.col(f"m__{c}")).alias("mean"),
            rounded(F.col(f"d__{c}")).alias("stddev_pop"),
        )
        for c in cols
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def global_count(df: DataFrame, alias: str = "n") -> DataFrame:
    """Row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(alias))
