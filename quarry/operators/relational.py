"""Projections, filters, joins and set operations.

All of these are column expressions or DataFrame joins, planned by Catalyst:
filters reach the parquet scan as ``PushedFilters`` and only referenced columns are
read.  Nothing here uses ANSI-failing casts or divisions: ``try_cast`` and
``try_divide`` give null instead of an error, as the reference's engine did.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """Fail early, with the missing names, instead of deep inside an analysis error."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


# --- projections --------------------------------------------------------------


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as double; a zero or null denominator gives null."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.try_divide(n.cast("double"), d.cast("double"))


def encode_categories(col: str, mapping: Mapping[str, int], default: int = 2) -> Column:
    """Map string categories to ints; unknown **and null** values get ``default``."""
    expr = None
    for value, code in mapping.items():
        expr = (F if expr is None else expr).when(F.col(col) == value, F.lit(code))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def recode_binary(col: Column | str, negative_value, negative: int = 0, positive: int = 1) -> Column:
    """``negative`` where ``col == negative_value`` else ``positive``; null -> positive."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == negative_value, F.lit(negative)).otherwise(F.lit(positive))


def drop_rename_cast(
    df: DataFrame,
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    casts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Drop, rename and ``try_cast`` columns in one projection."""
    require_columns(df, [*drop, *(rename or {}), *(casts or {})])
    rename, casts = dict(rename or {}), dict(casts or {})
    out = []
    for c in df.columns:
        if c in drop:
            continue
        e = F.col(c)
        if c in casts:
            e = e.try_cast(casts[c])
        out.append(e.alias(rename.get(c, c)))
    return df.select(*out)


def positional_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Name all columns by position (P08, ``toDF``)."""
    return df.toDF(*names)


def columns_by_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Keep the columns whose name ends with ``suffix``."""
    keep = [c for c in df.columns if c.endswith(suffix)]
    if not keep:
        raise ValueError(f"no column ends with {suffix!r}")
    return df.select(*keep)


# --- filters ------------------------------------------------------------------


def filter_min(df: DataFrame, col: str, n) -> DataFrame:
    """Rows with ``col >= n``."""
    return df.where(F.col(col) >= F.lit(n))


def filter_not_true(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col != true`` under 3-valued logic: null rows drop."""
    return df.where(F.col(col) != F.lit(True))


def filter_array_elements(df: DataFrame, flag: str, arr: str, i: int = 0, j: int = 1) -> DataFrame:
    """Rows with ``flag`` set and ``arr[i] > arr[j]``; short arrays drop."""
    return df.where(F.col(flag) & (F.get(F.col(arr), i) > F.get(F.col(arr), j)))


def filter_half(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows with ``a >= b / 2`` in double arithmetic."""
    return df.where(F.col(a) >= F.col(b) / F.lit(2.0))


def filter_contains(df: DataFrame, col: str, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """Substring / negated substring filter."""
    cond = F.lit(True)
    if include is not None:
        cond = cond & F.col(col).contains(include)
    if exclude is not None:
        cond = cond & ~F.col(col).contains(exclude)
    return df.where(cond)


def filter_sentinel(df: DataFrame, col: str, sentinels: Sequence[str] = ("?", "0")) -> DataFrame:
    """Drop sentinel values, empty and blank strings."""
    c = F.col(col)
    return df.where(~c.isin(*sentinels) & (F.length(F.trim(c)) > 0))


def sql_where(spark: SparkSession, df: DataFrame, where: str) -> DataFrame:
    """SQL ``WHERE`` over a DataFrame (F10, K05, P10): parsed by Spark, same plan."""
    return spark.sql(f"SELECT * FROM {{t}} WHERE {where}", t=df)


# --- joins --------------------------------------------------------------------


def join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join (J01-J05); Spark chooses broadcast or sort-merge from sizes, and
    AQE splits skewed partitions at runtime."""
    return left.join(right, on=on, how=how)


def self_join(df: DataFrame, on: Column, left_alias: str = "a", right_alias: str = "b") -> DataFrame:
    """Self-join through aliases (J06).  ``on`` refers to ``a.<col>`` / ``b.<col>``."""
    return df.alias(left_alias).join(df.alias(right_alias), on=on, how="inner")


#: equal rows that one row is expanded to at most
RUN_ROWS = 100_000


# --- set operations -----------------------------------------------------------


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct combinations (U01): partial + final hash aggregate."""
    return df.select(*cols).distinct()


def drop_duplicates_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple survives.

    A grouped ``min`` of a struct is a partial aggregate: a key with a third of all
    rows still reaches the shuffle as one row per map task.

    String keys may be long texts: rows are then grouped by a 256-bit digest of the keys, so
    the aggregate, which sorts its input, compares 32 bytes and not whole texts.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [*order, *[c for c in rest if c not in order]]
    if all(isinstance(df.schema[k].dataType, StringType) for k in keys):
        parts = [F.coalesce(F.sha2(k, 256), F.lit("null")) for k in keys]
        digest = F.unhex(F.sha2(F.concat(*parts), 256)).alias("_k")
        best = F.min(F.struct(*[F.col(c) for c in [*ordered, *keys]])).alias("_best")
        picked = df.groupBy(digest).agg(best)
        return picked.select(*[F.col(f"_best.{c}").alias(c) for c in [*keys, *rest]])
    best = F.min(F.struct(*[F.col(c) for c in ordered])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def subtract_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Remove every left row that occurs on the right; keep the other duplicates.

    Not ``EXCEPT`` (de-duplicates) and not ``exceptAll`` (multiset counts).  Equal left rows
    are collapsed to one row with their number before the null-safe ``left_anti`` join against
    the distinct right rows, and spread out again behind it: a row that is half of the table is
    one row of each map task in the shuffle.  Its repeats are cut into runs of
    ``RUN_ROWS`` that are dealt out before they are expanded, so no task makes all of them.
    """
    cols = left.columns
    names = [f"c{i}" for i in range(len(cols))]  # columns may have any names
    counted = left.toDF(*names).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    r = right.select(*cols).toDF(*names).distinct()
    kept = counted.join(r, on=[counted[c].eqNullSafe(r[c]) for c in names], how="left_anti")
    runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN_ROWS).cast("long"))
    cut = kept.withColumn("run", F.explode(runs)).withColumn("size", F.least(F.lit(RUN_ROWS), F.col("n") - F.col("run") * RUN_ROWS))
    few, many = cut.where(F.col("n") <= RUN_ROWS), cut.where(F.col("n") > RUN_ROWS)
    dealt = many.repartition(F.hash(*names, "run"))
    one = few.unionByName(dealt).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("size"))))
    return one.select(*names).toDF(*cols)
