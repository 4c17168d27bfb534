"""Sorts, limits and the top-N family.

Every ranking uses an explicit total order so that ties give the same rows on every
run.  Grouped top-N is a ``row_number`` filter: Catalyst turns it into a partial
``WindowGroupLimit`` before the shuffle and a final one after it, so a hot group
ships at most ``n`` rows per map task instead of all of its rows.  Spark plans that only
below ``spark.sql.optimizer.windowGroupLimitThreshold``; from there on the ranking always
runs in two stages, the first over hash-salted parts of the groups.  Global top-N uses
``orderBy().limit()`` (``TakeOrderedAndProject``), whose ``n`` rows meet in one task: for
an ``n`` of many millions sort and number the rows instead.  Modes that must return *all*
rows of the winning keys first pick the bounded key set, then broadcast-join it back,
so the result stays distributed.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType, StructField, StructType

from quarry.plans.strategies import broadcast_if_small

ColumnOrName = Column | str

# parts of a group in the first stage when Spark sets no limit before the shuffle
LARGE_N_SALTS = 64


def _cols(cols: Sequence[ColumnOrName] | ColumnOrName) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows under ``order`` (O03): ``TakeOrderedAndProject``."""
    return df.orderBy(*order).limit(n)


def kth_largest(df: DataFrame, col: str, k: int, alias: str = "kth_value") -> DataFrame:
    """k-th largest value of ``col`` (T09); with fewer than k rows, the smallest.

    Only ``k`` values per map task reach the final merge, where all ``k`` meet in one task:
    for a large ``k`` use ``kth_largest_selected``.
    """
    top = df.where(F.col(col).isNotNull()).select(col).orderBy(F.desc(col)).limit(k)
    return top.agg(F.min(col).alias(alias))


#: bits that a pass of the selection settles: it counts rows in so many cells, which is all
#: that a task or the driver holds
DIGIT_BITS = 16


def _ordered_bits(df: DataFrame, col: str) -> Column:
    """A number as a long of the same order: integers as they are, others as the bits of the
    double with negative ones turned around; -0.0 is 0.0, NaN comes above all others."""
    if isinstance(df.schema[col].dataType, IntegralType):
        return F.col(col).cast("long")
    value = F.col(col).cast("double")
    bits = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.when(value == 0, F.lit(0.0)).otherwise(value))
    bits = bits.cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def kth_largest_selected(df: DataFrame, col: str, k: int, alias: str = "kth_value") -> DataFrame:
    """``kth_largest`` for any ``k``: exact selection by counting.

    Each pass counts the rows that are still in question by the next ``DIGIT_BITS`` bits of
    their value and goes on with the one cell that holds the k-th, so four aggregates of at most
    65,536 rows settle 64 bits and no task ever holds ``k`` values.  With fewer than ``k`` rows
    it is the smallest value, without rows null, as in ``kth_largest``.
    """
    if k < 1:
        raise ValueError("k counts from 1")
    spark, kind = df.sparkSession, df.schema[col].dataType
    if not isinstance(kind, (IntegralType, DoubleType, FloatType)):
        raise ValueError(f"{col!r} is no integer, float or double")
    known = df.where(F.col(col).isNotNull()).select(_ordered_bits(df, col).bitwiseXOR(F.lit(-(1 << 63))).alias("u"))
    prefix, left = 0, k
    for done in range(0, 64, DIGIT_BITS):
        rows = known.where(F.shiftrightunsigned("u", 64 - done) == prefix) if done else known
        digit = F.shiftrightunsigned("u", 64 - done - DIGIT_BITS).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
        cells = sorted((r.digit, r.n) for r in rows.groupBy(digit.alias("digit")).agg(F.count(F.lit(1)).alias("n")).collect())
        if not cells:
            return spark.createDataFrame([(None,)], StructType([StructField(alias, kind)]))
        left = min(left, sum(n for _, n in cells))
        for at, n in reversed(cells):
            if left <= n:
                break
            left -= n
        prefix = prefix << DIGIT_BITS | at
    bits = prefix - (1 << 63)
    if isinstance(kind, IntegralType):
        value = F.lit(bits)
    else:
        raw = bits if bits >= 0 else bits ^ ((1 << 63) - 1)
        value = F.lit(struct.unpack("<d", struct.pack("<q", raw))[0])
    return spark.range(1).select(value.cast(kind).alias(alias))


def top_n_within_group(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank_col: str = "rank",
    salt_buckets: int | None = None,
    salt_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Top ``n`` rows per group (T06/T07/T08/A14), duplicates kept.

    ``order`` must be a total order inside a group.  With ``salt_buckets`` the ranking
    runs twice: first within ``(group, hash(salt_cols) % buckets)``, then within the
    group; the first stage cuts a hot group to ``n * buckets`` rows.  The salt is a
    hash of row columns, never ``rand()``, so a recomputed task yields the same rows.
    The result is identical with or without salt.
    """
    group = list(group_cols)
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if not salt_buckets and n >= limit:
        salt_buckets = LARGE_N_SALTS
    if salt_buckets:
        salt_on = _cols(salt_cols or df.columns)
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salt_buckets)))
        w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = (
            salted.withColumn("_r1", F.row_number().over(w1))
            .where(F.col("_r1") <= n)
            .drop("_r1", "_salt")
        )
    w = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn(rank_col, F.row_number().over(w))
        .where(F.col(rank_col) <= n)
        .withColumn(rank_col, F.col(rank_col).cast("bigint"))
    )


def top_values_per_group_list(
    df: DataFrame, group_cols: Sequence[str], value: str, n: int, alias: str = "top_values"
) -> DataFrame:
    """Top ``n`` values per group as one descending array (T06 list form).

    The list is built only after the ``row_number`` bound, so no group is ever
    collected whole.
    """
    ranked = top_n_within_group(df, group_cols, [F.desc(value)], n, rank_col="_r")
    return ranked.groupBy(*group_cols).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("_r"), F.col(value)))),
            lambda s: s[value],
        ).alias(alias)
    )


def top_n_unique(
    df: DataFrame, key: str, n: int, payload: Sequence[str], tiebreak: str
) -> DataFrame:
    """Top ``n`` distinct keys, one row per key.

    The row kept for a key is the one with the largest ``tiebreak`` ("last seen wins").
    The keys are found first (a partial distinct and a limit); a grouped ``max_by``, which
    sorts its input, then sees the rows of ``n`` keys only.
    """
    best = F.max_by(F.struct(*[F.col(c) for c in payload]), F.col(tiebreak))
    present = df.where(F.col(key).isNotNull())
    # the n winning keys by a hash aggregate; rows are picked among theirs only
    keys = present.select(key).distinct().orderBy(F.desc(key)).limit(n)
    rows = present.join(broadcast_if_small(keys, max(n, 1)), key, "left_semi")
    return (
        rows.groupBy(key)
        .agg(best.alias("_row"))
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in payload])
        .orderBy(F.desc(key))
        .limit(n)
    )


def top_n_keys_with_rows(
    df: DataFrame, key: str, n: int, max_broadcast_rows: int = 1_000_000
) -> DataFrame:
    """All rows of the ``n`` largest distinct keys (T03, ``dense_rank <= n``).

    The winning keys (at most ``n``) are found with a partial distinct + limit and
    joined back; the data itself never goes through one task.
    """
    keys = (
        df.select(key)
        .where(F.col(key).isNotNull())
        .distinct()
        .orderBy(F.desc(key))
        .limit(n)
        .withColumn("key_rank", F.dense_rank().over(Window.orderBy(F.desc(key))).cast("bigint"))
    )
    return df.join(broadcast_if_small(keys, max(n, 1), max_broadcast_rows), on=key, how="inner")


def sum_by_key(df: DataFrame, key: str, value: Column, alias: str = "total") -> DataFrame:
    """Sum per key with map-side combine (A11/A12), always as bigint/decimal."""
    return df.groupBy(key).agg(F.sum(value).alias(alias))


def top_n_sums(df: DataFrame, key: str, total: str, n: int, rank_col: str = "rank") -> DataFrame:
    """Top ``n`` keys by their sum, one row per key, ties broken by key."""
    top = df.orderBy(F.desc(total), F.asc(key)).limit(n)
    w = Window.orderBy(F.desc(total), F.asc(key))
    return top.withColumn(rank_col, F.row_number().over(w).cast("bigint"))


def top_n_sums_with_ties(
    df: DataFrame, key: str, total: str, n: int, rank_col: str = "sum_rank",
    max_broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """The ``n`` largest distinct sums with every key that has them.

    Long form ``(total, sum_rank, key)``: the keys of one sum are rows, not a list.
    """
    sums = (
        df.select(total)
        .distinct()
        .orderBy(F.desc(total))
        .limit(n)
        .withColumn(rank_col, F.row_number().over(Window.orderBy(F.desc(total))).cast("bigint"))
    )
    return df.join(broadcast_if_small(sums, max(n, 1), max_broadcast_rows), on=total, how="inner")


def value_multiset_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """All values per key as a multiset ``(key, value, n)`` (A13, re-aimed).

    ``groupByKey`` would put a whole group into one task; the long form keeps every
    value with its multiplicity and aggregates map-side.
    """
    return df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
