"""Signed feature hashing for categories of any width: no fit, no label arrays.

A category ``column=value`` has a fixed place among ``width`` and a sign, both from its md5
digest, and adds the sign (a number: sign times value) to its place.  Values that meet in one
place add up; with signs their expected product is zero, so inner products stay unbiased.
Vectors are kept as their non-zero entries in order of index, from the first row to the last;
the width costs nothing.  A null category or number adds nothing.

``entries`` is the long form, which SQL can check; ``sparse_vectors`` is what ML models take.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 500_000


def _place(name: Column, width: int) -> tuple[Column, Column]:
    """Index and sign of a category or a column's name."""
    digest = F.md5(name.cast("binary"))
    index = F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint"), F.lit(width))
    odd = F.conv(F.substring(digest, 13, 1), 16, 10).cast("int") % 2 == 1
    return index.cast("int"), F.when(odd, F.lit(-1.0)).otherwise(F.lit(1.0))


def _entry(name: Column, value: Column, width: int) -> Column:
    index, sign = _place(name, width)
    return F.struct(index.alias("index"), (sign * value).alias("value"))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _added_up(found: Column) -> Column:
    """Entries in order of place, those of one place added up, without zeros."""
    start = F.struct(F.array().cast("array<struct<index:int,value:double>>").alias("done"), F.lit(-1).alias("index"), F.lit(0.0).alias("value"))

    def add(acc: Column, e: Column) -> Column:
        closed = F.when((acc.index >= 0) & (acc.value != 0), F.concat(acc.done, F.array(F.struct(acc.index.alias("index"), acc.value.alias("value"))))).otherwise(acc.done)
        same = acc.index == e.index
        return F.struct(
            F.when(same, acc.done).otherwise(closed).alias("done"), e.index.alias("index"), (F.when(same, acc.value).otherwise(F.lit(0.0)) + e.value).alias("value")
        )

    end = F.array(F.struct(F.lit(-1).alias("index"), F.lit(0.0).alias("value")))  # closes the last place
    return F.aggregate(F.concat(F.array_sort(found), end), start, add, lambda acc: acc.done)


def hashed_entries(cat_cols: Sequence[str], num_cols: Sequence[str] = (), width: int = WIDTH) -> Column:
    """array<struct<index, value>> of a row: ascending, one for each place, without zeros."""
    cats = [F.when(F.col(c).isNotNull(), _entry(F.concat(F.lit(f"{c}="), F.col(c).cast("string")), F.lit(1.0), width)) for c in dict.fromkeys(cat_cols)]
    nums = [F.when(F.col(c).isNotNull(), _entry(F.lit(c), F.col(c).cast("double"), width)) for c in dict.fromkeys(num_cols)]
    return _added_up(F.filter(F.array(*cats, *nums), lambda e: e.isNotNull()))


def hashed_tokens(tokens: Column, width: int = WIDTH) -> Column:
    """Sparse counts of an array of tokens, without signs: array<struct<index, value>>."""
    known = F.filter(F.coalesce(tokens, F.array().cast("array<string>")), lambda t: t.isNotNull())
    place = F.array_sort(F.transform(known, lambda t: _place(t, width)[0]))

    def runs(sorted_: Column) -> Column:
        last = F.filter(F.transform(sorted_, lambda v, i: F.when(F.coalesce(F.get(sorted_, i + 1) != v, F.lit(True)), i)), lambda i: i.isNotNull())
        return _bound(last, lambda ends: F.transform(ends, lambda i, k: F.struct(F.get(sorted_, i).alias("index"), (i - F.coalesce(F.get(ends, k - 1), F.lit(-1))).cast("double").alias("value"))))

    return _bound(place, runs)


def entries(df: DataFrame, key_cols: Sequence[str], cat_cols: Sequence[str], num_cols: Sequence[str] = (), width: int = WIDTH) -> DataFrame:
    """(keys, index, value): one row per non-zero entry of each row of ``df``."""
    return df.select(*key_cols, F.inline(hashed_entries(cat_cols, num_cols, width)))


def sparse_vectors(df: DataFrame, found: Column, out: str = "features", width: int = WIDTH) -> DataFrame:
    """``df`` with the entries as an ML sparse vector, for estimators."""
    to_vector = F.udf(lambda i, v: Vectors.sparse(width, i, v), VectorUDT())
    return df.withColumn(out, to_vector(found["index"], found["value"]))
