"""Delimited-line parser.

``parse_delimited`` splits a text column into typed, named columns by position.
Casts are ``try_cast``: a line whose field count is wrong or whose field does not
cast goes to the rejects frame instead of failing the job (the RDD code in the
reference threw; its DataFrame code silently produced nulls).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import jvm_split


def _split(df: DataFrame, col: str, sep: str, limit: int):
    arr = jvm_split(F.col(col), sep) if limit <= 0 else F.split(F.col(col), sep, limit)
    return df.withColumn("_f", arr)


def _typed(fields: Sequence[tuple[int, str, str]]):
    return [F.get(F.col("_f"), i).try_cast(t).alias(name) for i, name, t in fields]


def _valid(fields: Sequence[tuple[int, str, str]], n_fields: int | None):
    ok = F.lit(True)
    if n_fields is not None:
        ok = ok & (F.size("_f") == n_fields)
    for i, _, t in fields:
        raw = F.get(F.col("_f"), i)
        ok = ok & raw.isNotNull() & raw.try_cast(t).isNotNull()
    return ok


def parse_delimited(
    df: DataFrame,
    col: str,
    sep: str,
    fields: Sequence[tuple[int, str, str]],
    n_fields: int | None = None,
    limit: int = -1,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Parse ``col`` into ``fields`` = ``[(position, name, type), ...]``.

    ``sep`` is a regex; with ``limit > 0`` the last field keeps the rest of the line
    (free text with separators inside).  Returns ``(parsed, rejects)``; rejects keep
    the original line and the ``keep`` columns.
    """
    split = _split(df, col, sep, limit).withColumn("_ok", _valid(fields, n_fields))
    parsed = split.where(F.col("_ok")).select(*keep, *_typed(fields))
    rejects = split.where(~F.col("_ok")).select(*keep, F.col(col))
    return parsed, rejects


def parse_labelled(
    df: DataFrame,
    col: str,
    sep: str,
    label: int = 0,
    feature_sep: str | None = None,
    label_type: str = "double",
    feature_type: str = "double",
    out: str = "features",
    keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Parse ``col`` into a ``label`` and an array ``out`` of features.

    ``label`` is the label's position among the fields, from the end if negative.  Without
    ``feature_sep`` the features are all other fields; with it, the line has two fields and
    the other one is cut again at ``feature_sep``.  Both separators are regexes.  A line
    whose label or any feature is missing or does not cast is a reject and keeps its text.
    """
    fields = F.col("_f")
    at = F.lit(label) if label >= 0 else F.size(fields) + label
    raw_label = F.get(fields, at)
    if feature_sep is None:
        others = F.filter(F.transform(fields, lambda x, i: F.when(i != at, x)), lambda x: x.isNotNull())
        shape = F.size(fields) >= 2
    else:
        others = F.split(F.get(fields, F.lit(1) - at), feature_sep)
        shape = F.size(fields) == 2
    cast = F.transform(others, lambda x: x.try_cast(feature_type))
    ok = shape & raw_label.try_cast(label_type).isNotNull() & ~F.exists(cast, lambda x: x.isNull())
    split = df.withColumn("_f", F.split(F.col(col), sep)).withColumn("_ok", F.coalesce(ok, F.lit(False)))
    parsed = split.where("_ok").select(*keep, raw_label.try_cast(label_type).alias("label"), cast.alias(out))
    return parsed, split.where("not _ok").select(*keep, F.col(col))
