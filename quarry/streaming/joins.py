"""Operators on two streams (R05): the state is Spark's, bounded by watermarks.

``subtract_streams`` keeps the rows of the left stream that have no equal row on the right
within ``within`` of event time, before or after.  It is a left outer stream-stream join: a
row waits in the state store until the watermarks of both streams say that no partner can
come, and is given out then, once, whatever restarts lie between.  What stays in state is
bounded by ``within`` and the delays, not by the length of the streams.

Late rows: a row that is older than its stream's watermark (its delay behind the newest row of
earlier batches) meets what the other side still holds but is not kept; a late left row without
partner comes out at once.  Equal rows are rows of their own.  Nulls are equal to nulls.  Rows
without event time have no window: on the left they stay, on the right they take nothing away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _key(columns: Sequence[str]):
    """The columns as one text in which null is equal to null."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})


def subtract_streams(
    left: DataFrame, right: DataFrame, on: Sequence[str], time: str, within: str = "0 seconds", delay: str = "0 seconds"
) -> DataFrame:
    """The rows of ``left`` without a row of ``right`` that has the same ``on`` columns and a
    ``time`` at most ``within`` apart; works on two streams and on two tables alike."""
    columns = left.columns
    names = [f"c{i}" for i in range(len(columns))]  # columns may have any names
    at = F.col(f"`{time}`").cast("timestamp")  # event time has a zone: that of the session
    mine = left.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True)], _key(on).alias("_key"), at.alias("_time"))
    mine = mine.withWatermark("_time", delay)
    theirs = right.select(_key(on).alias("_other"), at.alias("_at")).where("_at is not null").withWatermark("_at", delay)
    gap = F.expr(f"interval {within}")
    near = (F.col("_key") == F.col("_other")) & (F.col("_at") >= F.col("_time") - gap) & (F.col("_at") <= F.col("_time") + gap)
    joined = mine.join(theirs, near, "left_outer")
    return joined.where("_other is null").select(*names).toDF(*columns)


def closing_row(df: DataFrame, time: str, at: str) -> DataFrame:
    """One row of ``df``'s columns, null but for ``time``: a finite input's end mark, which moves
    the watermark past all other rows so that they come out."""
    spark = df.sparkSession
    return spark.range(1).select(
        *[(F.lit(at) if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
