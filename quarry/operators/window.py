"""Moving-window operators.

``relative_to_moving_avg`` (W01) computes ``value - avg(value)`` over the rows
``before`` .. ``after`` around each row, inside a group and along a total order.

The plain form is one window partitioned by the group: a group with a third of all
rows then sits in one task.  The default ``skew_safe`` form avoids that:

1. number all rows densely along ``(group, order)`` with a range-partitioned
   position (no single-partition window, see ``plans.strategies``);
2. cut positions into blocks of ``block`` rows and copy the ``before``/``after``
   rows at each block edge into the neighbouring block (a halo);
3. run the same window partitioned by ``(block, group)``: every partition holds at
   most ``block + before + after`` rows, whatever the group sizes;
4. keep the home copy of each row.

Both forms give identical results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.plans.strategies import global_position


def _plain(df, group_cols, order, value, before, after, alias):
    w = Window.partitionBy(*group_cols).orderBy(*order).rowsBetween(-before, after)
    return df.withColumn(alias, F.col(value) - F.avg(value).over(w))


def relative_to_moving_avg(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[Column],
    value: str,
    before: int = 10,
    after: int = 10,
    alias: str = "relative",
    skew_safe: bool = True,
    block: int = 4096,
) -> DataFrame:
    """``value`` minus its centred moving average over a rows frame."""
    if not skew_safe:
        return _plain(df, group_cols, order, value, before, after, alias)
    if block < before + after:
        raise ValueError("block must be at least before + after")
    cols = df.columns
    full = [*[F.col(g).asc_nulls_first() for g in group_cols], *order]
    pos = global_position(df, full, pos_col="_g").withColumn("_b", F.floor((F.col("_g") - 1) / block))
    off = F.col("_g") - 1 - F.col("_b") * block
    copies = F.array(
        F.struct(F.col("_b").alias("blk"), F.lit(True).alias("home")),
        F.when(off >= block - before, F.struct((F.col("_b") + 1).alias("blk"), F.lit(False).alias("home"))),
        F.when(off < after, F.struct((F.col("_b") - 1).alias("blk"), F.lit(False).alias("home"))),
    )
    spread = pos.select(*cols, "_g", F.explode(F.filter(copies, lambda s: s.isNotNull())).alias("_c"))
    w = Window.partitionBy(F.col("_c.blk"), *group_cols).orderBy("_g").rowsBetween(-before, after)
    return (
        spread.withColumn(alias, F.col(value) - F.avg(value).over(w))
        .where(F.col("_c.home"))
        .select(*cols, alias)
    )


def relative_to_range_avg(
    df: DataFrame,
    group_cols: Sequence[str],
    order_value: str,
    value: str,
    before: float = 10,
    after: float = 10,
    alias: str = "relative",
    block: float | None = None,
) -> DataFrame:
    """``value`` minus the average over rows whose ``order_value`` lies within
    ``[v - before, v + after]`` in the same group (W02, value-range frame).

    Rows of one group and order value are added up first (a partial aggregate), so a hot
    value is one row.  The order axis is cut into blocks of ``block`` (by default 16 frame
    widths), rows within a frame of a block's edge are copied to the neighbour, and the
    window runs per (group, block): one group's blocks lie in many tasks.  Sums and counts
    are joined back by group and order value.  Rows with a null order value are one frame.
    """
    block = block or 16 * max(before + after, 1e-9)
    if block < max(before, after):
        raise ValueError("block must be at least as wide as either side of the frame")
    group, v = list(group_cols), F.col("_v")
    rows = df.withColumn("_v", F.col(order_value))
    cells = rows.groupBy(*group, "_v").agg(F.sum(value).alias("_sum"), F.count(value).alias("_cnt"))
    home = F.floor(v / F.lit(block))
    copies = F.array(
        F.struct(home.alias("blk"), F.lit(True).alias("home")),
        F.when(F.floor((v + before) / block) > home, F.struct((home + 1).alias("blk"), F.lit(False).alias("home"))),
        F.when(F.floor((v - after) / block) < home, F.struct((home - 1).alias("blk"), F.lit(False).alias("home"))),
    )
    spread = cells.select(*group, "_v", "_sum", "_cnt", F.explode(F.filter(copies, lambda s: s.isNotNull())).alias("_c"))
    w = Window.partitionBy(*group, "_c.blk").orderBy("_v").rangeBetween(-before, after)
    framed = spread.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_v").alias("_w"),
        F.try_divide(F.sum("_sum").over(w), F.sum("_cnt").over(w)).alias("_avg"),
        F.col("_c.home").alias("_home"),
    ).where("_home")
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    joined = rows.join(framed, [*same, F.col("_v").eqNullSafe(F.col("_w"))])
    return joined.select(*df.columns, (F.col(value) - F.col("_avg")).alias(alias))
