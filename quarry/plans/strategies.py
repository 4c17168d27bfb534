"""Physical-shape helpers shared by operators: bounded broadcast, global positions,
prefix sums.  All of them are plain DataFrame compositions.

* ``broadcast_if_small`` broadcasts a side only when its size is proven: at most
  ``max_rows`` rows and ``max_bytes`` bytes, checked with a probe that reads no more than
  ``max_rows + 1`` rows (the probe runs while the plan is built), or a number of rows known
  by construction, e.g. the output of a ``limit(n)``.  Above the bound the ordinary
  shuffle join is kept and AQE may still convert it at runtime.
* ``global_position`` / ``prefix_sums`` number rows (or accumulate values) along a
  total order without an unpartitioned window: the data is range-partitioned into
  ``n`` slices, each slice is numbered locally, and an ``n``-row offset table (the
  only thing that is broadcast) shifts the local numbers.  A hot key is split across
  range slices by the order columns, so no slice holds more than its share.

  The sorted slices are written once with a reliable ``checkpoint()`` (into the
  shared ``spark.checkpoint.dir``).  Two consumers of one ``repartitionByRange``
  would otherwise each sample their own range bounds (the sample seed depends on
  the RDD id), so slice counts and slice rows could disagree.  After the checkpoint
  the slices and their row order are fixed, also when a task is re-run after an
  executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 128 << 20


def broadcast_if_small(
    df: DataFrame,
    known_max_rows: int | None = None,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``F.broadcast(df)`` within ``max_rows`` rows and ``max_bytes`` bytes, else ``df``."""
    if known_max_rows is not None and known_max_rows <= max_rows:
        return F.broadcast(df)
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def is_small(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """At most ``max_rows`` rows and ``max_bytes`` bytes; reads ``max_rows + 1`` rows at most."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def _num_slices(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ranged(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Range-sorted slices, materialised once so every consumer sees the same ones."""
    from quarry.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    fixed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    return fixed.withColumn("_pid", F.spark_partition_id())


def _offsets(totals: DataFrame, cols: Sequence[str]) -> DataFrame:
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "_pid", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_off") for c in cols]
    )


def global_position(
    df: DataFrame, order: Sequence[Column], pos_col: str = "pos", num_partitions: int | None = None
) -> DataFrame:
    """Add a dense 1-based position along ``order`` (which must be a total order)."""
    ranged = _ranged(df, order, _num_slices(df, num_partitions))
    local = ranged.withColumn(
        "_local", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    )
    totals = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = _offsets(totals, ["_cnt"])
    n = _num_slices(df, num_partitions)
    return (
        local.join(broadcast_if_small(offsets, n), "_pid")
        .withColumn(pos_col, F.col("_cnt_off") + F.col("_local") + 1)
        .drop("_pid", "_local", "_cnt_off")
    )


def prefix_sums(
    df: DataFrame,
    order: Sequence[Column],
    value_cols: Sequence[str],
    suffix: str = "_cum",
    num_partitions: int | None = None,
) -> DataFrame:
    """Running sums of ``value_cols`` along a total ``order`` (inclusive)."""
    n = _num_slices(df, num_partitions)
    ranged = _ranged(df, order, n)
    upto = Window.partitionBy("_pid").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = ranged.select("*", *[F.sum(c).over(upto).alias(f"_{c}_l") for c in value_cols])
    totals = ranged.groupBy("_pid").agg(*[F.sum(c).alias(f"_{c}_t") for c in value_cols])
    offsets = _offsets(totals, [f"_{c}_t" for c in value_cols])
    out = local.join(broadcast_if_small(offsets, n), "_pid")
    for c in value_cols:
        out = out.withColumn(f"{c}{suffix}", F.col(f"_{c}_l") + F.col(f"_{c}_t_off"))
    return out.drop("_pid", *[f"_{c}_l" for c in value_cols], *[f"_{c}_t_off" for c in value_cols])
