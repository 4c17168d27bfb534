"""Running numbers and digests along an order, within keys, without a task for each key.

``slices`` deals rows into sorted ranges of (key, order) and fixes them by a reliable
checkpoint; a key that holds a third of the rows lies in as many slices as its rows need.
``running`` then streams every slice twice: once for what its first and last key come to (one
summary row a slice, which is all that the driver sees), once to add the columns.

``lookup`` is a many-to-one join that splits hot keys: those with over a thousandth of the
rows, at most a thousand by arithmetic, are broadcast; the others meet by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

SLICE_ROWS = 2_000_000
HOT_KEYS = 1_000


def slices(df: DataFrame, order: Sequence[Column], rows: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` in sorted ranges, with their number ``_pid``; ``rows`` is its (rough) size."""
    ensure_checkpoint_dir(df.sparkSession)
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // slice_rows))
    fixed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint()
    return fixed.withColumn("_pid", F.spark_partition_id())


def _starts(keys: pa.Array) -> np.ndarray:
    """Rows at which another key begins (null is a key)."""
    first, rest = keys.slice(0, len(keys) - 1), keys.slice(1)
    differ = pc.not_equal(first, rest).fill_null(False).to_numpy(zero_copy_only=False)
    differ |= first.is_null().to_numpy(zero_copy_only=False) != rest.is_null().to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.nonzero(differ)[0] + 1])


def _columns(b: pa.RecordBatch, values: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ones (summed up to places), and a row for each value (combined by exclusive or)."""
    x = [b.column(v).to_numpy() for v in values]
    return np.ones(b.num_rows, np.int64), np.stack(x) if x else np.empty((0, b.num_rows), np.int64)


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Combine two states: a count, then the values."""
    return np.concatenate([a[:1] + b[:1], a[1:] ^ b[1:]])


def _summary(batches: Iterator[pa.RecordBatch], key: str, values: Sequence[str]) -> Iterator[pa.RecordBatch]:
    pid, first, last = None, None, None
    for b in batches:
        if not b.num_rows:
            continue
        keys, (ones, x) = b.column(key), _columns(b, values)
        starts = _starts(keys)
        sums = np.concatenate([np.add.reduceat(ones, starts)[None, :], np.bitwise_xor.reduceat(x, starts, axis=1)])
        for i in sorted({0, len(starts) - 1}):
            k, s = keys[starts[i]].as_py(), sums[:, i]
            if i == 0 and last is not None and k == last[0]:
                s = _add(last[1], s)
            if first is None or first[0] == k:
                first = (k, s)
            last = (k, s)
        pid = b.column("_pid")[0].as_py()
    if pid is not None:
        ends = [pa.array([e[0]], keys.type) for e in (first, last)]
        sums = [pa.array([e[1].tolist()], pa.list_(pa.int64())) for e in (first, last)]
        yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), *ends, *sums], ["pid", "first", "last", "first_sums", "last_sums"])


def running(sliced: DataFrame, key: str, place: str, values: Sequence[str] = ()) -> DataFrame:
    """Adds ``place``, the 1-based place of a row within its key along the slices' order, and
    turns each column of ``values`` (longs) into its running exclusive or within the key.

    ``sliced`` is what ``slices`` returned, ordered by ``key`` first.
    """
    kind = sliced.schema[key].dataType.simpleString()
    shape = f"pid int, first {kind}, last {kind}, first_sums array<bigint>, last_sums array<bigint>"
    ends = sliced.select(key, *values, "_pid").mapInArrow(lambda batches: _summary(batches, key, values), shape)
    # one row a slice: what the keys that reach into a slice have come to before it
    before: dict[int, list[int]] = {}
    open_key, total = None, None
    for r in sorted(ends.collect(), key=lambda r: r.pid):
        now = np.array(r.last_sums, np.int64)
        if total is not None and r.first == open_key:
            before[r.pid] = total.tolist()
            if r.first == r.last:
                now = _add(total, now)
        open_key, total = r.last, now

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, at = None, None
        for b in batches:
            if not b.num_rows:
                continue
            keys, (ones, x) = b.column(key), _columns(b, values)
            none = np.zeros(1 + len(x), np.int64)
            if carried is None:
                carried = np.array(before.get(b.column("_pid")[0].as_py(), none), np.int64)
            elif keys[0].as_py() != at:
                carried = none
            starts = _starts(keys)
            times = np.diff(np.append(starts, b.num_rows))
            count, mixed = np.cumsum(ones), np.bitwise_xor.accumulate(x, axis=1)
            count = count + np.repeat(np.append(carried[0], -count[starts[1:] - 1]), times)
            mixed = mixed ^ np.repeat(np.concatenate([carried[1:, None], mixed[:, starts[1:] - 1]], axis=1), times, axis=1)
            carried, at = np.append(count[-1], mixed[:, -1]), keys[b.num_rows - 1].as_py()
            new = dict(zip(values, mixed, strict=True))
            columns = [pa.array(new[n]) if n in new else b.column(n) for n in b.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(count)], [*b.schema.names, place])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sliced.schema.fields)
    return sliced.mapInArrow(add, f"{fields}, `{place}` bigint")


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], times: str, total: int) -> DataFrame:
    """``rows`` joined with the one row of ``table`` for their ``keys``; ``times`` is the
    table's column that says how many of the ``total`` rows have that key."""
    most = max(1, total // HOT_KEYS)
    hot = F.broadcast(table.where(F.col(times) > most).drop(times))
    cold = table.where(F.col(times) <= most).drop(times)
    names = F.broadcast(table.where(F.col(times) > most).select(*keys))
    return rows.join(hot, list(keys)).unionByName(rows.join(names, list(keys), "left_anti").join(cold, list(keys)))
