"""Timed runs (R12, R13): a processing-time stream that is stopped by what it has done.

``run_timed`` starts a stream with a fixed batch interval and watches its progress.  It stops
after ``batches`` micro-batches with rows, or once ``quiet`` triggers in a row have found
nothing, whichever comes first.  It stops between micro-batches only: it waits until the one
under way has been committed, so no row is lost or written twice, and a later run on the same
checkpoint goes on behind it.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

#: seconds between two looks at the progress
LOOK = 0.1


def _ended(query: StreamingQuery) -> bool:
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return not query.isActive


def _idle(query: StreamingQuery) -> bool:
    status = query.status
    return not status["isTriggerActive"]


def run_timed(
    writer, interval: str, batches: int | None = None, quiet: int | None = None, timeout: float | None = None
) -> list[dict]:
    """Run ``writer`` (a ``DataStreamWriter`` with its checkpoint) every ``interval``; returns
    the progress of the micro-batches with rows: their number, rows and duration."""
    if batches is None and quiet is None:
        raise ValueError("a timed run needs a number of batches or of quiet triggers")
    query = writer.trigger(processingTime=interval).start()
    seen: dict[int, dict] = {}
    still, last, began = 0, None, time.monotonic()
    try:
        while not _ended(query):
            for p in query.recentProgress:
                if p["numInputRows"] > 0:
                    seen[p["batchId"]] = {"batch": p["batchId"], "rows": p["numInputRows"], "ms": p["durationMs"].get("triggerExecution", 0)}
            now = query.lastProgress
            if now and now["timestamp"] != last:
                last = now["timestamp"]
                still = 0 if now["numInputRows"] > 0 else still + 1
            done = (batches is not None and len(seen) >= batches) or (quiet is not None and still >= quiet)
            if done and _idle(query):
                break
            if timeout is not None and time.monotonic() - began > timeout:
                raise TimeoutError(f"{len(seen)} micro-batches in {timeout} s")
            time.sleep(LOOK)
    finally:
        query.stop()
    _ended(query)
    return [seen[b] for b in sorted(seen)]


def foreach_batch_writer(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str):
    return stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)


def sink_writer(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet"):
    return stream.writeStream.format(fmt).option("path", sink).option("checkpointLocation", checkpoint).outputMode("append")
