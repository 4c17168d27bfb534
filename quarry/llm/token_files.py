"""Token-id files in ORC (operator 3).

``write_tokens`` sorts the documents by id into ranges, encodes each range and writes one
ORC file per range: column ``ids`` is an integer list (ORC's run-length encoding), stripes
are small enough to be read in parallel, row indexes cover every column and a Bloom filter
covers ``doc_id``.  Beside a document's tokens a row holds its range and the tokens before
it in the range, so a reader needs no more than one number per range to know a document's
place in the whole stream.

* Texts are shuffled, ids are not: encoding happens behind the exchange, in the task that
  writes the file.
* ``read_tokens`` gives each document's ``start`` from the files alone: the sums of the
  ranges (one row each) are accumulated and joined back by a broadcast, if their number
  allows it.
* ``lookup`` reads only stripes whose statistics and Bloom filter admit the ids.

Order: ``doc_id`` (null first), then a hash of the text, so repeated ids have one order and
rows of one id can lie in several ranges.  A null text is an empty text and holds the end
id alone.  An empty table writes files without rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.bpe import MEMO_WORDS, TextEncoder, batch_texts, parts, texts_to_python
from quarry.plans.strategies import broadcast_if_small

ORC_OPTIONS = {
    "orc.compress": "zstd",
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def write_tokens(
    docs: DataFrame,
    path: str,
    spec: str,
    end_id: int,
    ranges: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """``ranges``: number of files; the session's shuffle partitions if not given."""
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept_type = docs.schema[doc_id].dataType.simpleString()
    own = texts_to_python(docs).select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    end = np.uint32(end_id).astype("<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = TextEncoder.of(spec, 2 * MEMO_WORDS), 0
        for part in parts(batches):
            got = [x + end for x in encoder.encode(batch_texts(part))]
            sizes = np.array([len(x) // 4 for x in got], np.int64)
            ends = np.concatenate([[0], sizes.cumsum()])
            ids = pa.array(np.frombuffer(b"".join(got), "<i4"), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("range"),
                    part.column("doc_id"),
                    pa.array(before + ends[:-1], pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids),
                ],
                ["range", "doc_id", "range_start", "n_tokens", "ids"],
            )
            before += int(ends[-1])

    tokens = (
        own.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("range"), "doc_id", "text")
        .mapInArrow(encode, f"range int, doc_id {kept_type}, range_start long, n_tokens long, ids array<int>")
    )
    tokens.write.mode("overwrite").options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)``; ``start`` counts the tokens of all documents before."""
    rows = spark.read.orc(path)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("range").agg(F.sum("n_tokens").alias("_n"))  # one row for each file
    starts = sums.select("range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # a row a file: checked, then broadcast, so that the ids are not shuffled
    return rows.join(broadcast_if_small(starts), "range").select(
        "doc_id", (F.col("_before") + F.col("range_start")).alias("start"), "n_tokens", "ids"
    )


def lookup(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """Documents by id; the filter reaches the ORC reader (statistics and Bloom filters)."""
    return spark.read.orc(path).where(F.col("doc_id").isin(list(doc_ids))).select("doc_id", "n_tokens", "ids")


def with_crc(tokens: DataFrame, ids: str = "ids", out: str = "ids_crc32") -> DataFrame:
    """Unsigned crc32 of the ids as little-endian uint32, instead of the ids."""
    import zlib

    rest = [c for c in tokens.columns if c != ids]
    fields = ", ".join(f"`{c}` {tokens.schema[c].dataType.simpleString()}" for c in rest)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            lists = b.column(ids)
            flat = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False).astype("<i4", copy=False)).view(np.uint8)
            ends = lists.offsets.to_numpy().astype(np.int64) * 4
            ends -= ends[0]
            crc = [zlib.crc32(flat[a:z]) for a, z in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(crc, pa.int64())], [*rest, out])

    return tokens.mapInArrow(digest, f"{fields}, `{out}` long")
