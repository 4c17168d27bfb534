"""Power-of-two packing (operator 7).

A document of ``n`` tokens is cut into pieces of lengths 2^k after the binary digits of
``n`` (at most ``max_tokens``), longest first.  Every piece is a sequence of its own, so no
sequence crosses documents and none needs padding; equal lengths share a bucket, from which
a training batch takes sequences of one length.

One pass over the documents without an exchange: a document's pieces depend on nothing
else.  ``sequence_id`` holds the bucket, the task and the row within it
(``bucket * 2^58 + monotonically_increasing_id``), so ids of one bucket are consecutive
ranges and are unique without a global count.

Edge cases: a null or empty text is the end id alone (one piece of one token); repeated
rows and repeated or null ids are packed as rows of their own; an empty table gives no
rows; other columns of ``docs`` are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import TextEncoder, batch_texts, parts, texts_to_python

MAX_TOKENS = 2048
#: pieces are handed over after so many bytes of ids, however long a document is
FLUSH_BYTES = 4 << 20


def piece_lengths(n: int, max_tokens: int = MAX_TOKENS) -> list[int]:
    """Whole ``max_tokens`` pieces, then the binary digits of the rest, longest first."""
    whole, rest = divmod(n, max_tokens)
    return [max_tokens] * whole + [1 << k for k in range(max_tokens.bit_length() - 2, -1, -1) if rest >> k & 1]


def pack(
    docs: DataFrame,
    spec: str,
    end_id: int,
    max_tokens: int = MAX_TOKENS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32 bytes),
    doc_tokens, sequence_id, offset, bucket (log2 of the length)."""
    if max_tokens & (max_tokens - 1) or max_tokens > 1 << 30:
        raise ValueError("max_tokens must be a power of two")
    kept_type = docs.schema[doc_id].dataType.simpleString()
    end = np.uint32(end_id).astype("<u4").tobytes()
    names = ["doc_id", "start", "length", "ids", "doc_tokens"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder.of(spec)
        kept_arrow = None

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [kept_arrow, pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for b in parts(batches):
            kept_arrow = b.schema.field("doc_id").type
            rows, size = [], 0
            for key, got in zip(b.column("doc_id").to_pylist(), encoder.encode(batch_texts(b)), strict=True):
                ids, start = got + end, 0
                n = len(ids) // 4
                for length in piece_lengths(n, max_tokens):
                    rows.append((key, start, length, ids[4 * start : 4 * (start + length)], n))
                    start += length
                    size += 4 * length
                    if size >= FLUSH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
            if rows:
                yield batch(rows)

    own = texts_to_python(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    pieces = own.mapInArrow(cut, f"doc_id {kept_type}, start long, length long, ids binary, doc_tokens long")
    bucket = (F.length(F.bin("length")) - 1).cast("long")
    return pieces.withColumn("bucket", bucket).select(
        "doc_id",
        "start",
        "length",
        "ids",
        "doc_tokens",
        (F.shiftleft("bucket", 58) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        "bucket",
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder for each length: a batch reads one folder."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(path)
