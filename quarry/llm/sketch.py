"""A Bloom filter in DataFrame operations: a fixed number of bits, whatever is put in.

It keeps rows that cannot match away from a shuffle; an exact join follows, so a false
positive costs one row and nothing is lost.  The filter is one row holding an array of
``2 ** (log2_bits - 6)`` longs, which is the proven size of what each task gets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG2_BITS = 23
HASHES = 3


def _positions(key: Column, log2_bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(1 << log2_bits)) for i in range(HASHES)]


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(position, F.lit(64)).cast("int"))


def bloom(keys: DataFrame, key: str, log2_bits: int = LOG2_BITS) -> Column:
    """The filter of column ``key`` as a scalar subquery for ``may_contain``."""
    spark = keys.sparkSession
    word = F.shiftright("p", 6)
    bits = (
        keys.select(F.explode(F.array(*_positions(F.col(key), log2_bits))).alias("p"))
        .groupBy(word.alias("word"))
        .agg(F.bit_or(_bit(F.col("p"))).alias("bits"))
    )
    dense = spark.range(1 << (log2_bits - 6)).withColumnRenamed("id", "word").join(bits, "word", "left")
    rows = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return dense.agg(rows.getField("bits").alias("words")).scalar()


def may_contain(words: Column, key: Column, log2_bits: int = LOG2_BITS) -> Column:
    """False only if ``key`` was not put in."""
    found = F.lit(True)
    for p in _positions(key, log2_bits):
        found &= F.get(words, F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0
    return found
