"""Deterministic sampling expressions.

``hash_bucket`` maps a key to a bucket with ``md5``: the same rows fall in the same split on every engine, every partitioning, every rerun and every streaming
batch -- unlike ``randomSplit``, whose result depends on partition layout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# buckets of a split: fractions count in steps of a millionth
SPLIT_BUCKETS = 1_000_000


def hash_bucket(key: Column | str, seed: int, buckets: int = SPLIT_BUCKETS) -> Column:
    """``int(md5(f"{seed}|{key}")[:8], 16) % buckets``; a null key counts as empty."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.coalesce(k.cast("string"), F.lit(""))
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), text)), 1, 8), 16, 10)
    return F.pmod(h.cast("bigint"), F.lit(buckets))


def hash_split_flag(key: Column | str, seed: int, fraction: float) -> Column:
    """True for about ``fraction`` of the keys; never null, so ``~flag`` is the rest."""
    return hash_bucket(key, seed) < F.lit(int(round(fraction * SPLIT_BUCKETS)))


def hash_split_sql(key_sql: str, seed: int, fraction: float) -> str:
    """The DuckDB form of ``hash_split_flag`` (for oracle queries)."""
    return (
        f"(('0x' || substr(md5('{seed}|' || coalesce(cast({key_sql} as varchar), '')), 1, 8))::bigint "
        f"% {SPLIT_BUCKETS}) < {int(round(fraction * SPLIT_BUCKETS))}"
    )
