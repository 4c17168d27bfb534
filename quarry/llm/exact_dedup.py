"""Exact dedup by an extendible-hash index on shared files (operator 6), DataFrame only.

1. Every row becomes an entry on the shared folder: a 64-bit hash of its normalised text (A-Z
   lower-cased), the SHA-256 that the result shows, the row's id and the text.
2. The directory starts with ``2 ** min_depth`` buckets, one for each prefix of the hash.  A
   bucket of more than ``capacity`` distinct hashes is overfull: the directory doubles and the
   bucket is split by the next bit, until it fits or ``max_depth`` is reached, which by default
   follows from the number of rows so that it is not.
3. Entries are chained: of each hash that occurs more than once the different texts, compared
   byte by byte, are the links of its chain.  Only texts of such hashes travel (a Bloom filter
   keeps others away), equal ones as one row of each task; rows then find their link by their
   text.  A text that very many rows share is dealt over parts.
4. Index files hold key ranges (bucket, hash, chain, row): a hash that a third of the rows
   share lies in many ranges.  The task that owns a range adds up its groups, one row for each
   (bucket, hash, chain), and what reaches over a range's end is added up after that.  Neither
   hash decides what is equal: texts of equal hash and SHA-256 are different links.
5. The largest doc_id of a group stays.  Groups of over a thousandth of the rows reach their
   rows by a broadcast of at most a thousand of them, all others by a join.

Edge cases: a null text is an empty text; a null doc_id counts as smaller than any other; of
rows that share the largest doc_id of a group one stays (the first read); repeated rows are
rows of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.segments import lookup
from quarry.llm.sketch import bloom, may_contain
from quarry.plans.strategies import broadcast_if_small
from quarry.session import scratch_path

CAPACITY = 65_536
MIN_DEPTH, MAX_DEPTH = 4, 40
#: doublings beyond those that rows spread evenly need
SPARE_DEPTH = 4
#: rows of one text from which on they are dealt over parts
COMMON, PARTS = 10_000, 64


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else; ``lower`` does just that on texts of ASCII."""
    text = F.coalesce(text, F.lit(""))
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def hashed(text: Column) -> Column:
    return F.xxhash64(text)


def digested(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def depth_for(rows: int, capacity: int, min_depth: int = MIN_DEPTH) -> int:
    """Bits of the hash that buckets of ``capacity`` need, and some to spare."""
    return min(MAX_DEPTH, max(min_depth, (rows // capacity).bit_length()) + SPARE_DEPTH)


def directory(hashes: DataFrame, capacity: int, min_depth: int, max_depth: int) -> DataFrame:
    """``(cell, depth, bucket)`` for each occupied ``max_depth``-bit prefix of column ``h``."""
    cells = hashes.groupBy(F.shiftrightunsigned("h", 64 - max_depth).alias("cell")).agg(F.count_distinct("h").alias("keys"))
    depths = F.explode(F.sequence(F.lit(min_depth), F.lit(max_depth))).alias("depth")
    path = cells.select("cell", "keys", depths).withColumn("prefix", F.expr(f"shiftright(cell, {max_depth} - depth)"))
    size = path.groupBy("depth", "prefix").agg(F.sum("keys").alias("size"))
    # the first depth at which the bucket around a cell fits; at max_depth there are no bits left
    fits = path.join(size, ["depth", "prefix"]).where((F.col("size") <= capacity) | (F.col("depth") == max_depth))
    first = fits.groupBy("cell").agg(F.min("depth").alias("depth"))
    bucket = F.expr(f"concat(depth, ':', substring(lpad(bin(cell), {max_depth}, '0'), 1, depth))")
    return first.withColumn("bucket", bucket)


def _chains(entries: DataFrame) -> DataFrame:
    """``(row, chain)`` of the entries whose hash occurs more than once: the number of the
    entry's text among the different texts of its hash, which are compared as they are."""
    path_of = lambda name: scratch_path(entries.sparkSession, name)
    shared = entries.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    texts = entries.select("h", "row", "text").where(may_contain(bloom(shared, "h"), F.col("h")))
    links = texts.groupBy("h", "text").agg(F.min("row").alias("head"), F.count(F.lit(1)).alias("times"))
    links = links.withColumn("chain", F.row_number().over(Window.partitionBy("h").orderBy("head")) - 1)
    links.write.parquet(path := path_of("links"))
    links = entries.sparkSession.read.parquet(path)
    few = links.where(F.col("times") <= COMMON).select("h", "text", F.lit(-1).alias("part"), "chain")
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    many = links.where(F.col("times") > COMMON).select("h", "text", parts, "chain")
    common = broadcast_if_small(links.where(F.col("times") > COMMON).select("h").distinct())
    part = F.pmod(F.xxhash64("row"), F.lit(PARTS)).cast("int")
    dealt = texts.join(common.withColumn("common", F.lit(True)), "h", "left")
    # a hash may have links of both kinds, so its rows look among both
    hot = dealt.where("common").withColumn("part", part).join(many, ["h", "text", "part"]).select("row", "chain")
    cold = dealt.withColumn("part", F.lit(-1)).join(few, ["h", "text", "part"]).select("row", "chain")
    hot.union(cold).write.parquet(path := path_of("chains"))
    return entries.sparkSession.read.parquet(path)


def build_index(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    min_depth: int = MIN_DEPTH,
    max_depth: int | None = None,
) -> DataFrame:
    """Write the index files and return them: bucket, h, chain, sha, doc_id, row."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text_ = normalised(F.col(text))
    docs.select(
        hashed(text_).alias("h"),
        digested(text_).alias("sha"),
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        text_.alias("text"),
    ).write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")
    depth = depth_for(entries.count(), capacity, min_depth) if max_depth is None else max_depth
    buckets = directory(entries.select("h"), capacity, min_depth, depth)
    placed = entries.select("h", "sha", "doc_id", "row", F.shiftrightunsigned("h", 64 - depth).alias("cell"))
    (
        placed.join(broadcast_if_small(buckets), "cell")
        .join(_chains(entries), "row", "left")
        .select("bucket", "h", F.coalesce("chain", F.lit(0)).alias("chain"), "sha", "doc_id", "row")
        .repartitionByRange(n, "bucket", "h", "chain", "row")
        .sortWithinPartitions("bucket", "h", "chain", "row")
        .write.parquet(f"{path}/index")
    )
    return spark.read.parquet(f"{path}/index")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain."""
    path = scratch_path(docs.sparkSession, "exact")
    index = build_index(docs, path, doc_id, text, **sizes)
    last = F.max(F.struct("doc_id", (-F.col("row")).alias("row")))  # of equal ids the first row read
    key = ["bucket", "h", "chain"]
    index.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"), last.alias("last")).write.parquet(f"{path}/groups")
    groups = docs.sparkSession.read.parquet(f"{path}/groups").withColumn("times", F.col("group_size"))
    return lookup(index, groups, key, "times", index.count()).select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == -F.col("last.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "bucket",
        "chain",
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """The rows of ``docs`` that stay, one for each different text; ids must not be null."""
    kept = exact_groups(docs, doc_id, text, **sizes).where("kept").select(F.col("doc_id").alias("_id"), "text_sha256")
    sha = F.sha2(normalised(F.col(text)).cast("binary"), 256)
    joined = docs.join(kept, (F.col(doc_id) == F.col("_id")) & (sha == F.col("text_sha256")), "left_semi")
    return joined.dropDuplicates([doc_id, text])
