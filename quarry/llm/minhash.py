"""MinHash near-dedup by fast similarity sketches (operator 12).

A document's set holds its distinct word shingles.  Two documents are linked if the Jaccard
similarity of their sets, counted exactly, reaches the threshold; components of links are the
groups.

1. **Sketch** (``sketches``).  In round i every element is hashed with the round's own hash,
   which names a bin and a value; a bin keeps the smallest value of the first round that
   reached it.  After ``bins`` rounds the bins still empty are filled one by one, round
   ``bins + b`` putting all elements into bin b, so every coordinate is filled whatever the
   size of the set, mostly after one or two rounds.  Two sets agree in a coordinate with
   probability equal to their similarity, and the number of agreeing coordinates is
   concentrated as if each were drawn independently.
2. Equal sets are one row from here on (128-bit digest), so exact copies cost nothing more.
3. **Banding**: ``rows`` coordinates make a band, whose hash is a bucket.  A pair at the
   threshold misses all ``bands`` with probability ``(1 - similarity ** rows) ** bands``
   (2e-10 at 0.8); a setting that misses more than one in 1e9 is refused.  One bit of each of
   the first 128 coordinates makes a code; a pair whose codes differ in more than ``apart``
   bits is no candidate (4e-12 of the pairs at 0.8 do).
4. **Stars**: a bucket's rows are compared with its first one, never with each other, so a
   bucket of n near copies gives n - 1 candidates.  Buckets that hold over a thousandth of all
   rows are split, and the first rows of their parts are compared in a second star.
5. **Verification** counts common and different shingles of the two texts themselves.
6. **Rest**: only buckets whose rows fall into several components after that can hold links
   that were not looked at.  There the rows outside the first row's component are compared
   with all others in blocks, by two bits of every coordinate: a pair with more than ``far``
   different ones is no candidate (8e-11 of the pairs at 0.8, while of the pairs at 0.45, such
   as documents with a passage in common, one in a thousand stays), and by what both are known
   to share with the bucket's first row, from which it follows exactly how much they can share
   at most (``_bound``).  Each row proposes its
   nearest partners of other components, a few in the first wave and all that are left in the
   second, as one row with a list, and each wave is verified and joined before the next.  There
   a row's text meets its partners' texts in blocks of about ``HELD`` of them, so a pair is
   eight bytes of a list and never a row (``_linked_lists``).  So no link is lost, and a bucket whose rows are linked costs
   nothing more than its star.

Defined results: a text without words, empty or null, has an empty set and is a group of its
own; a text of fewer words than a shingle has one shingle, the whole sequence; a null id counts
as larger than any other when a group is named, and a group of null ids has a null name and
keeps those rows; repeated rows are copies like any other; an empty table gives an empty
result; other columns are ignored by ``components`` and kept by ``near_dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import batch_texts, parts, texts_to_python
from quarry.llm.graph import connected_components
from quarry.llm.sketch import bloom, may_contain
from quarry.session import scratch_path, stored

SHINGLE, PERCENT = 5, 80
BINS, ROWS, BANDS = 256, 4, 42
CODE_BITS, APART, FAR = 128, 42, 82
MISS = 1e-9
PARTS = 64
#: partners a row may propose up to, wave by wave
WAVES = (8, 1 << 62)
#: texts that a task holds at a time to compare others with
HELD = 128
#: rows that meet them there, and pairs of a text that meet in a task
VISITS = 256
BLOCK = 16_384

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_GOLD = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _seed(i: int) -> np.uint64:
    return _mix(np.array([(i + 1) * _GOLD & 0xFFFFFFFFFFFFFFFF], np.uint64))[0]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # bytes: A-Z only, blanks are \\x20 and \\x09-\\x0d


def shingles(text: str | None, size: int) -> set:
    """The set itself: distinct tuples of ``size`` words."""
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def elements(words: list[bytes], size: int) -> np.ndarray:
    """Two 64-bit hashes of each distinct shingle, as columns; rows are all distinct shingles,
    told apart by the numbers of their words and not by hashes."""
    if not words:
        return np.empty((0, 2), np.uint64)
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    raw = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, number)), "<u8").reshape(-1, 2)
    size = min(size, len(ids))
    codes = ids[: len(ids) - size + 1]
    for j in range(1, size):
        codes = np.unique(codes * len(number) + ids[j : len(ids) - size + 1 + j], return_inverse=True)[1]
    at = np.unique(codes, return_index=True)[1]
    h = np.full((len(at), 2), size, np.uint64)
    for j in range(size):
        h = _mix(h * np.uint64(_GOLD) + raw[ids[at + j]])
    return h


def set_digest(h: np.ndarray) -> bytes:
    return hashlib.md5(h[np.lexsort((h[:, 1], h[:, 0]))].tobytes()).digest()


def sketches(sets: Sequence[np.ndarray], bins: int = BINS) -> np.ndarray:
    """A row of ``bins`` coordinates for each (non-empty) array of 64-bit element hashes."""
    n = len(sets)
    out = np.full((n, bins), _EMPTY, np.uint64)
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    e = np.concatenate(sets) if n else np.empty(0, np.uint64)
    flat = out.reshape(-1)
    for i in range(2 * bins):
        if i:
            empty = out == _EMPTY
            open_ = empty.any(axis=1) if i < bins else empty[:, i - bins]
            if not empty.any():
                break
            if i >= bins and not open_.any():
                continue
            take = open_[of]
            live_e, live_of = e[take], of[take]
        else:
            live_e, live_of = e, of
        h = _mix(live_e ^ _seed(i))
        at = (h % np.uint64(bins)).astype(np.int64) if i < bins else np.full(len(h), i - bins)
        value = np.uint64(i << 48) | (_mix(h) >> np.uint64(16))
        np.minimum.at(flat, live_of * bins + at, value)
    return out


def bands_of(sketch: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """The buckets of each sketch."""
    cells = sketch[:, : rows * bands].reshape(len(sketch), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cells.shape[:2])
    for j in range(rows):
        h = _mix(h * np.uint64(_GOLD) + cells[:, :, j])
    return h


def codes_of(sketch: np.ndarray) -> np.ndarray:
    """One bit of each of the first coordinates, as two numbers a sketch."""
    bits = np.packbits((_mix(sketch[:, :CODE_BITS]) & np.uint64(1)).astype(np.uint8), axis=1)
    return np.ascontiguousarray(bits).view("<u8")


def marks_of(sketch: np.ndarray) -> np.ndarray:
    """Two bits of each coordinate, as bytes."""
    two = (_mix(sketch) & np.uint64(3)).astype(np.uint8).reshape(len(sketch), -1, 4)
    return two[:, :, 0] | two[:, :, 1] << 2 | two[:, :, 2] << 4 | two[:, :, 3] << 6


def marks_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many coordinates the marks (rows of numbers) differ, for all pairs."""
    out = np.zeros((len(a), len(b)), np.int16)
    for w in range(a.shape[1]):
        differ = a[:, w, None] ^ b[None, :, w]
        out += np.bitwise_count((differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)).astype(np.int16)
    return out


# ---- sets and buckets ------------------------------------------------------------------


def _sets(docs: DataFrame, doc_id: str, text: str, size: int, rows: int, bands: int) -> DataFrame:
    """(doc_id, text, rid, n, sid, b0, b1, marks, bands): every row of ``docs``, written once."""
    kept_type = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "text", "rid", "n", "sid", "b0", "b1", "marks", "bands"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            sets = [elements(words_of(t), size) for t in batch_texts(b)]
            full = [i for i, h in enumerate(sets) if len(h)]
            sketch = sketches([sets[i][:, 0] for i in full])
            code, band = codes_of(sketch), bands_of(sketch, rows, bands).view(np.int64)
            at = {i: j for j, i in enumerate(full)}
            code, marks = code.view(np.int64).reshape(-1, CODE_BITS // 64), marks_of(sketch)
            cells = [[None if i not in at else int(code[at[i], c]) for i in range(len(sets))] for c in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(c) for c in names[:3]),
                    pa.array([len(h) for h in sets], pa.int64()),
                    pa.array([set_digest(h) if len(h) else None for h in sets], pa.binary()),
                    *(pa.array(c, pa.int64()) for c in cells),
                    pa.array([marks[at[i]].tobytes() if i in at else None for i in range(len(sets))], pa.binary()),
                    pa.array([band[at[i]] if i in at else None for i in range(len(sets))], pa.list_(pa.int64())),
                ],
                names,
            )

    own = texts_to_python(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("rid", F.monotonically_increasing_id())
    shape = f"doc_id {kept_type}, text string, rid long, n long, sid binary, b0 long, b1 long, marks binary, bands array<bigint>"
    path = scratch_path(docs.sparkSession, "sets")
    # the only copy of the texts, kept to the end
    own.mapInArrow(measure, shape).write.parquet(path, compression="zstd")
    return docs.sparkSession.read.parquet(path)


def _log2_bits(n: int) -> int:
    """Of a Bloom filter for ``n`` keys."""
    return min(27, max(16, (16 * n).bit_length()))


def _starts(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


_CELL = ["key", "salt", "rid", "b0", "b1"]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with the first row of their (key, salt), as a stream; buckets
    of one row in one part (salt -1) are dropped."""
    names = [*_CELL, "center", "c0", "c1"]
    held: np.ndarray | None = None  # the last bucket's first row, not yet given out if alone
    alone = False
    for b in batches:
        if not b.num_rows:
            continue
        x = np.stack([b.column(c).to_numpy().astype(np.int64) for c in _CELL])
        if held is not None and (x[:2, 0] == held[:2]).all():
            lead = held[:, None]
        else:
            if held is not None and alone and held[1] >= 0:
                yield _star_batch(np.concatenate([held, held[2:]])[:, None], names)
            lead, alone = np.empty((5, 0), np.int64), False
        joined = np.concatenate([lead, x], axis=1)
        new = _starts(joined[0], joined[1])
        run = np.cumsum(new) - 1
        at = np.nonzero(new)[0]
        size = np.diff(np.append(at, joined.shape[1]))
        out = np.concatenate([joined, joined[2:][:, at[run]]])
        give = (size[run] > 1) | (joined[1] >= 0)
        if lead.shape[1] and not alone:
            give[0] = False  # given out with an earlier batch
        last_alone = size[-1] == 1 and (len(at) > 1 or not lead.shape[1])
        if last_alone:
            give[-1] = False  # its bucket may go on in the next batch
        held, alone = joined[:, at[-1]], bool(last_alone)
        if give.any():
            yield _star_batch(out[:, give], names)
    if held is not None and alone and held[1] >= 0:
        yield _star_batch(np.concatenate([held, held[2:]])[:, None], names)


def _star_batch(x: np.ndarray, names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c).cast(k) for c, k in zip(x, kinds, strict=True)], names)


def _buckets(firsts: DataFrame, total: int) -> DataFrame:
    """Rows of all buckets with company: key, salt, rid, code, and their part's first row.

    Most buckets hold one row; keys alone are counted first, and rows of other buckets travel.
    """
    spark = firsts.sparkSession
    rows = firsts.select(F.explode("bands").alias("key"), "rid", "b0", "b1")
    most = max(1_000, total // 1_000)  # rows of a bucket from which it is split
    counts = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "keys")
    hot = counts.where(F.col("times") > most).orderBy(F.desc("times"), "key").limit(1_000)
    is_hot = F.col("key").isin([r.key for r in hot.collect()])
    log2 = _log2_bits(counts.count())
    rows = rows.where(may_contain(bloom(counts, "key", log2), F.col("key"), log2))
    salted = F.pmod(F.xxhash64("rid"), F.lit(PARTS)).cast("int")
    dealt = rows.select("key", F.when(is_hot, salted).otherwise(F.lit(-1)).alias("salt"), "rid", "b0", "b1")
    path = scratch_path(spark, "buckets")
    (
        dealt.repartition("key", "salt")
        .sortWithinPartitions("key", "salt", "rid")
        .mapInArrow(_stars, "key long, salt int, rid long, b0 long, b1 long, center long, c0 long, c1 long")
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def _differ(a: Sequence[str], b: Sequence[str]):
    return F.bit_count(F.col(a[0]).bitwiseXOR(F.col(b[0]))) + F.bit_count(F.col(a[1]).bitwiseXOR(F.col(b[1])))


def _star_pairs(buckets: DataFrame, apart: int) -> DataFrame:
    """(a, b): rows and the first rows of their parts, and those and the first of the bucket."""
    near = _differ(("b0", "b1"), ("c0", "c1")) <= apart
    own = buckets.where((F.col("rid") != F.col("center")) & near).select(F.col("center").alias("a"), F.col("rid").alias("b"))
    centers = buckets.where("salt >= 0 and rid = center").select("key", "rid", "b0", "b1")
    first = centers.groupBy("key").agg(F.min(F.struct("rid", "b0", "b1")).alias("f")).select("key", F.col("f.rid").alias("a"), F.col("f.b0").alias("c0"), F.col("f.b1").alias("c1"))
    second = centers.join(first, "key").where((F.col("rid") != F.col("a")) & near).select("a", F.col("rid").alias("b"))
    return own.union(second).distinct()


# ---- verification ----------------------------------------------------------------------


def _wanted(sets: DataFrame, ids: DataFrame, n: int, name: str) -> DataFrame:
    """(rid, text, n) of the rows ``ids`` (``n`` of them) and a few others, written out: the texts
    of the rest do not travel to the joins."""
    log2 = _log2_bits(n)
    path = scratch_path(sets.sparkSession, name)
    sets.where(may_contain(bloom(ids, "rid", log2), F.col("rid"), log2)).select("rid", "text", "n").write.parquet(path, compression="zstd")
    return sets.sparkSession.read.parquet(path)


def _compared(pairs: DataFrame, sets: DataFrame, size: int, percent: int, every: bool = False) -> DataFrame:
    """(a, b, common, linked): how many shingles the two texts share, and whether that is
    enough; without ``every`` pairs that sizes alone rule out are left out.

    An ``a`` has a part for about ``VISITS`` of its pairs, each with its text once.
    """
    spark = pairs.sparkSession
    pairs = stored(pairs, "pairs")
    n = pairs.count()
    if not n:
        return pairs.select("a", "b", F.lit(0).cast("long").alias("common"), F.lit(False).alias("linked"))
    ids = pairs.select(F.col("a").alias("rid")).union(pairs.select(F.col("b").alias("rid")))
    texts = _wanted(sets, ids, n, "pair-texts")
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / VISITS).cast("int").alias("parts")).where("parts > 1")
    many = F.broadcast(many) if n < VISITS * 100_000 else many  # n / VISITS rows at most
    pairs = pairs.join(many, "a", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")), F.lit(0)).cast("int")).drop("parts")
    right = pairs.join(texts.select(F.col("rid").alias("b"), F.col("text").alias("tb"), F.col("n").alias("nb")), "b")
    left = pairs.select("a", "part").distinct().join(texts.select(F.col("rid").alias("a"), F.col("text").alias("ta"), F.col("n").alias("na")), "a")
    both = right.join(left, ["a", "part"])
    if not every:
        both = both.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for b in parts(batches):
            shared, good = [], []
            for a, ta, tb in zip(b.column("a").to_pylist(), b.column("ta"), b.column("tb"), strict=True):
                if a != last:
                    last, own = a, shingles(ta.as_py(), size)
                other = shingles(tb.as_py(), size)
                common = len(own & other)
                shared.append(common)
                good.append(100 * common >= percent * (len(own) + len(other) - common))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(shared, pa.int64()), pa.array(good, pa.bool_())], ["a", "b", "common", "linked"])

    out = scratch_path(spark, "links")
    texts_to_python(both).select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long, common long, linked boolean").write.parquet(out)
    return spark.read.parquet(out)


# ---- what stars leave open -------------------------------------------------------------


_ROW = ["rid", "marks", "n", "common", "center", "own"]


def _cells(open_rows: DataFrame, block: int) -> DataFrame:
    """``open_rows`` (key, rid, marks, center, outside) dealt into cells (key, part, block): the
    rows outside are at home in their block, for every part; every row visits all blocks, one
    outside those up to its own (part -1), any other in its part."""
    sizes = open_rows.groupBy("key").agg(F.count_if("outside").alias("outer"), F.count_if(~F.col("outside")).alias("inner"))
    sizes = sizes.select("key", F.ceil(F.col("outer") / block).cast("int").alias("blocks"), F.ceil(F.col("inner") / (8 * block)).cast("int").alias("parts"))
    big = sizes.where("blocks > 1 or parts > 1")
    placed = open_rows.join(big, "key", "left").na.fill(1, ["blocks", "parts"])
    h = F.xxhash64("rid")
    own, part = F.pmod(h, F.col("blocks")).cast("int"), F.pmod(h, F.col("parts")).cast("int")
    at = lambda part, block, visits: F.struct(part.cast("int").alias("part"), block.cast("int").alias("block"), F.lit(visits).alias("visits"))
    homes = F.transform(F.sequence(F.lit(-1), F.col("parts") - 1), lambda p: at(p, own, False))
    visits = F.transform(F.sequence(F.lit(0), own), lambda j: at(F.lit(-1), j, True))
    inner = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: at(part, j, True))
    to = F.when(F.col("outside"), F.concat(homes, visits)).otherwise(inner)
    return placed.select("key", F.explode(to).alias("to"), "rid", "marks", "n", "common", "center", own.alias("own")).select("key", "to.*", *_ROW)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The numbers in the lists of a batch, each once."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0).flatten().unique()], ["rid"])


def _linked_lists(lists: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) of the rows ``rid`` and their ``others`` whose sets are as similar as asked.

    Others are dealt into blocks by a hash; a row goes to the blocks that its list touches, and
    there to one of the block's parts, each of which holds the block's texts.  A block has a part
    for about ``VISITS`` rows.
    """
    spark = lists.sparkSession
    lists = lists.groupBy("rid").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
    lists = stored(lists, "lists")
    n = lists.count()
    if not n:
        return lists.select(F.col("rid").alias("a"), F.col("rid").alias("b"))
    others = stored(lists.select("others").mapInArrow(_members, "rid long").distinct(), "others")
    n_others = others.count()
    blocks = max(1, -(-n_others // HELD))
    block = lambda rid: F.pmod(F.xxhash64(rid, F.lit("held")), F.lit(blocks)).cast("int")
    visits = lists.select("rid", F.explode(F.array_distinct(F.transform("others", block))).alias("block"))
    sizes = visits.groupBy("block").agg(F.count(F.lit(1)).alias("visits"))
    sizes = stored(sizes.select("block", F.ceil(F.col("visits") / VISITS).cast("int").alias("parts")), "list-blocks")
    texts = _wanted(sets, lists.select("rid").union(others), n + n_others, "list-texts").select("rid", "text")
    held = others.withColumn("block", block(F.col("rid"))).join(sizes, "block").join(texts, "rid")
    held = held.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    held = held.select("block", "part", F.lit(0).alias("kind"), "rid", "text", F.array().cast("array<bigint>").alias("others"))
    part = F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int").alias("part")
    to = visits.join(sizes, "block").groupBy("rid").agg(F.collect_list(F.struct("block", part)).alias("to"))
    rows = lists.join(to, "rid").join(texts, "rid").withColumn("to", F.explode("to"))
    rows = rows.select("to.block", "to.part", F.lit(1).alias("kind"), "rid", "text", "others")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}
        for b in parts(batches):
            a, c = [], []
            for i, (place, part, kind, rid, others) in enumerate(zip(*(b.column(n).to_pylist() for n in ("block", "part", "kind", "rid", "others")), strict=True)):
                if cell != (place, part):
                    cell, held = (place, part), {}
                own = shingles(b.column("text")[i].as_py(), size)
                if not kind:
                    held[rid] = own
                    continue
                for o in others:
                    other = held.get(o)
                    if other and 100 * min(len(own), len(other)) >= percent * max(len(own), len(other)):
                        common = len(own & other)
                        if 100 * common >= percent * (len(own) + len(other) - common):
                            a.append(rid)
                            c.append(o)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], ["a", "b"])

    met = texts_to_python(held.unionByName(rows)).repartition("block", "part").sortWithinPartitions("block", "part", "kind")
    path = scratch_path(spark, "list-links")
    met.mapInArrow(check, "a long, b long").write.parquet(path)
    return spark.read.parquet(path)


_PLACE = ["key", "part", "block", "visits", "rid", "center", "own", "root", "n", "common"]


def _bound(v: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The most shingles that a visitor and a home can share, and the sum of their sizes.

    What they share inside the first row's set is in both of their shares of it, what they
    share outside is in both of their rests.  A share that is not known (below 0), or of
    another first row, says nothing: the smaller size is the bound.
    """
    nv, mv, nh, mh = v[8][:, None], v[9][:, None], h[8][None, :], h[9][None, :]
    most = np.minimum(mv, mh) + np.minimum(nv - mv, nh - mh)
    known = (mv >= 0) & (mh >= 0) & (v[5][:, None] == h[5][None, :])
    return np.where(known, most, np.minimum(nv, nh)), nv + nh


def _proposals(far: int, percent: int, low: int, high: int):
    """(rid, others): partners of other components in each cell of a sorted partition: of a
    visitor's near homes, nearest first, those of rank ``low`` to ``high``; rid -1 if more are
    left."""

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, more = None, False
        homes, home_marks = np.empty((len(_PLACE), 0), np.int64), np.empty((0, 2 * BINS // 64), np.uint64)
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _PLACE])
            marks = np.frombuffer(b"".join(b.column("marks").to_pylist()), "<u8").reshape(x.shape[1], -1)
            at = np.nonzero(_starts(*x[:4]))[0]
            a, lists = [], []
            for s, e in zip(at, np.append(at[1:], x.shape[1]), strict=True):
                if cell != (now := tuple(x[:3, s])):
                    cell, homes, home_marks = now, homes[:, :0], home_marks[:0]
                if not x[3, s]:
                    homes, home_marks = np.concatenate([homes, x[:, s:e]], axis=1), np.concatenate([home_marks, marks[s:e]])
                    continue
                rid, center, root = homes[4], homes[5], homes[7]
                step = max(1, (1 << 20) // max(1, len(rid)))
                for i in range(s, e if len(rid) else s, step):
                    v = x[:, i : min(i + step, e)]
                    differ = marks_apart(marks[i : min(i + step, e)], home_marks)
                    near = (differ <= far) & (v[4][:, None] != rid)
                    most, sizes = _bound(v, homes)
                    near &= 100 * most >= percent * (sizes - most)
                    near &= (v[5][:, None] != rid) & (v[4][:, None] != center)  # stars have been looked at
                    if cell[1] < 0:
                        near &= (v[6] != cell[2])[:, None] | (v[4][:, None] < rid)  # each pair once
                    for k in np.nonzero(near.any(axis=1))[0]:
                        found = np.nonzero(near[k])[0]
                        found = found[np.lexsort((rid[found], differ[k][found]))]
                        more |= bool((root[found[high:]] != v[7][k]).any())
                        found = found[low:high]
                        found = found[root[found] != v[7][k]]
                        if len(found):
                            a.append(int(v[4][k]))
                            lists.append(rid[found])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], ["rid", "others"])
        if more:
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([[]], pa.list_(pa.int64()))], ["rid", "others"])

    return propose


def _roots(links: DataFrame) -> DataFrame:
    """(rid, root) of every row that has a link, written out."""
    path = scratch_path(links.sparkSession, "roots")
    connected_components(links).select(F.col("node").alias("rid"), "root").write.parquet(path)
    return links.sparkSession.read.parquet(path)


def _labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "rid", "left").withColumn("root", F.coalesce("root", "rid"))


def _rest(buckets: DataFrame, stars: DataFrame, links: DataFrame, roots: DataFrame, sets: DataFrame, size: int, percent: int, far: int, block: int) -> DataFrame:
    """The roots after the links that stars did not look at."""
    spark = buckets.sparkSession
    marked = _labelled(buckets, roots)
    first = F.min(F.struct("rid", "root")).getField("root").alias("first")
    state = marked.groupBy("key").agg(first, F.min("root").alias("low"), F.max("root").alias("high"))
    several = state.where("low < high").select("key", "first")
    open_rows = marked.join(several, "key").select("key", "rid", "center", (F.col("root") != F.col("first")).alias("outside"))
    shares = stars.select(F.col("a").alias("center"), F.col("b").alias("rid"), "common")
    open_rows = open_rows.join(sets.select("rid", "marks", "n"), "rid").join(shares, ["center", "rid"], "left")
    own = F.when(F.col("rid") == F.col("center"), F.col("n")).otherwise(F.lit(-1))
    open_rows = open_rows.withColumn("common", F.coalesce("common", own))
    path = scratch_path(spark, "cells")
    _cells(open_rows, block).write.parquet(path)
    cells, low = spark.read.parquet(path), 0
    for high in WAVES:
        found = (
            _labelled(cells, roots)
            .repartition("key", "part", "block")
            .sortWithinPartitions("key", "part", "block", "visits", "rid")
            .mapInArrow(_proposals(far, percent, low, high), "rid long, others array<bigint>")
        )
        path = scratch_path(spark, "proposals")
        found.write.parquet(path)
        found = spark.read.parquet(path)
        new = _linked_lists(found.where("rid >= 0"), sets, size, percent)
        if not new.isEmpty():
            links = links.union(new)
            roots = _roots(links)
        if found.where("rid < 0").isEmpty():
            break
        low = high
    return roots


def _firsts(sets: DataFrame, same: DataFrame) -> DataFrame:
    """The rows of ``sets`` that stand for their set: those whose set occurs once stay where they
    are, any others are looked up."""
    sets, several = sets.where("n > 0"), same.where("times > 1")
    log2 = _log2_bits(several.count())
    copied = may_contain(bloom(several, "sid", log2), F.col("sid"), log2)
    found = sets.where(copied).join(same.where(copied).select(F.col("rep").alias("rid")), "rid", "left_semi")
    return sets.where(~copied).unionByName(found)


def _grouped(
    docs: DataFrame, doc_id: str, text: str, shingle: int, percent: int, rows: int, bands: int, apart: int, block: int
) -> tuple[DataFrame, DataFrame]:
    """All rows as ``_sets`` has them, and (rid, least, first): of each row's group the smallest
    id and the row that has it."""
    if rows * bands > BINS:
        raise ValueError(f"{rows} x {bands} coordinates of {BINS}")
    if (1 - (percent / 100) ** rows) ** bands > MISS:
        raise ValueError("these bands miss too many pairs at the threshold")
    sets = _sets(docs, doc_id, text, shingle, rows, bands)
    spark = docs.sparkSession
    least = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "rid")).alias("least")
    same = stored(sets.where("n > 0").groupBy("sid").agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("times"), least), "equal")
    firsts = _firsts(sets, same)
    buckets = _buckets(firsts.select("rid", "b0", "b1", "bands"), same.count() * bands)
    stars = _compared(_star_pairs(buckets, apart), sets, shingle, percent, every=True)
    links = stars.where("linked").select("a", "b")
    roots = _rest(buckets, stars, links, _roots(links), sets, shingle, percent, FAR, block)
    named = _labelled(same.withColumnRenamed("rep", "rid").drop("times"), roots)
    best = named.groupBy("root").agg(F.min("least").alias("best"))
    of_set = named.select("sid", "root").join(best, "root").select("sid", "best")
    alone = sets.where("n = 0").select("rid", F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "rid").alias("best"))
    # a set that a third of the rows share is one key: its rows are dealt over parts
    parts_ = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    hot = same.where(F.col("times") > 10_000).select("sid")
    keyed = sets.where("n > 0").select("sid", "rid")
    spread = of_set.join(hot, "sid").select("sid", parts_, "best")
    big = keyed.join(hot, "sid", "left_semi").withColumn("part", F.pmod(F.xxhash64("rid"), F.lit(PARTS)).cast("int"))
    many = big.join(spread, ["sid", "part"]).select("rid", "best")
    few = keyed.join(hot, "sid", "left_anti").join(of_set, "sid").select("rid", "best")
    return sets, many.union(few).union(alone)


def components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    rows: int = ROWS,
    bands: int = BANDS,
    apart: int = APART,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``; ``kept`` is true of
    the rows whose id names their group."""
    sets, groups = _grouped(docs, doc_id, text, shingle, percent, rows, bands, apart, block)
    out = sets.select("rid", "doc_id", F.col("n").alias("n_shingles")).join(groups, "rid")
    name = F.col("best.doc_id")
    return out.select("doc_id", "n_shingles", name.alias("component_id"), F.col("doc_id").eqNullSafe(name).alias("kept"))


def near_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    rows: int = ROWS,
    bands: int = BANDS,
    apart: int = APART,
    block: int = BLOCK,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose id names their group."""
    kept = components(docs, doc_id, text, shingle, percent, rows, bands, apart, block).where("kept").select("doc_id").distinct()
    columns = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(columns))])  # columns may have any names
    at = inner[f"c{columns.index(doc_id)}"]
    return inner.join(kept, at.eqNullSafe(kept["doc_id"]), "left_semi").toDF(*columns)
