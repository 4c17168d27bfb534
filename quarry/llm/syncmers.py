"""Closed-syncmer fingerprints (operator 10).

A k-mer of code points is a closed syncmer if the smallest hash among its s-mers stands at
its first or last place.  Whether a k-mer is chosen depends on its own characters alone, so
shared passages give the same anchors wherever they stand; at least one k-mer in every
``k - s`` is chosen.  ``anchors`` gives them with their positions for positional matching.

A text's anchors are compared whole: ``sketch`` has every anchor in order of position, as its
32-bit hash and the number of equal anchors before it.  The first occurrence of an anchor meets
the first one in the other text, the second the second, and so on.  ``in_order`` is positional
matching: of the anchors that meet, the longest chain that stands in one order in both texts,
as a share, 2 * chain / both.  Passages that moved count once along the chain, so shuffled
blocks score below kept order.  ``likeness`` is the share in common wherever anchors stand.
Both are exact but for anchors whose 32-bit hashes collide.  A fingerprint is the SHA-256 of all anchors in
order, so a text whose anchors change or move has another one.  ``sketch(size=...)`` is a
bounded sketch, the smallest different hashes; ``likeness`` with that size is exact while both
sketches are complete, an estimate beyond.

``with_neighbour`` brings each document's successor to it: documents are dealt into ranges
of ids whose bounds are quantiles, and the first document of a range is also sent to the end
of the range before.  Texts travel once, compressed; a task holds one document and its
successor at a time.

Edge cases: a text shorter than k characters, or without a chosen k-mer, has one anchor, the
whole text; a null text is
an empty text and has none (fingerprint ""): like another empty text (1), unlike any other
(0).  Null ids come before all others; equal ids are ordered by a hash of the text; repeated
rows follow each other.  Ids are longs: they are cast, and one that is no number is an error.
A single row is its own successor.  An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import batch_texts, parts, texts_to_python

K, S = 16, 5
#: code points hashed together; longer texts are cut with an overlap of k - 1
STEP = 1 << 20
RANGE_BYTES = 32 << 20
#: ranges at most: a range is read as a sorted stream and may be of any size
MAX_RANGES = 10_000

_MULTIPLIER = np.uint64(0x100000001B3)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _whole(wide: np.ndarray) -> np.ndarray:
    """One anchor for a whole short text."""
    h = np.uint64(len(wide))
    with np.errstate(over="ignore"):
        for c in wide:
            h = h * _MULTIPLIER + c
    return (_mix(np.array([h])) >> np.uint64(32)).astype(np.uint32)


def _anchors_in(codes: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 32-bit hashes of the closed syncmers of one run of code points."""
    n = len(codes)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.uint32)
    wide = codes.astype(np.uint64) + np.uint64(1)
    if n < k:
        return np.zeros(1, np.int64), _whole(wide)
    small = np.zeros(n - s + 1, np.uint64)
    for i in range(s):
        small = small * _MULTIPLIER + wide[i : i + len(small)]
    small = _mix(small)
    window = k - s + 1  # s-mers of a k-mer
    least, width = small, 1
    while 2 * width <= window:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    count = n - k + 1
    least = np.minimum(least[:count], least[window - width : window - width + count])
    at = np.nonzero((small[:count] == least) | (small[window - 1 : window - 1 + count] == least))[0]
    h = np.zeros(len(at), np.uint64)
    for i in [*range(0, k - s, s), k - s]:  # s-mers that cover the k-mer
        h = _mix(h * _MULTIPLIER + small[at + i])
    return at, (h >> np.uint64(32)).astype(np.uint32)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def syncmers(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    codes = _codes(text)
    if len(codes) <= STEP:
        return _anchors_in(codes, k, s)
    parts = [(at, *_anchors_in(codes[at : at + STEP + k - 1], k, s)) for at in range(0, len(codes) - k + 1, STEP)]
    return np.concatenate([at + p for at, p, _ in parts]), np.concatenate([h for _, _, h in parts])


def _numbered(h: np.ndarray) -> np.ndarray:
    """Hash (high half) and number of equal hashes before it (low half), in order of position."""
    order = np.argsort(h, kind="stable")
    sorted_ = h[order]
    first = np.ones(len(h), bool)
    first[1:] = sorted_[1:] != sorted_[:-1]
    out = h.astype(np.uint64) << np.uint64(32)
    if not first.all():
        at = np.arange(len(h))
        out[order] |= (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
    return out


def sketch(text: str, k: int = K, s: int = S, size: int | None = None) -> np.ndarray:
    """All anchors in order of position; with ``size`` the smallest different hashes.  A text
    of which no k-mer is chosen (its length is near k then) has one anchor, the whole text."""
    h = syncmers(text, k, s)[1]
    if text and not len(h):
        h = _whole(_codes(text).astype(np.uint64) + np.uint64(1))
    return _numbered(h) if size is None else np.unique(h)[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int | None = None) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    if size is None or max(len(a), len(b)) < size:
        return 2 * int(np.count_nonzero(both[1:] == both[:-1])) / len(both)
    jaccard = float((np.unique(both, return_counts=True)[1][:size] == 2).mean())
    return 2 * jaccard / (1 + jaccard)


def in_order(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the anchors of two whole sketches on the longest chain in both orders."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b, a, sorter=order), len(b) - 1)
    meets = b[order[at]] == a
    return 2 * _chain(order[at][meets]) / (len(a) + len(b))


def _chain(places: np.ndarray) -> int:
    """Length of the longest increasing subsequence of different numbers."""
    if len(places) < 2 or (places[1:] > places[:-1]).all():
        return len(places)
    ends: list[int] = []  # the smallest end of a chain of each length
    for p in places.tolist():
        if not ends or p > ends[-1]:
            ends.append(p)
        else:
            ends[bisect_left(ends, p)] = p
    return len(ends)


def as_text(fingerprint: np.ndarray) -> str:
    """64 hex digits that depend on every anchor and their order; "" without anchors."""
    return hashlib.sha256(fingerprint.astype(">u8").tobytes()).hexdigest() if len(fingerprint) else ""


def anchors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """``(doc_id, position, hash)`` of every closed syncmer."""
    kept_type = docs.schema[doc_id].dataType.simpleString()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            for key, t in zip(b.column("doc_id").to_pylist(), batch_texts(b), strict=True):
                at, h = syncmers(t or "", k, s)
                ids = pa.array([key] * len(at), b.schema.field("doc_id").type)
                yield pa.RecordBatch.from_arrays([ids, pa.array(at, pa.int64()), pa.array(h.astype(np.int64))], ["doc_id", "position", "hash"])

    own = texts_to_python(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(choose, f"doc_id {kept_type}, position long, hash long")


def _bounds(docs: DataFrame, ranges: int | None) -> list[int]:
    """Upper quantiles of the ids: one number for each range of about ``RANGE_BYTES``."""
    if ranges is None:
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = min(MAX_RANGES, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES)))
    if ranges < 2:
        return []
    shares = [F.lit(i / ranges) for i in range(1, ranges)]
    return sorted(set(docs.agg(F.percentile_approx("doc_id", F.array(*shares), F.lit(10 * ranges))).first()[0] or []))


def with_neighbour(docs: DataFrame, use, schema: str, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """``use(pairs)`` over a stream of ((id, text), (id, text) of the next document)."""
    own = texts_to_python(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bounds = _bounds(own, ranges)
    edges = np.array(bounds, np.int64)

    def range_of(ids: pa.Array) -> np.ndarray:
        known = np.asarray(ids.is_valid())
        at = np.searchsorted(edges, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right")
        return np.where(known, at, 0).astype(np.int32)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(range_of(b.column("doc_id"))), b.column("doc_id")], ["range", "doc_id"])

    first = F.when(F.max(F.col("doc_id").isNull()), F.lit(None)).otherwise(F.min("doc_id"))
    numbered = own.select("doc_id").mapInArrow(number, "range int, doc_id long")
    firsts = {r["range"]: r["first"] for r in numbered.groupBy("range").agg(first.alias("first")).collect()}
    before = {firsts[r]: p for p, r in zip([max(firsts, default=0), *sorted(firsts)], sorted(firsts), strict=False)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in parts(batches):
            ids = b.column("doc_id")
            to = [before.get(i, -1) for i in ids.to_pylist()]
            halo = np.array([i for i, p in enumerate(to) if p >= 0], np.int64)
            rows = np.concatenate([np.arange(b.num_rows), halo])
            texts = batch_texts(b)
            z = pa.array([squeeze(t.encode()) for t in texts], pa.binary())
            place = np.concatenate([range_of(ids), np.array([to[i] for i in halo], np.int32)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(place.astype(np.int32)),
                    pa.array(np.arange(len(rows)) >= b.num_rows),
                    ids.take(pa.array(rows)),
                    b.column("tie").take(pa.array(rows)),
                    z.take(pa.array(rows)),
                ],
                ["range", "halo", "doc_id", "tie", "z"],
            )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        open_ = zstandard.ZstdDecompressor().decompress
        last, last_range, done = None, None, True
        for b in batches:
            for place, halo, key, z in zip(*(b.column(c).to_pylist() for c in ("range", "halo", "doc_id", "z")), strict=True):
                if halo and done:
                    continue
                now = (key, open_(z).decode())
                if not done and place == last_range:
                    yield last, now
                last, last_range, done = now, place, halo

    dealt = (
        own.withColumn("tie", F.xxhash64("text"))
        .mapInArrow(deal, "range int, halo boolean, doc_id long, tie long, z binary")
        .repartitionById(len(bounds) + 1, "range")  # a range is a task
        .sortWithinPartitions("range", "halo", F.col("doc_id").asc_nulls_first(), "tie")
    )
    return dealt.mapInArrow(lambda batches: use(stream(batches)), schema)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Per document: n_chars, the edited text's SHA-256, both fingerprints, and how near the
    document is to the edited text and to the next document: ``near_*`` by anchors in order,
    ``shared_*`` by anchors wherever they stand."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "shared_edited", "shared_next"]

    def rows(pairs: Iterator[tuple]) -> Iterator[tuple]:
        ahead: tuple = ()
        for (key, own), (_, following) in pairs:
            mine = ahead[1] if ahead and ahead[0] is own else sketch(own)
            theirs = mine if following is own else sketch(following)
            ahead = (following, theirs)
            other = edited(own, following)
            changed = sketch(other)
            sha = hashlib.sha256(other.encode()).hexdigest()
            near = [f(mine, x) for f in (in_order, likeness) for x in (changed, theirs)]
            yield key, len(own), sha, as_text(mine), as_text(changed), *near

    def use(pairs: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)

        for r in rows(pairs):
            held.append(r)
            if len(held) == 1000:
                yield batch()
                held = []
        if held:
            yield batch()

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, shared_edited double, shared_next double"
    return with_neighbour(docs, use, schema, doc_id, text, ranges)
