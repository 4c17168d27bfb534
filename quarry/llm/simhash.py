"""SimHash near-dedup by anchor points (operator 9).

Fingerprints: 64 bits over the word shingles of a text (``fingerprints``).

Links: two fingerprints at ``max_bits`` (3) or fewer differing bits.  One of the two 32-bit
halves then differs in at most ``max_bits // 2 = 1`` bit.  In each half the anchors are the
codewords of the perfect Hamming code of length 31: every half lies within the covering
radius 1 of exactly one anchor, its home.  A fingerprint is replicated to every anchor of a
half within covering radius plus threshold (1 + 1 = 2 bits: at most 16 anchors), so
whichever of a linked pair is at home at an anchor meets the other one there.  Full
fingerprints are compared per anchor.

* Equal fingerprints are one row before anything is replicated (a group of copies costs
  one row), so a third of all documents being copies shuffles nothing extra.
* A hot anchor is split: replicas are salted over ``salts`` parts and home rows go to all of
  them.  A part is streamed in batches; only its home fingerprints (8 bytes each) are held.
* A part gives links that join the same fingerprints as all its pairs would (a spanning
  forest), never the pairs themselves.

Edge cases: null and empty texts, and texts without words, have fingerprint zero and link
like any other; a null doc_id takes part and counts as larger than any other when a
component is named (a component of null ids has a null name); repeated rows stay rows;
an empty table gives an empty result; other columns are kept by ``near_dedup`` and ignored
by ``components``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import batch_texts, parts, texts_to_python
from quarry.llm.graph import connected_components
from quarry.session import scratch_path

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SALTS = 4
#: shingles whose bits are counted together
STEP = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, blanks are \\x20 and \\x09-\\x0d
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, STEP):
        part = words[at : min(at + STEP, n) + shingle - 1]
        rows = zip(*(part[i : len(part) - shingle + 1 + i] for i in range(shingle)), strict=True) if len(words) >= shingle else [words]
        h = np.array([digest(join(r), SEED) for r in rows], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)``; ``fp`` holds the 64 bits as a signed long."""
    kept_type = docs.schema[doc_id].dataType.simpleString()

    def hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            fp = np.array([fingerprint(t, shingle) for t in batch_texts(b)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    own = texts_to_python(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(hash_texts, f"doc_id {kept_type}, fp long")


# ---- anchors ---------------------------------------------------------------------------

_POSITIONS = np.arange(1, 32, dtype=np.uint64)  # bit i of a half stands at position i + 1


def _syndrome(half: np.ndarray) -> np.ndarray:
    """Position of the bit to flip to reach the Hamming codeword; 0 at a codeword."""
    out = np.zeros(half.shape, np.uint64)
    for p in _POSITIONS:
        out ^= np.where(half >> (p - np.uint64(1)) & np.uint64(1), p, np.uint64(0))
    return out


def _flip(half: np.ndarray, position: np.ndarray) -> np.ndarray:
    return half ^ np.where(position > 0, np.uint64(1) << (np.maximum(position, 1) - np.uint64(1)), np.uint64(0))


def anchors_of(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Home anchor of each 31-bit half, and all anchors within 2 bits (home first).

    From a point whose syndrome is s, flipping positions p and q reaches a codeword if
    p xor q = s; each of the 15 such pairs is one anchor.  A codeword has no other anchor
    within 2 bits: its replicas beyond the first repeat the home anchor.
    """
    s = _syndrome(half)
    home = _flip(half, s)
    near = [home]
    for p in _POSITIONS:
        q = s ^ p
        near.append(np.where((s > 0) & (q > p), _flip(_flip(half, np.full_like(s, p)), q), home))
    return home, np.stack(near, axis=1)


def _halves(fp: np.ndarray) -> list[np.ndarray]:
    low = np.uint64((1 << 31) - 1)
    return [fp & low, fp >> np.uint64(32) & low]


def _at_anchors(salts: int):
    """Rows (anchor, salt, replica, fp): home rows for every salt, replicas for one."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for cut in range(0, b.num_rows, 10_000):
                fp = b.column("fp").slice(cut, 10_000).to_numpy().view(np.uint64)
                part = (fp * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(salts)
                for side, half in enumerate(_halves(fp)):
                    home, near = anchors_of(half)
                    row, col = np.nonzero((np.arange(near.shape[1]) == 0) | (near != home[:, None]))
                    anchor = np.concatenate([np.tile(home, salts), near[row, col]])
                    salt = np.concatenate([np.repeat(np.arange(salts), len(fp)), part[row].astype(np.int64)])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array((anchor * np.uint64(2) + np.uint64(side)).view(np.int64)),
                            pa.array(salt.astype(np.int32)),
                            pa.array(np.repeat(np.array([0, 1], np.int8), [len(fp) * salts, len(row)])),
                            pa.array(np.concatenate([np.tile(fp, salts), fp[row]]).view(np.int64)),
                        ],
                        ["anchor", "salt", "replica", "fp"],
                    )

    return spread


class _Part:
    """The home fingerprints of one part of an anchor, and what links have joined so far."""

    def __init__(self, key: tuple[int, int], max_bits: int):
        self.key, self.max_bits = key, max_bits
        self.homes, self.joined = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, fp: np.ndarray, replica: np.ndarray) -> list[tuple[int, int]]:
        homes, others = fp[replica == 0], fp[replica == 1]
        if len(homes):
            self.homes = np.concatenate([self.homes, homes])
            self.joined = np.arange(len(self.homes))  # no replica came before the last home row
        if not len(self.homes):
            return []
        out: list[tuple[int, int]] = []
        step = max(1, (1 << 20) // len(self.homes))
        for at in range(0, len(others), step):
            block = others[at : at + step]
            differ = block[:, None] ^ self.homes[None, :]
            linked = (np.bitwise_count(differ) <= self.max_bits) & (differ != 0)
            for i in np.nonzero(linked.any(axis=1))[0]:
                near = np.nonzero(linked[i])[0]
                groups, first = np.unique(self.joined[near], return_index=True)
                out += [(int(block[i]), int(self.homes[near[k]])) for k in first]
                if len(groups) > 1:
                    self.joined[np.isin(self.joined, groups)] = groups[0]
        return out


def _compare(max_bits: int):
    """Links within each (anchor, salt) of a sorted partition, read as a stream."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: _Part | None = None
        for b in batches:
            if not b.num_rows:
                continue
            anchor, salt, replica = (b.column(c).to_numpy() for c in ("anchor", "salt", "replica"))
            fp = b.column("fp").to_numpy().view(np.uint64)
            starts = np.nonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])]))[0]
            ends = np.append(starts[1:], len(fp))
            # a part inside the batch matters only with a home row and two fingerprints
            live = (replica[starts] == 0) & (np.minimum.reduceat(fp, starts) != np.maximum.reduceat(fp, starts))
            live[0] = live[-1] = True
            links: list[tuple[int, int]] = []
            for k in np.nonzero(live)[0]:
                at, end = starts[k], ends[k]
                key = (int(anchor[at]), int(salt[at]))
                if part is None or part.key != key:
                    part = _Part(key, max_bits)
                links += part.add(fp[at:end], replica[at:end])
            if links:
                pairs = np.array(links, np.uint64).view(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return compare


def links(distinct_fp: DataFrame, max_bits: int = MAX_BITS, salts: int = SALTS) -> DataFrame:
    """``(a, b)`` fingerprints at ``max_bits`` or fewer differing bits: enough of the links
    to join whatever all of them join.  ``distinct_fp`` has one row per fingerprint."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with a threshold of one bit each cover at most 3 bits")
    return (
        distinct_fp.select("fp")
        .mapInArrow(_at_anchors(salts), "anchor long, salt int, replica byte, fp long")
        .repartition("anchor", "salt")
        .sortWithinPartitions("anchor", "salt", "replica")
        .mapInArrow(_compare(max_bits), "a long, b long")
        .distinct()
    )


def _grouped(rows: DataFrame, max_bits: int, salts: int) -> DataFrame:
    """``rows`` (doc_id, fp, _row, ...) with the first (doc_id, _row) of their component."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "_row")).alias("first")
    distinct_fp = rows.groupBy("fp").agg(first)
    roots = connected_components(links(distinct_fp, max_bits, salts)).withColumnRenamed("node", "fp")
    named = distinct_fp.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = named.groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(named.select("fp", "root").join(firsts, "root").select("fp", "first"), "fp")


def components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    salts: int = SALTS,
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``."""
    path = scratch_path(docs.sparkSession, "simhash")
    fingerprints(docs, doc_id, text, shingle).withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    return _grouped(rows, max_bits, salts).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


def near_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    salts: int = SALTS,
) -> DataFrame:
    """The rows of ``docs``, all columns, that come first (smallest id) in their component."""
    spark, columns = docs.sparkSession, docs.columns
    inner = [f"c{i}" for i in range(len(columns))]  # columns may have any names
    own = texts_to_python(docs).toDF(*inner)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields)
    id_at, text_at = inner[columns.index(doc_id)], inner[columns.index(text)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            fp = np.array([fingerprint(t, shingle) for t in batch_texts(b, text_at)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp, pa.int64())], [*b.schema.names, "fp"])

    path = scratch_path(spark, "simhash")
    own.mapInArrow(add, f"{schema}, fp long").withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("doc_id", F.col(id_at))
    kept = _grouped(rows.select("doc_id", "fp", "_row"), max_bits, salts).where(F.col("_row") == F.col("first._row"))
    return rows.join(kept.select("_row"), "_row", "left_semi").select(*inner).toDF(*columns)
