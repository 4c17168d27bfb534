"""Online variational LDA whose vocabulary and topics are tables.

The model of Spark ML's ``LDA`` with the online optimizer (Hoffman et al.): the same steps, rates
and update of the document concentration, for which Spark holds the vocabulary and the topic
matrix on the driver.  Here

1. ``blocks`` cuts the rows of documents, where they are read, into blocks of bounded size; a block
   holds its distinct terms and, for each document, the numbers of its terms and their counts;
2. ``dealt`` deals the terms to buckets by hash; a bucket knows at which places of which blocks its
   terms stand and has ``k`` weights for each, from draws by hashes of the term;
3. an iteration sends weights from buckets to blocks, infers the documents of each block in one task,
   and sends sums back, an array of bytes for each block and bucket instead of a row for each term.
   Buckets add them up and write the next weights; the weights and shuffle files before are deleted.

The driver holds numbers by topic alone.  An iteration sees every document once (Spark draws them
with replacement).  The result does not depend on the layout of the data but for rounding.  Rows
that share their id are documents of their own; documents without terms have no topic.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.features import token_slices
from quarry.session import FREE, Latest, stored

#: Spark ML's defaults
OFFSET, DECAY, GAMMA_SHAPE, TOLERANCE = 1024.0, 0.51, 100, 1e-3
#: tokens and documents of a block
BLOCK_TOKENS = 2_000_000
#: documents of an Arrow batch, while they have all their tokens
BATCH_ROWS = 1000
#: terms of documents that are inferred together
CACHED = 1 << 16
#: terms of blocks that one bucket has
BUCKET_PAIRS = 200_000
#: blocks or buckets of a file; Spark's reader holds that many at once
ROWS_A_FILE = 4


def digamma(x: np.ndarray) -> np.ndarray:
    """For positive numbers: six steps up, taken two by two, then the asymptotic series."""
    y = x + 6.0
    r = 1 / (y * y)
    series = r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132))))
    a = x * (x + 5.0)
    return np.log(y) - 0.5 / y - series - (2 * x + 5.0) * (1 / a + 1 / (a + 4.0) + 1 / (a + 6.0))


def trigamma(x: np.ndarray) -> np.ndarray:
    y = x + 10.0
    r = 1 / (y * y)
    series = r / y * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r / 30)))
    return 1 / y + r / 2 + series + sum(1 / (x + i) ** 2 for i in range(10))


def _expectation(x: np.ndarray) -> np.ndarray:
    """Of the logarithms under Dirichlet distributions, one in each row."""
    return digamma(x) - digamma(x.sum(axis=-1, keepdims=True))


# ---- documents -------------------------------------------------------------------------


def blocks(docs: DataFrame, id_col: str, tokens: str) -> DataFrame:
    """(block, ids, terms, starts, at, n): documents in blocks, written once.  ``terms`` are the
    distinct terms of the block; the document ``i`` has the terms ``at`` and their counts ``n`` from
    ``starts[i]`` up to ``starts[i + 1]``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for b in batches:
            for part in token_slices(b, "t", max(1, BLOCK_TOKENS // 16)):
                own = part.num_rows + pc.sum(part.column("t").value_lengths(), min_count=0).as_py()
                if kept and size + own > BLOCK_TOKENS:
                    yield _block(pa.concat_batches(kept))
                    kept, size = [], 0
                kept, size = [*kept, part], size + own
        if kept:
            yield _block(pa.concat_batches(kept))

    rows = docs.select(F.monotonically_increasing_id().alias("block"), F.col(id_col).alias("id"), F.col(tokens).alias("t"))
    shape = f"block long, ids array<{kind}>, terms array<string>, starts array<int>, at array<int>, n array<int>"
    batches = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}
    return stored(rows.mapInArrow(cut, shape), "lda-blocks", rows_a_file=ROWS_A_FILE, during=batches)


def _block(b: pa.RecordBatch) -> pa.RecordBatch:
    lists = b.column("t")
    of = np.repeat(np.arange(b.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    if flat.null_count:
        of, flat = of[flat.is_valid().to_numpy(zero_copy_only=False)], flat.drop_null()
    coded = flat.dictionary_encode()
    width = max(1, len(coded.dictionary))
    keys, n = np.unique(of * width + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    starts = np.searchsorted(keys // width, np.arange(b.num_rows + 1))
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [
            b.column("block").slice(0, 1),
            pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column("id")),
            pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary),
            one(starts.astype(np.int32), pa.int32()),
            one((keys % width).astype(np.int32), pa.int32()),
            one(n.astype(np.int32), pa.int32()),
        ],
        ["block", "ids", "terms", "starts", "at", "n"],
    )


def inferred(beta: np.ndarray, alpha: np.ndarray, starts: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The variational parameters of documents, a row each; ``beta`` has a row for each term.

    A document is done once its parameters move by ``TOLERANCE`` or less on average; once a fifth of
    a group is done, the others go on alone.  Spark starts from draws around 1, this from 1.  Documents
    go in groups of about ``CACHED`` terms and of like size, as matrices padded to the longest.
    """
    out, sizes = np.ones((len(starts) - 1, beta.shape[1])), np.diff(starts)
    order = np.argsort(sizes, kind="stable")
    order, first = order[sizes[order] > 0], 0
    beta = np.vstack([beta, np.zeros(beta.shape[1])])  # the last is the padding's
    while first < len(order):
        ahead = sizes[order[first : first + CACHED]]
        last = first + max(1, int(np.searchsorted(ahead * np.arange(1, len(ahead) + 1), CACHED, "right")))
        live, first = order[first:last], last
        across = np.arange(sizes[live[-1]])
        filled = across < sizes[live][:, None]
        place = np.where(filled, starts[live][:, None] + across, 0)
        b = np.ascontiguousarray(beta[np.where(filled, at[place], -1)].transpose(0, 2, 1))
        count, gamma, going = np.where(filled, n[place], 0).astype(float), out[live], np.ones(len(live), bool)
        while len(live):
            logs = digamma(np.append(gamma, gamma.sum(axis=1, keepdims=True), axis=1))
            theta = np.exp(logs[:, :-1] - logs[:, -1:])
            share = np.matmul(theta[:, None], b)[:, 0]
            share += 1e-100
            np.divide(count, share, out=share)
            new = theta * np.matmul(b, share[:, :, None])[:, :, 0] + alpha
            done, gamma = going & ~(np.abs(new - gamma).mean(axis=1) > TOLERANCE), new
            out[live[done]] = new[done]
            going &= ~done
            if going.sum() <= 0.8 * len(going):
                live, gamma, b, count, going = live[going], gamma[going], b[going], count[going], going[going]
    return out


# ---- arrays as bytes -------------------------------------------------------------------


def bytes_of(values: np.ndarray, cuts: np.ndarray | None = None) -> pa.Array:
    """A row of bytes for each part of the array between ``cuts``, or one.  Spark moves bytes whole,
    but an array number by number."""
    values = np.ascontiguousarray(values)
    wide = values.nbytes // max(1, len(values))
    at = np.array([0, len(values)] if cuts is None else cuts, np.int64) * wide
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(values)])


def numbers(t: pa.Table, name: str, kind: type) -> np.ndarray:
    """What ``bytes_of`` made, row after row."""
    rows = t.column(name).drop_null().combine_chunks()
    if not len(rows):
        return np.empty(0, kind)
    ends = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset : rows.offset + len(rows) + 1]
    return np.frombuffer(rows.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind) if ends[-1] > ends[0] else np.empty(0, kind)


def packed(values: np.ndarray) -> pa.Array:
    """One row: whole numbers without a sign, as narrow as they are, compressed."""
    values = values.astype(np.min_scalar_type(values.max(initial=0)))
    parts = [np.array([values.itemsize, len(values)], np.int64).tobytes(), pa.compress(values.tobytes(), "zstd", asbytes=True)]
    return pa.array([b"".join(parts)])


def unpacked(t: pa.Table, name: str) -> np.ndarray:
    row = t.column(name)[0].as_py()
    wide, size = np.frombuffer(row, np.int64, 2)
    return np.frombuffer(pa.decompress(row[16:], int(wide * size), "zstd", asbytes=True), f"u{wide}") if size else np.empty(0, np.uint8)


def _flat(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _lists(x: np.ndarray) -> pa.Array:
    """The rows of a matrix."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


# ---- blocks and buckets ----------------------------------------------------------------


@dataclass(frozen=True)
class Dealt:
    """``blocks`` (block, ids, width, keys, n, buckets, cuts): terms numbered in the order of their
    buckets; ``keys`` are the steps between ``document * width + term``, in rising order, and the
    terms of ``buckets[i]`` stand from ``cuts[i]`` to ``cuts[i + 1]``.  ``buckets`` (bucket, terms,
    blocks, cuts, at): the term at each of the places in ``blocks``."""

    held: DataFrame
    blocks: DataFrame
    buckets: DataFrame


def dealt(held: DataFrame) -> Dealt:
    pairs = held.agg(F.sum(F.size("terms"))).first()[0] or 0
    count = max(1, -(-pairs // BUCKET_PAIRS))
    rows = held.withColumn("to", F.transform("terms", lambda t: F.pmod(F.xxhash64(t), F.lit(count)).cast("int")))
    ids = held.schema["ids"].dataType

    def number(t: pa.Table) -> pa.Table:
        to = _flat(t, "to")
        order, width = np.argsort(to, kind="stable"), max(1, len(to))
        place = np.empty(width, np.int64)
        place[order] = np.arange(len(to))
        found, first = np.unique(to[order], return_index=True)
        starts, n = _flat(t, "starts"), _flat(t, "n")
        keys = np.repeat(np.arange(len(starts) - 1), np.diff(starts)) * width + place[_flat(t, "at")]
        rising = np.argsort(keys, kind="stable")
        arrays = [packed(np.diff(keys[rising], prepend=0)), packed(n[rising]), bytes_of(found.astype(np.int32)), bytes_of(np.append(first, len(to)).astype(np.int32))]
        columns = [t.column("block").combine_chunks(), t.column("ids").combine_chunks(), pa.array([len(to)], pa.int32()), *arrays]
        return pa.table(columns, ["block", "ids", "width", "keys", "n", "buckets", "cuts"])

    shape = f"block long, ids {ids.simpleString()}, width int, keys binary, n binary, buckets binary, cuts binary"
    blocks = rows.select("block", "ids", "starts", "at", "n", "to").groupBy("block").applyInArrow(number, shape)
    blocks = stored(blocks, "lda-numbered", rows_a_file=ROWS_A_FILE, during=FREE)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                to = b.column("to")[i].values.to_numpy(zero_copy_only=False)
                order = np.argsort(to, kind="stable")
                found, first = np.unique(to[order], return_index=True)
                cuts = pa.array(np.append(first, len(to)), pa.int32())
                terms = pa.ListArray.from_arrays(cuts, b.column("terms")[i].values.take(pa.array(order)))
                of = pa.array(np.full(len(found), b.column("block")[i].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([of, pa.array(found, pa.int32()), terms], ["block", "bucket", "terms"])

    def gather(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        lists = t.column("terms").combine_chunks()
        coded = lists.flatten().dictionary_encode()
        cuts = np.append(0, np.cumsum(lists.value_lengths().to_numpy())).astype(np.int32)
        terms = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        arrays = [t.column("block").to_numpy(), cuts, coded.indices.to_numpy().astype(np.int32)]
        return pa.table([t.column("bucket").combine_chunks().slice(0, 1), terms, *map(bytes_of, arrays)], ["bucket", "terms", "blocks", "cuts", "at"])

    cells = rows.select("block", "terms", "to").mapInArrow(deal, "block long, bucket int, terms array<string>")
    buckets = cells.groupBy("bucket").applyInArrow(gather, "bucket int, terms array<string>, blocks binary, cuts binary, at binary")
    return Dealt(held, blocks, stored(buckets, "lda-buckets", rows_a_file=ROWS_A_FILE, during=FREE))


def _sent(found: Dealt, weights: DataFrame, totals: np.ndarray) -> DataFrame:
    """(of, bucket, x): for a block's terms in a bucket, the exponentials of their expected logarithms."""
    k = len(totals)

    def send(bucket: pa.Table, weights: pa.Table) -> pa.Table:
        x = numbers(weights, "x", np.float64).reshape(-1, k)
        beta = np.exp(digamma(x) - digamma(totals))[numbers(bucket, "at", np.int32)]
        of = numbers(bucket, "blocks", np.int64)
        own = pa.array(np.full(len(of), bucket.column("bucket")[0].as_py(), np.int32))
        return pa.table([pa.array(of), own, bytes_of(beta, numbers(bucket, "cuts", np.int32))], ["of", "bucket", "x"])

    cells = found.buckets.select("bucket", "blocks", "cuts", "at").groupBy("bucket").cogroup(weights.where("bucket >= 0").select("bucket", "x").groupBy("bucket"))
    return cells.applyInArrow(send, "of long, bucket int, x binary")


def _documents(block: pa.Table, sent: pa.Table, k: int) -> tuple[np.ndarray, ...]:
    """Topic weights of the block's terms, and its documents' ``starts``, ``at`` and ``n``."""
    width, docs = max(1, block.column("width")[0].as_py()), len(block.column("ids")[0])
    of, at = np.divmod(np.cumsum(unpacked(block, "keys"), dtype=np.int64), width)
    starts = np.searchsorted(of, np.arange(docs + 1))
    return numbers(sent.sort_by("bucket"), "x", np.float64).reshape(-1, k), starts, at, unpacked(block, "n")


def _met(held: DataFrame, topics: DataFrame):
    """Blocks beside the topic weights of their terms, grouped by block."""
    terms = held.select(F.col("block").alias("of"), F.posexplode("terms").alias("pos", "term"))
    vectors = terms.join(topics, "term").select("of", "pos", "x")
    return held.groupBy("block").cogroup(vectors.groupBy("of"))


def _shares_of(gamma: np.ndarray, ids: pa.Array, size: np.ndarray) -> pa.Table:
    gamma = gamma / gamma.sum(axis=1, keepdims=True) * (size > 0)[:, None]
    return pa.table({"id": ids, "shares": _lists(gamma)})


# ---- the model -------------------------------------------------------------------------


@dataclass(frozen=True)
class Topics:
    """``table`` (term, x): the topics' weights, which add up to ``totals``.  A fit also keeps the
    blocks it saw and its weights by bucket."""

    table: DataFrame
    totals: tuple[float, ...]
    alpha: tuple[float, ...]
    seen: Dealt | None = None
    weights: DataFrame | None = None

    def described(self, most: int) -> list[tuple[int, int, str, float]]:
        """(topic, rank, term, weight) of the ``most`` heaviest terms of each topic, ties by term."""
        out, table = [], self.table if self.seen is None else stored(self._heaviest(most), "lda-heaviest", during=FREE)
        for i, total in enumerate(self.totals):
            weight = (F.get("x", i) / F.lit(total)).alias("weight")
            rows = table.select("term", weight).orderBy(F.desc("weight"), "term").limit(most).collect()
            out += [(i, rank, r.term, r.weight) for rank, r in enumerate(rows)]
        return out

    def _heaviest(self, most: int) -> DataFrame:
        """(term, x) of the terms that are among the ``most`` heaviest of their bucket in a topic, or as
        heavy as the last of these."""
        totals = np.array(self.totals)

        def pick(terms: pa.Array, x: np.ndarray) -> np.ndarray:
            share = x / totals
            last = -np.partition(-share, most - 1, axis=0)[most - 1] if len(x) > most else np.full(len(totals), -np.inf)
            return (share >= last).any(axis=1)

        return _terms(self.seen, self.weights, len(totals), pick)

    def shares(self, held: DataFrame) -> DataFrame:
        """(id, shares): the topic distribution of every document of the blocks ``held``; zeros for
        one without terms."""
        totals, alpha, k = np.array(self.totals), np.array(self.alpha), len(self.alpha)
        kind = held.schema["ids"].dataType.elementType.simpleString()
        shape = f"id {kind}, shares array<double>"

        def infer_seen(block: pa.Table, sent: pa.Table) -> pa.Table:
            beta, starts, at, n = _documents(block, sent, k)
            return _shares_of(inferred(beta, alpha, starts, at, n), block.column("ids").combine_chunks().flatten(), np.diff(starts))

        if self.seen is not None and held is self.seen.held:
            sent = _sent(self.seen, self.weights, totals)
            return self.seen.blocks.groupBy("block").cogroup(sent.groupBy("of")).applyInArrow(infer_seen, shape)

        def infer(block: pa.Table, vectors: pa.Table) -> pa.Table:
            ids = block.column("ids").combine_chunks().flatten()
            starts, at, n = (_flat(block, c) for c in ("starts", "at", "n"))
            if not vectors.num_rows:
                return _shares_of(np.ones((len(ids), k)), ids, np.zeros(len(ids)))
            x = _flat(vectors, "x").reshape(vectors.num_rows, -1)
            placed = np.empty_like(x)
            placed[vectors.column("pos").to_numpy()] = x
            return _shares_of(inferred(np.exp(digamma(placed) - digamma(totals)), alpha, starts, at, n), ids, np.diff(starts))

        return _met(held, self.table).applyInArrow(infer, shape)


def _terms(found: Dealt, weights: DataFrame, k: int, pick=None) -> DataFrame:
    """(term, x) of the terms of all buckets, or of those that ``pick`` marks."""

    def spread(bucket: pa.Table, weights: pa.Table) -> pa.Table:
        terms, x = bucket.column("terms").combine_chunks().flatten(), numbers(weights, "x", np.float64).reshape(-1, k)
        if pick is not None:
            kept = pick(terms, x)
            terms, x = terms.filter(pa.array(kept)), x[kept]
        return pa.table({"term": terms, "x": _lists(x)})

    cells = found.buckets.select("bucket", "terms").groupBy("bucket").cogroup(weights.where("bucket >= 0").select("bucket", "x").groupBy("bucket"))
    return cells.applyInArrow(spread, "term string, x array<double>")


def _draws(h: np.ndarray, k: int) -> np.ndarray:
    """From the gamma distribution of shape 100 and mean 1 by hashes, ``k`` for each."""
    x = np.zeros((k, len(h)))
    for j in range(k * GAMMA_SHAPE):  # a sum of as many exponential draws
        v = h + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x[j % k] -= np.log((((v ^ (v >> np.uint64(31))) >> np.uint64(11)) + 0.5) / 2.0**53)
    return x.T / GAMMA_SHAPE


def _drawn(held: DataFrame, k: int, seed: int) -> DataFrame:
    """(term, x): the first topics."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("term"), _lists(_draws(b.column("h").to_numpy().view(np.uint64), k))], ["term", "x"])

    terms = held.select(F.explode("terms").alias("term")).distinct()
    return terms.select("term", F.xxhash64("term", F.lit(seed)).alias("h")).mapInArrow(draw, "term string, x array<double>")


#: ``t``: the sums of a bucket's weights; bucket -1 has the documents' expected logarithms and their number
_WEIGHTS = "bucket int, x binary, t array<double>"


def _first_weights(found: Dealt, k: int, seed: int) -> DataFrame:
    """``_drawn`` by bucket."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x = _draws(b.column("h")[i].values.to_numpy(zero_copy_only=False).view(np.uint64), k)
                yield pa.RecordBatch.from_arrays([b.column("bucket").slice(i, 1), bytes_of(x.ravel()), pa.array([x.sum(axis=0)])], ["bucket", "x", "t"])

    hashes = F.transform("terms", lambda t: F.xxhash64(t, F.lit(seed)))
    return found.buckets.select("bucket", hashes.alias("h")).mapInArrow(draw, _WEIGHTS)


def _sums(weights: DataFrame, k: int) -> tuple[np.ndarray, tuple[float, ...] | None]:
    """The totals of the topics, and what bucket -1 has."""
    rows = weights.groupBy((F.col("bucket") < 0).alias("last")).agg(*[F.sum(F.get("t", i)) for i in range(k + 1)]).collect()
    by = {r["last"]: tuple(r)[1:] for r in rows}
    return np.array(by.get(False, [0.0] * (k + 1))[:k]), by.get(True)


def _next_alpha(alpha: np.ndarray, logs: np.ndarray, n: int, rate: float) -> np.ndarray:
    """A Newton step on the document concentration; unchanged where it would not stay positive."""
    slope = n * (logs / n - _expectation(alpha))
    c, q = n * trigamma(alpha.sum()), -n * trigamma(alpha)
    b = (slope / q).sum() / (1 / c + (1 / q).sum())
    moved = alpha - rate * (slope - b) / q
    return moved if (moved > 0).all() else alpha


def _statistics(found: Dealt, weights: DataFrame, totals: np.ndarray, alpha: np.ndarray) -> DataFrame:
    """(of, bucket, s): the weights of a block's terms in its documents; bucket -1 has the sums of the
    documents' expected logarithms and their number."""
    k = len(alpha)

    def infer(block: pa.Table, sent: pa.Table) -> pa.Table:
        beta, starts, at, n = _documents(block, sent, k)
        gamma, size = inferred(beta, alpha, starts, at, n), np.diff(starts)
        logs = _expectation(gamma)
        theta = np.exp(logs)
        share = np.full(len(at), 1e-100)
        for i in range(k):
            share += beta[at, i] * np.repeat(theta[:, i], size)
        np.divide(n, share, out=share)
        sums = [np.bincount(at, np.repeat(theta[:, i], size) * share, len(beta)) for i in range(k)]
        s = np.append((np.stack(sums, axis=1) * beta).ravel(), [*logs[size > 0].sum(axis=0), (size > 0).sum()])
        cuts = numbers(block, "cuts", np.int32) * k
        buckets = np.append(numbers(block, "buckets", np.int32), -1).astype(np.int32)
        of = np.full(len(buckets), block.column("block")[0].as_py(), np.int64)
        return pa.table([pa.array(of), pa.array(buckets), bytes_of(s, np.append(cuts, len(s)))], ["of", "bucket", "s"])

    blocks = found.blocks.where("width > 0").groupBy("block")
    return blocks.cogroup(_sent(found, weights, totals).groupBy("of")).applyInArrow(infer, "of long, bucket int, s binary")


def _next_weights(found: Dealt, weights: DataFrame, sums: DataFrame, k: int, rate: float, concentration: float) -> DataFrame:
    def add(bucket: pa.Table, given: pa.Table) -> pa.Table:
        given = given.sort_by([("of", "ascending")])  # the weights so far have none
        own, s = given.column("bucket").combine_chunks().slice(0, 1), numbers(given, "s", np.float64)
        if not bucket.num_rows:
            return pa.table([own, bytes_of(np.empty(0)), pa.array([s.reshape(-1, k + 1).sum(axis=0)])], ["bucket", "x", "t"])
        x, at, s = numbers(given, "x", np.float64).reshape(-1, k), numbers(bucket, "at", np.int32), s.reshape(-1, k)
        added = np.stack([np.bincount(at, s[:, i], len(x)) for i in range(k)], axis=1)
        x = (1 - rate) * x + rate * (added + concentration)
        return pa.table([own, bytes_of(x.ravel()), pa.array([x.sum(axis=0)])], ["bucket", "x", "t"])

    given = sums.unionByName(weights.where("bucket >= 0").select("bucket", "x"), allowMissingColumns=True)
    cells = found.buckets.select("bucket", "at").groupBy("bucket").cogroup(given.groupBy("bucket"))
    return cells.applyInArrow(add, _WEIGHTS)


def fit(held: DataFrame, iterations: int, doc_concentration: Sequence[float], topic_concentration: float, seed: int = 1) -> Topics:
    """Topics of the documents in the blocks ``held``."""
    alpha, k = np.array(doc_concentration, float), len(doc_concentration)
    found, latest = dealt(held), Latest(held.sparkSession, "lda-weights")
    weights = latest.put(_first_weights(found, k, seed))
    totals, _ = _sums(weights, k)
    for i in range(1, iterations + 1):
        rate = (OFFSET + i) ** -DECAY
        weights = latest.put(_next_weights(found, weights, _statistics(found, weights, totals, alpha), k, rate, topic_concentration))
        totals, seen = _sums(weights, k)
        if seen is None:  # no document has a term
            break
        alpha = _next_alpha(alpha, np.array(seen[:k]), seen[k], rate)
    return Topics(_terms(found, weights, k), tuple(map(float, totals)), tuple(map(float, alpha)), found, weights)
