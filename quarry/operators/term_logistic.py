"""Logistic regression on term counts whose vocabulary, weights and gradients are tables.

The model of Spark ML's ``LogisticRegression`` without penalty on the vectors of a
``CountVectorizer`` with the whole vocabulary: features less their means, divided by their sample
deviations, from weights 0 and the log odds of the labels, by L-BFGS with ten corrections and a
strong Wolfe line search, to the same tolerance.  Spark sends a gradient as wide as the vocabulary
to the driver in each step.  Here

1. ``lda.blocks`` holds the documents; the terms, with means and variances, are dealt to buckets;
2. every point of the descent is a sum of the gradients so far, and a gradient is the features times
   a residual for each document.  So a block keeps, for each gradient, its product with the block's
   documents (one number a document), and the driver the products of the gradients with each other;
   direction and line search need nothing else;
3. a step sends the residuals' sums from blocks to buckets, an array of bytes for each two, and totals
   back; the state and the shuffle files of the step before are deleted.

Labels are 0 and 1; rows with a null label are left out.  The result does not depend on the layout
of the data but for rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quarry.operators import lda
from quarry.session import FREE, Latest, stored

#: Spark ML's defaults
ITERATIONS, TOLERANCE, CORRECTIONS, REMEMBERED = 100, 1e-6, 10, 20
#: terms of blocks that one task adds up
BUCKET_PAIRS = 200_000
#: entries of documents, or terms of blocks, that one task of a step reads where all cores have work
TASK_ENTRIES = 4_000_000
#: of the line search: decrease, curvature, tries
DECREASE, CURVATURE, TRIES = 1e-4, 0.9, 10


class SearchFailed(ArithmeticError):
    """No step along a direction is good enough."""


# ---- descent ---------------------------------------------------------------------------


def direction(slope: np.ndarray, steps: Sequence[np.ndarray], changes: Sequence[np.ndarray], dot) -> np.ndarray:
    """Downhill by the two loops of L-BFGS; ``steps`` and ``changes`` of the slope, newest first."""
    if not steps:
        return -slope
    to, shares = slope.copy(), []
    curved = [dot(s, y) for s, y in zip(steps, changes)]
    scale = curved[0] / dot(changes[0], changes[0]) if curved[0] >= 0 else np.nan
    for s, y, c in zip(steps, changes, curved):
        shares.append(dot(s, to) / c)
        to = to - shares[-1] * y
    to = to * scale
    for s, y, c, share in list(zip(steps, changes, curved, shares))[::-1]:
        to = to + (share - dot(y, to) / c) * s
    if not np.isfinite(to).all():
        raise SearchFailed("corrections without curvature")
    return -to


def _between(left: tuple, right: tuple) -> float:
    """The minimum of the cubic through two (t, value, slope), away from both ends."""
    (t0, f0, d0), (t1, f1, d1) = sorted((left, right))
    a = d0 + d1 - 3 * (f0 - f1) / (t0 - t1)
    b = np.sqrt(np.float64(a * a - d0 * d1))
    t = t1 - (t1 - t0) * (d1 + b - a) / (d1 - d0 + 2 * b)
    low, high = t0 + 0.1 * (t1 - t0), t0 + 0.9 * (t1 - t0)
    return low if t < low else high if t > high else t


def line_search(at: Callable[[float], tuple[float, float]], value: float, slope: float, t: float) -> float:
    """A step that meets the strong Wolfe conditions; ``at`` gives value and slope of a step."""
    if slope > 0:
        raise SearchFailed("not downhill")

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(TRIES):
            t = _between(low, high)
            new = (t, *at(t))
            if new[1] > value + DECREASE * t * slope or new[1] >= low[1]:
                high = new
                continue
            if abs(new[2]) <= CURVATURE * abs(slope):
                return t
            if new[2] * (high[0] - low[0]) >= 0:
                high = low
            low = new
        raise SearchFailed("no step between two ends")

    low = (0.0, value, slope)
    for i in range(TRIES):
        new = (t, *at(t))
        if not np.isfinite(new[1]):
            t /= 2
            continue
        if new[1] > value + DECREASE * t * slope or (i and new[1] >= low[1]):
            return zoom(low, new)
        if abs(new[2]) <= CURVATURE * abs(slope):
            return t
        if new[2] >= 0:
            return zoom(new, low)
        low, t = new, 1.5 * t
    raise SearchFailed("no step")


# ---- documents, terms and products -----------------------------------------------------


#: what the columns of bytes hold; others are doubles
_KINDS = {"blocks": np.int64} | dict.fromkeys(("starts", "at", "n", "buckets", "cuts", "pos"), np.int32)


def _flat(t: pa.Table, name: str) -> np.ndarray:
    column = t.column(name)
    if pa.types.is_binary(column.type):
        return lda.numbers(t, name, _KINDS.get(name, np.float64))
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _row(columns: dict[str, np.ndarray | pa.Array], **single) -> pa.Table:
    """One row: numbers, bytes of NumPy arrays, and lists of others."""
    lists = {
        k: lda.bytes_of(v.astype(_KINDS.get(k, np.float64))) if isinstance(v, np.ndarray) else pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
        for k, v in columns.items()
    }
    return pa.table({**{k: pa.array([v]) for k, v in single.items()}, **lists})


def _added(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, values, size).astype(float)  # of nothing NumPy gives whole numbers


def _sized(at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The document of each entry."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def _summed(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return _added(_sized(values, starts), values, len(starts) - 1)


def _term_sums(t: pa.Table) -> pa.Table:
    """(block, bucket, term, pos, s, q) of a block: sums of its terms' counts and of their squares."""
    at, n, to = _flat(t, "at"), _flat(t, "n").astype(float), _flat(t, "to")
    order = np.argsort(to, kind="stable")
    found, first = np.unique(to[order], return_index=True)
    cuts = np.append(first, len(to))
    terms = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), t.column("terms").combine_chunks().flatten().take(pa.array(order)))
    of = np.full(len(found), t.column("block")[0].as_py(), np.int64)
    sums = {k: lda.bytes_of(_added(at, x, len(to))[order], cuts) for k, x in (("s", n), ("q", n * n))}
    return pa.table({"block": of, "bucket": pa.array(found, pa.int32()), "term": terms, "pos": lda.bytes_of(order.astype(np.int32), cuts), **sums})


#: the terms of a bucket, and which of them (``at``) stands at which place (``pos``) of each of ``blocks``
_BUCKET = "bucket int, around double, term array<string>, mean binary, inverse binary, blocks binary, cuts binary, pos binary, at binary"


def _buckets(blocks: DataFrame, count: int, n: int) -> DataFrame:
    """Terms dealt to ``count`` buckets by hash; ``inverse`` is one over the variance in ``n`` documents,
    0 without spread; ``around`` is the square of the means."""

    def deal(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        lists = t.column("term").combine_chunks()
        coded = lists.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        s, q = (_added(at, _flat(t, c), len(coded.dictionary)) for c in ("s", "q"))
        variance = (q - s * s / n) / max(n - 1, 1)
        inverse = np.divide(1.0, variance, out=np.zeros(len(s)), where=variance > 0)
        arrays = {"term": coded.dictionary, "mean": s / n, "inverse": inverse, "blocks": t.column("block").to_numpy()}
        arrays |= {"cuts": np.append(0, np.cumsum(lists.value_lengths().to_numpy())), "pos": _flat(t, "pos"), "at": at}
        return _row(arrays, bucket=t.column("bucket")[0].as_py(), around=float((s / n) ** 2 @ inverse)).cast(shape)

    shape = pa.schema(
        [pa.field("bucket", pa.int32()), pa.field("around", pa.float64()), pa.field("term", pa.list_(pa.string()))]
        + [pa.field(c, pa.binary()) for c in ("mean", "inverse", "blocks", "cuts", "pos", "at")]
    )
    to = F.transform("terms", lambda t: F.pmod(F.xxhash64(t), F.lit(count)).cast("int"))
    rows = blocks.select("block", "terms", "at", "n", to.alias("to")).groupBy("block")
    cells = rows.applyInArrow(_term_sums, "block long, bucket int, term array<string>, pos binary, s binary, q binary")
    return stored(cells.groupBy("bucket").applyInArrow(deal, _BUCKET), "term-buckets", lda.ROWS_A_FILE, FREE)


def _places(t: pa.Table) -> pa.Table:
    """(block, bucket, pos, mean, inverse): what a bucket knows of each block's terms."""
    cuts, at = _flat(t, "cuts"), _flat(t, "at")
    parts = {c: lda.bytes_of(_flat(t, c)[at], cuts) for c in ("mean", "inverse")}
    of = _flat(t, "blocks")
    bucket = np.full(len(of), t.column("bucket")[0].as_py(), np.int32)
    return pa.table({"block": of, "bucket": bucket, "pos": lda.bytes_of(_flat(t, "pos"), cuts), **parts})


def _numbered(block: pa.Table, places: pa.Table) -> pa.Table:
    """The block with its terms in the order of their buckets; ``c`` is a document's product with the
    means."""
    places = places.sort_by("bucket")
    pos, mean, inverse = (_flat(places, c) for c in ("pos", "mean", "inverse"))
    place = np.empty(len(pos), np.int32)
    place[pos] = np.arange(len(pos), dtype=np.int32)
    starts, at, n = _flat(block, "starts"), place[_flat(block, "at")], _flat(block, "n")
    cuts = np.append(0, np.cumsum(pc.binary_length(places.column("pos")).to_numpy() // 4))
    arrays = {"y": _flat(block, "ids"), "c": _summed(n * (mean * inverse)[at], starts), "starts": starts, "at": at, "n": n}
    arrays |= {"buckets": places.column("bucket").to_numpy(), "cuts": cuts.astype(np.int32)}
    return _row(arrays, block=block.column("block")[0].as_py())


_NUMBERED = "block long, y binary, c binary, starts binary, at binary, n binary, buckets binary, cuts binary"
#: ``m``: the products of the gradients with the documents, gradient by gradient; ``g``: with the last residual
_STATE = "block long, y binary, c binary, m binary, g array<double>"


def _margins(y: np.ndarray, m: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Of documents at a point: shares of the gradients and, last, the intercept."""
    found = m.reshape(-1, len(y)) if len(m) else np.zeros((0, len(y)))
    return point[: len(found)] @ found + point[-1]


def _residual(y: np.ndarray, m: np.ndarray, point: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_margins(y, m, point), -700, 700))) - y


def _parts(held: DataFrame, state: DataFrame, points: Sequence[tuple[float, np.ndarray]]) -> DataFrame:
    """(block, bucket, value): for a block's terms, counts times the documents' residuals at
    ``points``, added up with their shares."""

    def parts(block: pa.Table, known: pa.Table) -> pa.Table:
        y, m = _flat(known, "y"), _flat(known, "m")
        r = sum(share * _residual(y, m, p) for share, p in points)
        starts, at, n, buckets, cuts = (_flat(block, c) for c in ("starts", "at", "n", "buckets", "cuts"))
        value = _added(at, n * r[_sized(at, starts)], cuts[-1])
        of = np.full(len(buckets), block.column("block")[0].as_py())
        return pa.table({"block": of, "bucket": buckets, "value": lda.bytes_of(value, cuts)})

    rows = held.select("block", "starts", "at", "n", "buckets", "cuts")
    cells = rows.groupBy("block").cogroup(state.select("block", "y", "m").groupBy("block"))
    return cells.applyInArrow(parts, "block long, bucket int, value binary")


def _bucket_sums(bucket: pa.Table, parts: pa.Table) -> np.ndarray:
    """Of each term of the bucket, over all blocks."""
    return _added(_flat(bucket, "at"), _flat(parts.sort_by("block"), "value"), len(_flat(bucket, "inverse")))


def _with_gradient(
    held: DataFrame, buckets: DataFrame, state: DataFrame, point: np.ndarray, around: float, total: float, along: float
) -> DataFrame:
    """The state with the gradient at ``point`` added.  ``around`` is the square of the means,
    ``total`` the sum of the residuals, ``along`` their product with ``c``: the features are taken
    less their means."""

    def back(bucket: pa.Table, parts: pa.Table) -> pa.Table:
        u = (_bucket_sums(bucket, parts) * _flat(bucket, "inverse"))[_flat(bucket, "at")]
        of = _flat(bucket, "blocks")
        return pa.table({"block": of, "bucket": np.full(len(of), bucket.column("bucket")[0].as_py(), np.int32), "u": lda.bytes_of(u, _flat(bucket, "cuts"))})

    def added(block: pa.Table, given: pa.Table) -> pa.Table:
        given = given.sort_by("bucket")  # the state's row has none and is the last
        u, m = _flat(given, "u"), _flat(given, "m")
        starts, at, n, y, c = (_flat(block, x) for x in ("starts", "at", "n", "y", "c"))
        new = _summed(n * u[at], starts) - along - c * total + around * total
        r, m = _residual(y, m, point), np.concatenate([m, new])
        return _row({"y": y, "c": c, "m": m, "g": pa.array(m.reshape(-1, len(y)) @ r)}, block=block.column("block")[0].as_py())

    parts = _parts(held, state, [(1.0, point)])
    known = buckets.select("bucket", "inverse", "blocks", "cuts", "at").groupBy("bucket")
    sums = known.cogroup(parts.groupBy("bucket")).applyInArrow(back, "block long, bucket int, u binary")
    given = sums.unionByName(state.select("block", "m"), allowMissingColumns=True)
    rows = held.select("block", "starts", "at", "n", "y", "c").groupBy("block")
    return rows.cogroup(given.groupBy("block")).applyInArrow(added, _STATE)


def _totals(rows: DataFrame, width: int) -> np.ndarray:
    found = rows.agg(*[F.sum(F.get("g", i)) for i in range(width)]).first()
    return np.array([v or 0.0 for v in found])


def _measured(state: DataFrame, point: np.ndarray, toward: np.ndarray) -> np.ndarray:
    """Over all documents at ``point``: loss, its slope ``toward`` there, residuals, and these with ``c``."""

    def measure(batches):
        for b in batches:
            for i in range(b.num_rows):
                y, c, m = (np.frombuffer(b.column(x)[i].as_py()) for x in ("y", "c", "m"))
                margin, r = _margins(y, m, point), _residual(y, m, point)
                loss = np.logaddexp(0, np.where(y > 0, -margin, margin)).sum()
                sums = [loss, r @ _margins(y, m, toward), r.sum(), r @ c]
                yield pa.RecordBatch.from_arrays([pa.array([sums])], ["g"])

    return _totals(state.select("y", "c", "m").mapInArrow(measure, "g array<double>"), 4)


# ---- the model -------------------------------------------------------------------------


@dataclass(frozen=True)
class TermWeights:
    """``table`` (term, weight)."""

    table: DataFrame
    intercept: float
    #: the mean loss before the first step, then after each
    objective: tuple[float, ...]

    def scored(self, docs: DataFrame, tokens: str, keep: Sequence[str]) -> DataFrame:
        """The columns ``keep`` of every row, ``margin`` and ``prediction``; unknown terms count
        nothing."""
        held = lda.blocks(docs.select(F.struct(*keep).alias("row"), tokens), "row", tokens)
        terms = held.select(F.col("block").alias("of"), F.posexplode("terms").alias("pos", "term"))
        known = terms.join(self.table, "term").select("of", "pos", "weight")
        intercept = self.intercept

        def score(block: pa.Table, known: pa.Table) -> pa.Table:
            weight = np.zeros(len(block.column("terms")[0]))
            weight[known.column("pos").to_numpy()] = known.column("weight").to_numpy()
            starts, at, n = (_flat(block, c) for c in ("starts", "at", "n"))
            margin = _summed(n * weight[at], starts) + intercept
            rows = block.column("ids").combine_chunks().flatten()
            return pa.table({"row": rows, "margin": margin})

        shape = StructType([StructField("row", held.schema["ids"].dataType.elementType), StructField("margin", DoubleType())])
        rows = held.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(score, shape)
        likely = 1 / (1 + F.exp(-F.col("margin"))) > 0.5
        return rows.select("row.*", "margin", F.when(likely, 1.0).otherwise(0.0).alias("prediction"))


def fit(docs: DataFrame, tokens: str, label: str, iterations: int = ITERATIONS, tolerance: float = TOLERANCE) -> TermWeights:
    """Weights of the terms of ``docs``, whose column ``label`` has 0 and 1."""
    spark = docs.sparkSession
    kept = docs.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), tokens)
    blocks = lda.blocks(kept, "y", tokens)
    of = blocks.select(F.explode("ids").alias("y"))
    sizes = blocks.select(F.count(F.lit(1)).alias("parts"), F.sum(F.size("terms")).alias("pairs"), F.sum(F.size("at")).alias("entries")).first()
    n, ones, other = of.select(F.count(F.lit(1)), F.sum("y"), F.count_if(~F.col("y").isin(0.0, 1.0))).first()
    if not n or other:
        raise ValueError("no labelled rows" if not n else "labels must be 0 or 1")
    if ones in (0, n):
        return TermWeights(spark.createDataFrame([], "term string, weight double"), float("inf") if ones else float("-inf"), (0.0,))

    count = max(1, -(-sizes.pairs // BUCKET_PAIRS))
    buckets = _buckets(blocks, count, n)
    around = buckets.agg(F.sum("around")).first()[0] or 0.0
    places = buckets.drop("term").groupBy("bucket").applyInArrow(_places, "block long, bucket int, pos binary, mean binary, inverse binary")
    numbered = blocks.drop("terms").groupBy("block").cogroup(places.groupBy("block")).applyInArrow(_numbered, _NUMBERED)
    held = stored(numbered, "numbered", lda.ROWS_A_FILE, FREE)
    # dealt once, not in each step, whose tasks cost more than what few blocks take
    least = 2 * spark.sparkContext.defaultParallelism
    held = held.repartition(min(sizes.parts, max(least, -(-sizes.entries // TASK_ENTRIES))), "block").persist()
    buckets = buckets.drop("pos").repartition(min(count, max(least, -(-sizes.pairs // TASK_ENTRIES))), "bucket").persist()
    try:
        return _descended(held, buckets, n, np.log(ones / (n - ones)), around, iterations, tolerance)
    finally:
        held.unpersist()
        buckets.unpersist()


def _descended(held: DataFrame, buckets: DataFrame, n: int, intercept: float, around: float, iterations: int, tolerance: float) -> TermWeights:
    width = iterations + 2
    products = np.zeros((width, width))  # of the gradients' parts for the terms, and of the intercepts
    products[-1, -1] = 1.0
    dot = lambda a, b: float(a @ products @ b)
    point = np.zeros(width)
    point[-1] = intercept
    latest = Latest(held.sparkSession, "gradients")
    state = latest.put(held.select("block", "y", "c", F.lit(b"").alias("m"), F.array().cast("array<double>").alias("g")))
    seen, points, totals = _measured(state, point, np.zeros(width)) / n, [], []

    def gradient() -> np.ndarray:
        """At ``point``, where ``seen`` was measured."""
        nonlocal state
        state = latest.put(_with_gradient(held, buckets, state, point, around, seen[2] * n, seen[3] * n))
        k = len(points)
        # a gradient in the state is the sum over documents; here it is their mean
        products[k, : k + 1] = products[: k + 1, k] = _totals(state.select("g"), k + 1) / n**2
        points.append(point)
        totals.append(seen[2])
        out = np.zeros(width)
        out[k], out[-1] = 1.0, seen[2]
        return out

    def shares(vector: np.ndarray) -> np.ndarray:
        """In the sums over documents that the state holds."""
        return np.append(vector[:-1] / n, vector[-1])

    slope = gradient()
    at, objective, lately = point.copy(), [seen[0]], [np.inf]
    steps, changes, failed, step = [], [], False, 0
    while step < iterations and np.sqrt(max(dot(slope, slope), 0.0)) > max(tolerance * abs(seen[0]), 1e-8):
        if len(lately) > 1 and abs(seen[0] - max(lately)) <= tolerance * abs(objective[0]):
            break
        tried: dict[float, np.ndarray] = {}
        try:
            to = direction(slope, steps, changes, dot)

            def along(t: float, at: np.ndarray = at, to: np.ndarray = to, tried: dict = tried) -> tuple[float, float]:
                tried[t] = _measured(state, shares(at + t * to), shares(to)) / n
                return tried[t][0], tried[t][1]

            norm = np.sqrt(max(dot(to, to), 0.0))
            t = line_search(along, seen[0], dot(slope, to), 1.0 if step else 1 / norm)
            if t * np.sqrt(max(dot(slope, slope), 0.0)) < 1e-10:
                raise SearchFailed("step too small")
        except SearchFailed:
            if failed:
                break
            failed, steps, changes = True, [], []
            continue
        failed, step = False, step + 1
        at, seen, before = at + t * to, tried[t], slope
        point = shares(at)
        slope = gradient()
        steps, changes = [t * to, *steps][:CORRECTIONS], [slope - before, *changes][:CORRECTIONS]
        objective.append(seen[0])
        lately = [*lately, seen[0]][-REMEMBERED:]

    total = sum(share * t for share, t in zip(at[:-1], totals))

    def weigh(bucket: pa.Table, parts: pa.Table) -> pa.Table:
        mean = _flat(bucket, "mean")
        weight = _flat(bucket, "inverse") * (_bucket_sums(bucket, parts) - mean * total)
        return pa.table({"term": bucket.column("term").combine_chunks().flatten(), "weight": weight, "base": weight * mean})

    parts = _parts(held, state, list(zip(at[:-1] / n, points)))
    cells = buckets.groupBy("bucket").cogroup(parts.groupBy("bucket"))
    found = stored(cells.applyInArrow(weigh, "term string, weight double, base double"), "weights")
    base = found.agg(F.sum("base")).first()[0] or 0.0
    return TermWeights(found.select("term", "weight"), float(at[-1]) - base, tuple(map(float, objective)))
