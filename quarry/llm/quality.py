"""Quality classifier: regularised quadratic discriminant (operator 1).

Each text becomes a vector of transformed statistics (``statistics``).  Per class the mean
and covariance are sums over labelled rows, added up by Spark; the driver gets
``2 * (1 + d + d * d)`` numbers whatever the corpus.  Covariances are shrunk towards the
pooled one and that towards a multiple of the identity.  A score is the logistic of the
difference of log densities, each a Mahalanobis distance by a Cholesky factor that is
computed once on the driver and reused by every task, plus the log ratio of class sizes.

Fitting uses every labelled row outside the held-out fold
(``crc32(doc_id as text) % 4 = 2``); label, language, source and id are no inputs.

Edge cases: a null text is an empty text and gets a score like any other; rows of ``labels``
with null id or label are left out, and an id with several labels counts once for each; a
document without a row in ``labels`` is scored only; repeated rows stay rows; if a class
has fewer than two rows every score is the smoothed share of label 1, ``(n1 + 1) / (n + 2)``
(0.5 without any); an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import batch_texts, parts, texts_to_python
from quarry.llm.sketch import bloom, may_contain

HELD_OUT_FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: share of the pooled covariance in a class covariance, share of the identity in the pooled
SHRINK, RIDGE = 0.4, 0.005

SYMBOLS = np.frombuffer(b"#$%&*|!+=~^<>{}[]\\@_/", np.uint8)


def statistics(text: str | None) -> list[float]:
    text = text or ""
    words, lines, n = text.split(), text.split("\n"), len(text)
    size = len(words)
    of = Counter(words)
    chars = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    symbols, digits = int(chars[SYMBOLS].sum()), int(chars[48:58].sum())
    upper, lower = int(chars[65:91].sum()), int(chars[97:123].sum() + chars[192:].sum())
    again = sum(map(eq, words, words[1:]))
    short = sum(len(w) <= 3 for w in words)
    counts = [
        ((symbols + 0.5), (n + 50)),
        ((upper + 1), (lower + 20)),
        ((max(of.values(), default=0) + 1), (size + 10)),
        ((again + 0.5), (size + 10)),
        ((len(of) + 1), (size + 2)),
        ((n - int(chars[32]) + 5), (size + 1)),
        ((short + 1), (size + 5)),
        ((int(chars[124]) + 0.5), (size + 10)),
        ((int(chars[46]) + 1), (size + 5)),
        ((int(chars[33]) + 0.5), (size + 10)),
        ((digits + 0.5), (n + 50)),
        ((len(lines) - len(set(lines)) + 0.5), (len(lines) + 2)),
        ((n + 10), (len(lines))),
        ((n + 10), 1),
    ]
    top, under = np.array(counts, np.float64).T
    return np.log(top / under).tolist()


WIDTH = len(statistics(""))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS == HELD_OUT, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Class means, inverse Cholesky factors, and offsets of the log densities."""

    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None
    offset: float  # of class 1 over class 0, or the constant score's logit

    def score(self, x: np.ndarray) -> np.ndarray:
        difference = np.full(len(x), self.offset)
        if self.means is not None:
            far = [(((x - m) @ f.T) ** 2).sum(axis=1) for m, f in zip(self.means, self.factors, strict=True)]
            difference += 0.5 * (far[0] - far[1])
        return 1 / (1 + np.exp(-np.clip(difference, -500, 500)))


def _sums(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class: rows, sum and cross products of the statistics, added up by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            x = np.array(b.column("x").to_pylist(), np.float64).reshape(-1, WIDTH)
            label = b.column("label").to_numpy()
            for c in np.unique(label):
                one = np.column_stack([np.ones((label == c).sum()), x[label == c]])
                total[int(c)] = total.get(int(c), 0) + one.T @ one
        for c, m in total.items():
            flat = m.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(flat), c, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)],
                ["label", "cell", "value"],
            )

    cells = labelled.mapInArrow(partial, "label int, cell int, value double").groupBy("label", "cell").agg(F.sum("value").alias("value"))
    out = {}
    for r in cells.collect():  # 2 * (d + 1)^2 numbers
        out.setdefault(r.label, np.zeros((WIDTH + 1) ** 2))[r.cell] = r.value
    full = {c: m.reshape(WIDTH + 1, WIDTH + 1) for c, m in out.items()}
    return {c: (m[0, 0], m[0, 1:], m[1:, 1:]) for c, m in full.items()}


def with_statistics(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    kept_type = docs.schema[doc_id].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            x = [statistics(t) for t in batch_texts(b)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    own = texts_to_python(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(measure, f"doc_id {kept_type}, x array<double>")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    shrink: float = SHRINK,
    ridge: float = RIDGE,
) -> Model:
    marks = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).dropna().where("label in (0, 1)").distinct()
    # texts of the fold and of documents without a label are not measured
    id_ = F.col(f"`{doc_id}`")
    likely = may_contain(bloom(marks.select(F.col("doc_id").cast("string").alias("k")), "k"), id_.cast("string"))
    rows = with_statistics(docs.where(~held_out(id_) & F.coalesce(likely, F.lit(False))), doc_id, text)
    sums = _sums(rows.join(marks, "doc_id").select("label", "x"))
    n = {c: sums[c][0] if c in sums else 0 for c in (0, 1)}
    if min(n.values()) < 2:
        return Model(None, None, float(np.log((n[1] + 1) / (n[0] + 1))))
    means = {c: sums[c][1] / n[c] for c in (0, 1)}
    scatter = {c: sums[c][2] - n[c] * np.outer(means[c], means[c]) for c in (0, 1)}
    pooled = (scatter[0] + scatter[1]) / (n[0] + n[1])
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-12))  # statistics differ in unit
    factors, log_det = {}, {}
    for c in (0, 1):
        own = (1 - shrink) * scatter[c] / n[c] + shrink * pooled
        own = own / np.outer(scale, scale)
        own = (1 - ridge) * own + ridge * np.trace(own) / WIDTH * np.eye(WIDTH)
        low = np.linalg.cholesky(own)
        log_det[c] = 2 * np.log(np.diag(low)).sum()
        factors[c] = np.linalg.inv(low) / scale
    offset = float(np.log(n[1] / n[0]) - 0.5 * (log_det[1] - log_det[0]))
    return Model((means[0], means[1]), (factors[0], factors[1]), offset)


def _scored(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """The columns of ``docs`` as c0, c1, ... (they may have any names), and the score ``s``."""
    inner = [f"c{i}" for i in range(len(docs.columns))]
    own = texts_to_python(docs).toDF(*inner)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields)
    text_at = inner[docs.columns.index(text)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            x = np.array([statistics(t) for t in batch_texts(b, text_at)], np.float64).reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(x))], [*b.schema.names, "s"])

    return own.mapInArrow(add, f"{schema}, s double")


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with all its columns and the score last."""
    return _scored(docs, model, text).toDF(*docs.columns, out)


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``."""
    return _scored(docs, model, text).where(F.col("s") >= threshold).drop("s").toDF(*docs.columns)
