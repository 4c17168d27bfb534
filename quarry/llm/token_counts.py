"""Token counts as delta-maintained rollups (operator 8).

A store is a folder on shared storage.  A batch of signed rows (+1 insert, -1 delete; a
revised count is a delete of the old row and an insert of the new one) is written as

* ``ledger/batch=<id>``: the signed rows, ``(doc_id, sign, source, lang, tokenizer,
  n_tokens)``, from which a later delete or revision takes the old counts, and
* ``totals/batch=<id>``: their sums by source, language and tokenizer version.

``commit`` overwrites the folders of its batch id, ledger first, so a batch that is sent
again, or whose job died half way, leaves the same files as one that ran once.  ``totals``
adds the batches' sums: its work grows with the groups and batches, never with the texts.

A source that holds a third of the rows is one partial sum per task.  Edge cases: a null
text counts no tokens; null source or language are groups of their own; repeated inserts of
an id add up and are deleted together; a delete of an unknown or null id is nothing; a store
that was only created has no totals; an empty table adds none; other columns are ignored.  Ids
are longs: ``count`` casts them, and an id that is no number is an error.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.bpe import MEMO_WORDS, TextEncoder, batch_texts, parts, texts_to_python

GROUP = ["source", "lang", "tokenizer"]
LEDGER = "doc_id long, sign int, source string, lang string, tokenizer string, n_tokens long, batch long"
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch long"


def count(docs: DataFrame, specs: Mapping[str, str]) -> DataFrame:
    """``(doc_id, source, lang, tokenizer, n_tokens)``: a row per document and version."""
    own = texts_to_python(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text")
    names = ["doc_id", "source", "lang", "tokenizer", "n_tokens"]

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            texts = batch_texts(b)
            for name, spec in specs.items():
                n = [len(x) // 4 for x in TextEncoder.of(spec, 2 * MEMO_WORDS).encode(texts)]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in names[:3]), pa.array([name] * len(n), pa.string()), pa.array(n, pa.int64())], names
                )

    return own.mapInArrow(tokens, "doc_id long, source string, lang string, tokenizer string, n_tokens long")


def inserts(counted: DataFrame) -> DataFrame:
    return counted.withColumn("sign", F.lit(1))


def create(spark: SparkSession, store: str) -> None:
    """An empty store: batch 0 without rows, so that every read finds files."""
    commit(spark, store, 0, spark.createDataFrame([], "doc_id long, sign int, source string, lang string, tokenizer string, n_tokens long"))


def ledger(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(f"{store}/ledger")


def live(spark: SparkSession, store: str, before: int) -> DataFrame:
    """Rows of the ledger that batches below ``before`` leave in force, with their number."""
    rows = ledger(spark, store).where(F.col("batch") < before)
    return rows.groupBy("doc_id", *GROUP, "n_tokens").agg(F.sum("sign").alias("times")).where("times > 0")


def deletes(spark: SparkSession, store: str, ids: DataFrame, before: int) -> DataFrame:
    """Signed rows that take back what is in force for the ids (column ``doc_id``)."""
    old = live(spark, store, before).join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
    return old.select("doc_id", *GROUP, "n_tokens", (-F.col("times")).cast("int").alias("sign"))


def revisions(spark: SparkSession, store: str, counted: DataFrame, before: int) -> DataFrame:
    """Deletes of the old counts of the documents in ``counted``, and inserts of the new.  The
    new counts are written once, beside the batch that they are for."""
    staged = f"{store}/staged/before={before}"
    counted.write.mode("overwrite").parquet(staged)
    counted = spark.read.parquet(staged)
    known = counted.join(live(spark, store, before).select("doc_id").distinct(), "doc_id", "left_semi")
    return deletes(spark, store, known, before).unionByName(inserts(known))


def commit(spark: SparkSession, store: str, batch: int, signed: DataFrame) -> None:
    """Write one batch; sending it again replaces it by itself."""
    folder = f"{store}/ledger/batch={batch}"
    signed.select("doc_id", "sign", *GROUP, "n_tokens").write.mode("overwrite").parquet(folder)
    rows = spark.read.parquet(folder)
    sums = rows.groupBy(*GROUP).agg(
        F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens")
    )
    sums.write.mode("overwrite").parquet(f"{store}/totals/batch={batch}")


def totals(spark: SparkSession, store: str) -> DataFrame:
    """``(source, lang, tokenizer, n_docs, n_tokens)`` over all committed batches."""
    sums = spark.read.schema(TOTALS).parquet(f"{store}/totals").groupBy(*GROUP)
    return sums.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")
