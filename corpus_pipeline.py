"""The corpus pipeline: quality, line dedup, SimHash near-dedup, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and is written as
Parquet and read again before the next one.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, line_dedup, packing, quality, simhash
from quarry.session import scratch_path
from quarry.tables import read_table

END_ID = 1


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, accepts."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that occurred before; ``n_chars`` follows the text."""
    shorter = line_dedup.dedup(docs)
    return shorter.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spec = bpe.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(docs, spec, END_ID).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash", keep_one_of_near_copies),
    ("packing", pack_tokens),
]

#: SQL has neither the classifier nor BPE; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
