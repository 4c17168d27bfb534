"""File sources: JSON, text, CSV and LibSVM scans.

Production reads should pass an explicit schema; inference is kept for parity with
the reference and costs an extra pass (``samplingRatio`` limits it).  Splits of files follow
the session's ``spark.sql.files.*`` settings; ``read_text`` takes a minimum beside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.session import scratch_path


def read_json(
    spark: SparkSession, path: str, schema: StructType | str | None = None, sampling_ratio: float = 1.0
) -> DataFrame:
    """JSON-lines scan (S01); inference over ``sampling_ratio`` of the rows."""
    reader = spark.read.format("json")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("samplingRatio", str(sampling_ratio))
    return reader.load(path)


def infer_json_schema(df: DataFrame, col: str, sampling_ratio: float = 1.0) -> StructType:
    """Infer a schema from the JSON strings of ``col``: all of them, or a stated share.

    The strings are written as lines to the shared scratch folder and inferred by
    Spark's distributed JSON reader.  Line breaks are blanks in JSON, so each value
    stays one line.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "json-lines")
    lines = F.regexp_replace(F.col(col), r"[\r\n]", " ").alias("value")
    df.where(F.col(col).isNotNull()).select(lines).write.text(path)
    schema = spark.read.option("samplingRatio", str(sampling_ratio)).json(path).schema
    if not schema.fields:
        raise ValueError(f"no JSON values in {col!r} to infer a schema from")
    return schema


def json_from_lines(df: DataFrame, col: str, schema: StructType | str | None = None) -> DataFrame:
    """Parse JSON text held in a column (S03); fields become top-level columns.

    Malformed values give null fields (``PERMISSIVE``), never an error.  A field with the name
    of a column that stays (case aside, as Spark resolves names) is an error that says which.
    """
    schema = schema or infer_json_schema(df, col)
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    kept = {c.lower() for c in df.columns if c != col}
    clash = sorted(f.name for f in fields.fields if f.name.lower() in kept)
    if clash:
        raise ValueError(f"JSON fields and columns share the names {clash}; rename or drop the columns")
    parsed = F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"})
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, parsed.alias("_j")).select(*keep, "_j.*")


def json_prefiltered(df: DataFrame, col: str, contains: str, schema: StructType | str | None = None) -> DataFrame:
    """Keep only lines containing ``contains`` *before* parsing them."""
    return json_from_lines(df.where(F.col(col).contains(contains)), col, schema)


def read_text(spark: SparkSession, path: str, whole_text: bool = False, min_partitions: int | None = None) -> DataFrame:
    """Text lines (S05, S07 directory, S08 typed strings): one ``value`` column.

    ``min_partitions`` (S06): a scan that its files and the session's settings cut into fewer
    parts is dealt out once, by rows; one that has as many or more stays as it is.
    """
    lines = spark.read.option("wholetext", str(whole_text).lower()).text(path)
    if min_partitions and lines.rdd.getNumPartitions() < min_partitions:
        return lines.repartition(min_partitions)
    return lines


def read_csv(
    spark: SparkSession,
    path: str,
    header: bool = True,
    delimiter: str = ",",
    infer_schema: bool = False,
    schema: StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV scan (S09 all strings, S10 inferred types).

    Quotes inside a quoted field are doubled.  ``multi_line`` admits line breaks inside
    quoted fields (free text); a file is then read by one task, so write such data in
    files of a size that one task can read.
    """
    reader = spark.read.option("header", str(header).lower()).option("delimiter", delimiter)
    reader = reader.option("escape", '"').option("multiLine", str(multi_line).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LibSVM scan (S11): ``(label double, features vector)``."""
    reader = spark.read.format("libsvm")
    if num_features:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)


def libsvm_lines(label: Column, values: Column) -> Column:
    """Format ``label`` and a numeric array as a LibSVM line (1-based, zeros left out)."""
    idx = F.filter(
        F.transform(values, lambda v, i: F.when(v != 0, F.concat((i + 1).cast("string"), F.lit(":"), v.cast("string")))),
        lambda s: s.isNotNull(),
    )
    return F.concat_ws(" ", label.cast("string"), F.array_join(idx, " "))
