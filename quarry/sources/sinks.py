"""Sinks and materialisation.

Writes go to the given path; intermediate results go under the shared checkpoint
folder (``quarry.session.scratch_path``).  ``cut_lineage`` uses a reliable
``checkpoint()``, which survives executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarry.session import ensure_checkpoint_dir


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False, mode: str = "overwrite") -> str:
    """CSV sink (K01).  ``single_file`` funnels all rows through one task: only for
    small outputs.

    Quotes inside a field are doubled; a field with a line break is quoted and is read
    back with ``read_csv(multi_line=True)``.  Blanks at the ends of a field are kept.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode).option("header", str(header).lower()).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    if len(df.columns) != 1:
        raise ValueError("a text sink takes exactly one string column")
    df.write.mode(mode).text(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` so that later plans start from it.

    A reliable checkpoint into ``spark.checkpoint.dir``; the returned plan has no
    reference to the original sources.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
