"""Merkle manifest of a dataset by slot pivots (operator 13).

Leaves are SHA-256 hex digests of rows (``leaf_digest``).  Per group (``source``) they stand
in order of id and form a tree of ``fanout`` children a node; the groups' tops, in order of
the group, form a second tree whose top is the root of the dataset.

* Texts are read once.  What goes on is a row's id, its digest and, if it is to be checked
  against another version of its text, that version's digest.
* ``segments.running`` numbers leaves within their group along sorted slices, so a group that
  holds a third of all rows is dealt over as many slices as its rows need.
* A level is one aggregate by (group, number of the parent): conditional aggregates put the
  child of slot i into column ``s<i>`` (the slot pivot).  Concatenating the columns gives the
  parent's digest; concatenating them without the own slot gives a child's siblings.  A parent
  has ``fanout`` children at most, so no group of rows is large.  Levels end when every group
  has one node: log(rows) / log(fanout) rounds, each a ``1 / fanout`` of the one before.
* On the way down a node's path, the siblings left and right of each step to the root, is its
  own siblings and its parent's path.  Paths are made for nodes above the leaves only, one row
  for ``fanout`` leaves; the leaves of a parent take theirs from its slot columns.

Defined results: nulls are ``-`` in a digest; a null group is a group and comes first; within
a group null ids come first and equal ids are ordered by digest, then by the other version's
digest; repeated rows are leaves of their own; a group of one leaf has that leaf as its top; a
dataset of one row has its leaf as root and no siblings; an empty table gives an empty
manifest.  Columns that are not hashed are ignored, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import segments
from quarry.session import scratch_path

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return digest(F.concat(*[encoded(c) for c in columns]))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` does just that on texts of ASCII."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def tampered(doc_id: Column, every: int = TAMPER_EVERY) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % every == 0, F.lit(False))


def _name(group: Column) -> Column:
    """The group as a string that is never null, in the group's order with null first."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit("!"))


# ---- trees -----------------------------------------------------------------------------


def _pivot(nodes: DataFrame, fanout: int, payload: Sequence[str]) -> DataFrame:
    """One row per parent: (g, parent, s0 ... s<fanout-1>), and each payload column likewise."""
    names = {"h": "s"} | {p: f"{p}_" for p in payload}
    columns = [f"max(case when slot = {i} then {c} end) as {n}{i}" for c, n in names.items() for i in range(fanout)]
    placed = nodes.selectExpr("g", f"idx div {fanout} as parent", f"idx % {fanout} as slot", *names)
    return placed.groupBy("g", "parent").agg(*map(F.expr, columns))


def _slots(fanout: int, name: str = "s") -> Column:
    return F.expr(f"array({', '.join(f'{name}{i}' for i in range(fanout))})")


def _children(rows: DataFrame, fanout: int, payload: Sequence[str] = ()) -> DataFrame:
    """A row per child of pivoted ``rows``: its slot, digest ``h`` and payload, and in ``own``
    its one step (left, right): the slot columns before and behind its own, concatenated."""
    columns = [F.col(c) for c in rows.columns if c in ("g", "parent", "path", "top_path", "subroot")]
    zipped = F.arrays_zip(_slots(fanout).alias("h"), *[_slots(fanout, f"{p}_").alias(p) for p in payload])
    cut = rows.select(*columns, _slots(fanout).alias("slots"), F.posexplode(zipped).alias("slot", "child"))
    left = F.array_join(F.slice("slots", F.lit(1), F.col("slot")), "")
    right = F.array_join(F.slice("slots", F.col("slot") + 2, F.lit(fanout)), "")
    own = F.array(F.struct(left.alias("left"), right.alias("right")))
    there = cut.where("child.h is not null")
    return there.select(*columns, "slot", *[F.col(f"child.{p}").alias(p) for p in ("h", *payload)], own.alias("own"))


def _path() -> Column:
    """A child's path to the root, from its own step and its parent's path."""
    return F.when(F.col("path").isNull(), F.col("top_path")).otherwise(F.concat("own", "path"))


#: the parent's only child is the group's only node: it is the top, not a child
_TOP = "parent = 0 and s1 is null"


def _up(nodes: DataFrame, fanout: int, payload: Sequence[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """The pivoted levels from the leaves up, and each group's top ``(g, h)``."""
    spark, levels = nodes.sparkSession, []
    tops = None
    while True:
        path = scratch_path(spark, f"{name}-{len(levels)}")
        _pivot(nodes, fanout, () if levels else payload).write.parquet(path)
        level = spark.read.parquet(path)
        levels.append(level)
        own = level.where(_TOP).select("g", F.col("s0").alias("h"))
        tops = own if tops is None else tops.union(own)
        rest = level.where(f"not ({_TOP})")
        if rest.isEmpty():
            return levels, tops
        nodes = rest.select("g", F.col("parent").alias("idx"), digest(F.array_join(_slots(fanout), "")).alias("h"))


def _paths_of(level: DataFrame, above: DataFrame | None, tops: DataFrame) -> DataFrame:
    """``level`` with its parents' paths (column ``path``, null at a top), and of the group's
    top the path (``top_path``) and the digest (``subroot``)."""
    names = [*level.columns, "path", "top_path", "subroot"]
    top = level.where(_TOP).join(tops, "g").withColumn("path", F.lit(None).cast(_PATH))
    if above is None:
        return top.select(*names)
    rest = level.where(f"not ({_TOP})").join(above, ["g", "parent"])
    return top.select(*names).unionByName(rest.select(*names))


_PATH = "array<struct<left:string,right:string>>"


def _down(levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """The leaves' level with each row's parent's path; ``tops`` has g, top_path, subroot."""
    above = None
    for level in reversed(levels[1:]):
        child = _children(_paths_of(level, above, tops), fanout)
        number = (F.col("parent") * fanout + F.col("slot")).alias("parent")
        above = child.select("g", number, _path().alias("path"), "top_path", "subroot")
    return _paths_of(levels[0], above, tops)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings along ``path`` give."""
    return F.aggregate(path, leaf, lambda acc, x: digest(F.concat(x.left, acc, x.right)))


def proof(path: Column) -> Column:
    """The digest of all siblings along ``path``."""
    return digest(F.array_join(F.transform(path, lambda x: F.concat(x.left, x.right)), ""))


def manifest(
    docs: DataFrame,
    group: str = "source",
    doc_id: str = "doc_id",
    columns: Sequence[str] = COLUMNS,
    text: str = "text",
    fanout: int = FANOUT,
    every: int = TAMPER_EVERY,
    slice_rows: int = segments.SLICE_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified.  Rows of which ``tampered(doc_id)`` holds are folded from the digest of their
    lower-cased text, all others from their own."""
    if fanout < 2:
        raise ValueError("a node needs two children or more")
    spark = docs.sparkSession
    cells = {c: F.col(f"`{c}`") for c in columns}
    changed = [lower_ascii(v) if c == text else v for c, v in cells.items()]
    path = scratch_path(spark, "leaves")
    docs.select(
        _name(F.col(f"`{group}`")).alias("g"),
        F.col(f"`{doc_id}`").alias("doc_id"),
        leaf_digest(list(cells.values())).alias("h"),
        F.when(tampered(F.col(f"`{doc_id}`"), every), leaf_digest(changed)).alias("other"),
    ).write.parquet(path)
    leaves = spark.read.parquet(path)
    order = [F.col("g"), F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("other")]
    placed = segments.running(segments.slices(leaves, order, leaves.count(), slice_rows), "g", "n")
    # an id may be null: its slot says so, and the digest says whether there is a leaf
    nodes = placed.select("g", (F.col("n") - 1).alias("idx"), "h", "doc_id", "other")
    levels, tops = _up(nodes, fanout, ["doc_id", "other"], "merkle")

    listed = scratch_path(spark, "tops")
    tops.select(F.lit(0).alias("all"), "g", "h").write.parquet(listed)
    tops = spark.read.parquet(listed)
    placed = segments.running(segments.slices(tops, [F.col("g")], tops.count(), slice_rows), "all", "n")
    second = placed.select(F.col("all").alias("g"), (F.col("n") - 1).alias("idx"), "h", F.col("g").alias("name"))
    upper, root = _up(second, fanout, ["name"], "merkle-top")
    top = root.first()  # one digest

    whole = spark.createDataFrame([(0, [], "")], f"g int, top_path {_PATH}, subroot string")
    found = _children(_down(upper, whole, fanout), fanout, ["name"])
    paths = scratch_path(spark, "top-paths")
    found.select(F.col("name").alias("g"), _path().alias("top_path"), F.col("h").alias("subroot")).write.parquet(paths)
    tops = spark.read.parquet(paths)

    found = _children(_down(levels, tops, fanout), fanout, ["doc_id", "other"])
    found = found.select("doc_id", "h", "other", "subroot", _path().alias("path"))
    out = found.select(
        "doc_id",
        F.col("h").alias("leaf"),
        "subroot",
        F.lit(top.h if top else None).cast("string").alias("root"),
        proof(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("other", "h"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
