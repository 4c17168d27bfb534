"""Conversation prefix trie with depth-band rollups (operator 11).

A node is a distinct sequence of the first d turns (role, text) of some conversation; the root
is the empty sequence.  Nodes are found by one aggregate of the turns: a turn's row holds the
digest of its prefix, the running exclusive or of two 64-bit hashes of its turns, each hashed
with its place; the own turn taken out again gives the parent.  It runs along sorted slices (``segments.running``), so a conversation
of any length is dealt over as many slices as its rows need.  Texts travel nowhere: a turn is
its MD5 digest and its length from the first scan on.

What a node adds up over its subtree is rolled up in bands of ``height`` depths:

1. Every node sends its values to its ancestors within its own band, at most ``height`` rows
   whatever the depth, and fewer after they are summed by (smallest member, depth), for nodes
   of one smallest member share their way up.
2. A band's root now holds what its band adds up to.  The roots of all bands form a trie of
   their own, ``height`` times less deep, whose totals are found by the same two steps:
   log(depth) / log(height) rounds.
3. Each completed root sends its total to the ancestors in the band above, again at most
   ``height`` rows, and every node is complete.

A node's smallest member names it together with its depth, and ancestors are looked up in the
turns' table by (conversation, depth), which is unique.  Parents with very many children are
looked up by a broadcast of at most a thousand rows.  The list of conversations that end at a
node is hashed as a stream: sorted slices turn into pieces of text, and the pieces of a node go
through SHA-256 in order; a third of all conversations may end at one node.

Defined results: turns are ordered by number, null first, then by the digest of role and text;
null role or text are empty; rows with null id belong to no conversation and are left out;
repeated rows are turns of their own; remainders of negative ids keep their sign; an empty
table has no nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import segments
from quarry.session import scratch_path

HEIGHT = 16
SHARED = 6
STRIDE = 100
#: characters of a piece of an id list
PIECE = 1 << 16
PREFIX = ["depth", "x", "y"]


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, digest, chars): what the trie needs of each turn."""
    role_, text_ = F.coalesce(F.col(f"`{role}`"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    both = F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_)
    return conversations.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.md5(both.cast("binary")).alias("digest"),
        F.char_length(text_).cast("long").alias("chars"),
    ).where("conv is not null")


def shared_turns(conv: Column, shared: int = SHARED) -> Column:
    """How many turns conversation ``conv`` takes over."""
    return (F.crc32(conv.cast("string").cast("binary")) % shared).cast("long")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def rebuilt(turns: DataFrame, shared: int = SHARED, stride: int = STRIDE, slice_rows: int = segments.SLICE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(conv, part, at, digest, chars) in the order (part, at): the first ``shared_turns`` of
    the conversation ``conv - conv % stride`` (part 0), then conv's own further turns (part 1);
    and (conv) of all conversations, also those that are left without turns."""
    turns = _stored(turns, "turns")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")]
    placed = _stored(segments.running(segments.slices(turns, order, turns.count(), slice_rows), "conv", "at").drop("_pid"), "placed")
    convs = placed.select("conv").distinct().withColumn("h", shared_turns(F.col("conv"), shared))
    first = placed.where(F.col("at") < shared).select(F.col("conv").alias("base"), "at", "digest", "chars")
    base = (F.col("conv") - F.col("conv") % stride).alias("base")
    wanted = convs.where("h > 0").select("conv", base, F.explode(F.sequence(F.lit(1).cast("long"), F.col("h"))).alias("at"))
    head = wanted.join(first, ["base", "at"]).select("conv", F.lit(0).alias("part"), "at", "digest", "chars")
    own = placed.where(F.col("at") > shared_turns(F.col("conv"), shared)).select("conv", F.lit(1).alias("part"), "at", "digest", "chars")
    return head.unionByName(own), convs.select("conv")


def prefixes(sequence: DataFrame, convs: DataFrame, slice_rows: int = segments.SLICE_ROWS) -> DataFrame:
    """(conv, depth, x, y, up_x, up_y, chars): each prefix of each conversation, with the
    digest of the prefix (x, y) and of the one above; depth 0 for every row of ``convs``."""
    sequence = _stored(sequence, "sequence")
    sliced = segments.slices(sequence, [F.col("conv"), F.col("part"), F.col("at")], sequence.count(), slice_rows)
    deep = segments.running(sliced, "conv", "depth")
    hash_ = {c: F.xxhash64(F.lit(i), "depth", "digest") for i, c in enumerate("xy", 1)}
    own = [h.alias(name) for c, h in hash_.items() for name in (c, f"own_{c}")]
    mixed = segments.running(deep.select("conv", "depth", "chars", "_pid", *own), "conv", "n", ["x", "y"])
    ups = [F.col(c).bitwiseXOR(F.col(f"own_{c}")).alias(f"up_{c}") for c in "xy"]
    nodes = mixed.select("conv", "depth", "x", "y", *ups, "chars")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", zero.alias("depth"), *[zero.alias(c) for c in ("x", "y", "up_x", "up_y", "chars")])
    return _stored(nodes.unionByName(roots), "prefixes")


def _rollup(values: DataFrame, prefix: DataFrame, names: list[str], height: int, unit: int, deepest: int) -> DataFrame:
    """(depth, x, y, conv, names): the sums of ``names`` over each node's subtree, for nodes
    ``(conv, depth)`` whose depths are multiples of ``unit``."""
    band = unit * height
    sums = [F.sum(n).alias(n) for n in names]

    def sent(rows: DataFrame, low: Column, high: Column) -> DataFrame:
        """``rows`` summed at their ancestors of the depths low, low + unit ... high."""
        to = rows.select("conv", F.explode(F.sequence(low, high, F.lit(unit).cast("long"))).alias("depth"), *names)
        at = to.groupBy("conv", "depth").agg(*sums)  # nodes of one smallest member go the same way
        found = at.join(prefix.select("conv", *PREFIX), ["conv", "depth"])
        return found.groupBy(*PREFIX).agg(F.min("conv").alias("conv"), *sums)

    depth = F.col("depth")
    partial = sent(values, depth - depth % band, depth)
    if deepest < band:
        return partial
    partial = _stored(partial, f"band-{unit}")
    roots = partial.where(depth % band == 0)
    totals = _rollup(roots, prefix, names, height, band, deepest)
    passed = sent(totals.where("depth > 0"), depth - band, depth - unit)
    return partial.unionByName(passed).groupBy(*PREFIX).agg(F.min("conv").alias("conv"), *sums)


def end_lists(ends: DataFrame, rows: int, slice_rows: int = segments.SLICE_ROWS, piece: int = PIECE) -> DataFrame:
    """(depth, x, y, ends_sha256): of the ascending, comma-joined ids of ``ends`` (columns
    depth, x, y, conv) at each node."""
    names = [*PREFIX, "first", "ids"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of a sorted slice as comma-joined text, cut at nodes and at ``piece`` characters."""
        key, held, size, out = None, [], 0, []

        def cut() -> None:
            if held:
                out.append((*key, held[0], ",".join(map(str, held))))

        for b in batches:
            for *node, conv in zip(*(b.column(c).to_pylist() for c in (*PREFIX, "conv")), strict=True):
                if node != key or size > piece:
                    cut()
                    key, held, size = node, [], 0
                held.append(conv)
                size += 20
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)))
                out.clear()
        cut()
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A node's pieces arrive in order; one hash state is held at a time."""
        key, state, out = None, None, []
        for b in batches:
            for *node, ids in zip(*(b.column(c).to_pylist() for c in (*PREFIX, "ids")), strict=True):
                if node == key:
                    state.update(b",")
                else:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = node, hashlib.sha256()
                state.update(ids.encode())
            if len(out) > 10_000:
                yield batch(out)
                out = []
        if key:
            yield batch([*out, (*key, state.hexdigest())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(dict(zip([*PREFIX, "ends_sha256"], map(list, zip(*rows, strict=True)), strict=True)))

    n = max(int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // slice_rows))
    order = [*PREFIX, "conv"]
    cut = ends.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(pieces, "depth long, x long, y long, first long, ids string")
    return cut.repartition(*PREFIX).sortWithinPartitions(*PREFIX, "first").mapInArrow(digests, "depth long, x long, y long, ends_sha256 string")


def trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    shared: int = SHARED,
    stride: int = STRIDE,
    height: int = HEIGHT,
    slice_rows: int = segments.SLICE_ROWS,
) -> DataFrame:
    """One row per node of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    if height < 2:
        raise ValueError("a band needs two depths or more")
    sequence, convs = rebuilt(_turns(conversations, conv_id, turn, role, text), shared, stride, slice_rows)
    prefix = prefixes(sequence, convs, slice_rows)
    count = F.count(F.lit(1))
    nodes = prefix.groupBy(*PREFIX).agg(
        F.min("conv").alias("conv"), count.alias("n_convs"), *[F.max(c).alias(c) for c in ("up_x", "up_y", "chars")]
    )
    nodes = _stored(nodes, "nodes")
    size = nodes.agg(count.alias("n"), F.max("depth").alias("deepest"), F.sum(F.when(F.col("depth") == 0, F.col("n_convs"))).alias("convs")).first()

    up = [(F.col("depth") - 1).alias("depth"), F.col("up_x").alias("x"), F.col("up_y").alias("y")]
    children = nodes.where("depth > 0").select(*up).groupBy(*PREFIX).agg(count.alias("n_children"))
    parents = _stored(nodes.select(*PREFIX, "conv", "n_convs", "chars").join(children, PREFIX, "left").na.fill(0, ["n_children"]), "parents")

    leaf = (F.col("n_children") == 0).cast("long").alias("n_leaves")
    saved = ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")
    values = parents.select("conv", "depth", leaf, saved)
    totals = _rollup(values, prefix, ["n_leaves", "saved_tokens"], height, 1, size.deepest or 0)

    named = parents.where("n_children > 0").select(*[F.col(c).alias(f"up_{c}") for c in PREFIX], F.col("conv").alias("parent"), "n_children")
    heads = nodes.where("depth > 0").select("conv", "depth", (F.col("depth") - 1).alias("up_depth"), "up_x", "up_y")
    above = segments.lookup(heads, named, ["up_depth", "up_x", "up_y"], "n_children", size.n).select("conv", "depth", "parent")

    last = prefix.groupBy("conv").agg(F.max(F.struct(*PREFIX)).alias("last")).select("last.*", "conv")
    ends = end_lists(last, size.convs or 0, slice_rows)
    none = hashlib.sha256(b"").hexdigest()
    return (
        parents.join(totals.select(*PREFIX, "n_leaves", "saved_tokens"), PREFIX)
        .join(ends, PREFIX, "left")
        .join(above, ["conv", "depth"], "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )
