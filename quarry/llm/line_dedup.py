"""Line dedup by a segment-partition edit join (operator 4), DataFrame operations only.

Lines of ``min_chars`` characters or more that occur before, exactly or within ``threshold``
edits, are dropped.  Shorter lines have classes too, by equality alone, and stay; blank lines
are no lines here.  Edits are looked for between all lines of ``near_chars`` characters or more
(``min_chars``, unless set higher).

1. Equal lines become one row (``first`` occurrence by doc_id and line number).
2. Every line of length L is cut into ``threshold + 1`` even segments.  Within ``threshold``
   edits at least one segment of the shorter line survives in the longer one, near its
   place.  Index rows hold (segment number, length, segment); probe rows hold, for every
   admissible length, the substrings whose place the remaining edits admit.
3. Index and probe meet by one equality join on a 64-bit key.  The counts of some letters
   (an edit changes them by two in sum at most) are part of the join's condition, so lines
   that share a segment and differ elsewhere are no candidates.
4. A key of ``hot`` index lines or more gives no pairs: in the join its first line stands for
   all of them, so a group of n near copies makes n rows and not n * n.  Where the classes that
   come of it still differ within such a key, the lines of other classes than the first line's
   are compared with all others in blocks held as arrays, each line giving one link a block,
   until no block has any left.  For the number of links all blocks of the key are compared,
   and a pair counts in the block of its first common segment only.
5. Candidates are verified: equal ends are stripped by doubling steps, pairs whose new ends
   admit no two edits are out, the rest goes through a banded bit-parallel edit distance (``2 * threshold + 2`` bits, one step a column).
6. Linked lines form classes (components); a class keeps its first occurrence.

Order of occurrences: doc_id (null last), a hash of the text, line number.  Rows with equal
id and text count as one document and keep the same lines.  A null text has no lines and
stays null; a text that loses all its lines becomes empty and its row stays; lines end at
``\\n`` alone; an empty table gives an empty result.  ``dedup`` keeps all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.graph import connected_components
from quarry.llm.sketch import bloom, may_contain
from quarry.session import scratch_path

THRESHOLD = 2
MIN_CHARS = 20
NEAR_CHARS = MIN_CHARS
#: index lines of a key from which on it gives no pairs, and lines of a block
HOT, BLOCK = 128, 64
SIGNATURE_LETTERS = "etaonrih"
#: strips up to 2 ** 21 - 1 equal characters from either end
STEPS = [1 << k for k in range(20, -1, -1)]


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# ---- verification ----------------------------------------------------------------------


def _common(a: Column, b: Column) -> Column:
    """Length of the longest common prefix."""
    most = F.least(F.char_length(a), F.char_length(b))

    def longer(done: Column, step: Column) -> Column:
        same = F.substring(a, done + 1, step) == F.substring(b, done + 1, step)
        return F.when(done + step <= most, F.when(same, done + step).otherwise(done)).otherwise(done)

    return F.aggregate(F.array(*[F.lit(s) for s in STEPS]), F.lit(0), longer)


def _bit(i: int) -> int:
    return 1 << i


def _banded(a: Column, b: Column, k: int) -> Column:
    """Edit distance of ``a`` and ``b`` (lengths within ``k`` of each other) if it is at most
    ``k``, else some larger number.

    Column j of the distance table is held as vertical differences (+1 in ``vp``, -1 in
    ``vn``) of the rows around the diagonal; bit ``top`` is row ``j + k``.
    """
    top = 2 * k + 1
    ones = _bit(top + 1) - 1
    rows = F.char_length(a)
    long = lambda x: F.lit(x).cast("long")

    def inverted(x: Column) -> Column:
        return F.bitwise_not(x).bitwiseAND(long(ones))

    def column(rows_of: Column, at: Column, j: Column, acc: Column) -> Column:
        """One step; ``rows_of`` has the characters of ``a``, ``at`` is character j of ``b``."""
        match = long(0)
        for t in range(top + 1):
            same = F.coalesce(F.get(rows_of, j + (k - top + t - 1)) == at, F.lit(False))
            match = match + F.when(same, long(_bit(t))).otherwise(long(0))

        def with_match(m: Column) -> Column:
            carried = (m.bitwiseAND(acc.vp) + acc.vp).bitwiseXOR(acc.vp)
            return _let(carried.bitwiseOR(m).bitwiseOR(acc.vn).bitwiseAND(long(ones)), with_d0)

        def with_d0(d0: Column) -> Column:
            hp = acc.vn.bitwiseOR(inverted(d0.bitwiseOR(acc.vp)))
            return _let(F.struct(d0.alias("d0"), hp.alias("hp"), d0.bitwiseAND(acc.vp).alias("hn")), next_column)

        def next_column(x: Column) -> Column:
            below = j + k - rows  # over 0: the last row has entered the band, so walk along it
            place = F.greatest(F.lit(top) - below, F.lit(0))
            along = F.getbit(x.hp, place).cast("int") - F.getbit(x.hn, place).cast("int")
            down = F.lit(1) - F.getbit(x.d0, F.lit(top)).cast("int")
            moved = F.shiftrightunsigned(x.d0, 1)
            return F.struct(
                x.hn.bitwiseOR(inverted(moved.bitwiseOR(x.hp))).alias("vp"),
                x.hp.bitwiseAND(moved).alias("vn"),
                (acc.d + F.when(below > 0, along).otherwise(down)).cast("int").alias("d"),
            )

        return _let(match, with_match)

    start = F.struct(
        long(ones - (_bit(k + 1) - 1)).alias("vp"), long(0).alias("vn"), F.least(rows, F.lit(k)).cast("int").alias("d")
    )

    def over(chars: Column) -> Column:
        steps = F.transform(chars.b, lambda c, i: F.struct(c.alias("c"), (i + 1).alias("j")))
        return F.aggregate(steps, start, lambda acc, s: column(chars.a, s.c, s.j, acc), lambda acc: acc.d)

    return _let(F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b")), over)


def _ends_admit(a: Column, b: Column, k: int) -> Column:
    """Whether two edits are enough for strings without a common first or last character: one
    of them then stands at the front and one, if there are two, at the end, and what lies
    between is equal.  Exact for ``k`` up to 2, else no decision (true)."""
    if k > 2:
        return F.lit(True)
    p, q = F.char_length(a), F.char_length(b)
    edits = [(1, 1), (0, 1), (1, 0)]
    out = F.lit(False)
    for front in edits:
        for back in [(0, 0), *(edits if k == 2 else [])]:
            m, n = p - (front[0] + back[0]), q - (front[1] + back[1])
            same = F.substring(a, F.lit(front[0] + 1), m) == F.substring(b, F.lit(front[1] + 1), n)
            out = out | F.when((m == n) & (m >= 0), same).otherwise(F.lit(False))
    return out


def edit_distance_within(a: Column, b: Column, k: int) -> Column:
    """The edit distance if it is at most ``k``, else null."""

    def stripped(x: Column) -> Column:
        gap = F.abs(F.char_length(x.a) - F.char_length(x.b))
        none_left = (F.char_length(x.a) == 0) | (F.char_length(x.b) == 0)
        d = F.when(gap > k, F.lit(k + 1)).when(none_left, gap).when(~_ends_admit(x.a, x.b, k), F.lit(k + 1)).otherwise(_banded(x.a, x.b, k))
        return _let(d, lambda v: F.when(v <= k, v))

    def cut(x: Column, n: Column) -> Column:
        return F.struct(*[F.substring(x[s], n + 1, F.char_length(x[s]) - n).alias(s) for s in "ab"])

    both = F.struct(a.alias("a"), b.alias("b"))
    head = _let(both, lambda x: _let(_common(x.a, x.b), lambda n: cut(x, n)))
    back = _let(head, lambda x: F.struct(F.reverse(x.a).alias("a"), F.reverse(x.b).alias("b")))
    tail = _let(back, lambda x: _let(_common(x.a, x.b), lambda n: cut(x, n)))
    return _let(tail, stripped)


# ---- candidates ------------------------------------------------------------------------


def _segment(length: Column, i: Column, k: int) -> tuple[Column, Column]:
    """(start, size) of segment ``i`` of the ``k + 1`` even ones of a line of ``length``."""
    parts = k + 1
    extra = F.pmod(length, F.lit(parts))  # so many last segments have one character more
    size = ((length - extra) / parts).cast("int")
    before = F.greatest(i - (F.lit(parts) - extra), F.lit(0))
    return size * i + before + 1, size + F.when(i >= F.lit(parts) - extra, 1).otherwise(0)


def _segments(length: Column, k: int) -> list[tuple[Column, Column]]:
    return [_segment(length, F.lit(i), k) for i in range(k + 1)]


def _key(i: Column, length: Column, part: Column) -> Column:
    return F.xxhash64(i, length, part)


def _index_rows(k: int) -> Column:
    line, n = F.col("line"), F.col("n")
    return F.array(*[_key(F.lit(i), n, F.substring(line, p, q)) for i, (p, q) in enumerate(_segments(n, k))])


def _probe_places(k: int) -> Column:
    """Every (gap, segment, shift) at which a segment of a line of ``gap`` characters less can
    have stayed: ``i`` segments stand before it and ``k - i`` behind, each lost to an edit."""
    return F.array(
        *[
            F.struct(F.lit(gap).alias("gap"), F.lit(i).alias("i"), F.lit(shift).alias("shift"))
            for gap in range(k + 1)
            for i in range(k + 1)
            for shift in range(max(-i, gap - (k - i)), min(i, gap + (k - i)) + 1)
        ]
    )


#: above the letters' counts: an index row's segment number and whether its key is hot; of a
#: probe row whether it is for lines of its own length, and whether it is the line's index row
_SEGMENT, _IS_HOT, _IS_INDEX, _OWN_LENGTH = 56, 60, 61, 62


def _flag(condition: Column, bit: int) -> Column:
    return F.when(condition, F.lit(1 << bit)).otherwise(F.lit(0)).cast("long")


def _has(value: Column, bit: int) -> Column:
    return F.getbit(value, F.lit(bit)) == 1


def _probe(rows: DataFrame, k: int, near_chars: int) -> DataFrame:
    """(key, id2, sig2): one row for each place, so that the expression stays short."""
    places = rows.select("line", "id", "sig", "n", F.explode(_probe_places(k)).alias("at"))
    shorter = places.select("line", "id", "sig", (F.col("n") - F.col("at.gap")).alias("n"), "at").where(F.col("n") >= near_chars)
    start, size = _segment(F.col("n"), F.col("at.i"), k)
    part = F.substring("line", start + F.col("at.shift"), size)
    own = F.col("at.gap") == 0
    flags = _flag(own, _OWN_LENGTH).bitwiseOR(_flag(own & (F.col("at.shift") == 0), _IS_INDEX))
    return shorter.select(
        _key(F.col("at.i"), F.col("n"), part).alias("key"), F.col("id").alias("id2"), F.col("sig").bitwiseOR(flags).alias("sig2")
    )


def _signature(line: Column) -> Column:
    """Counts of the letters modulo 128, seven bits each."""
    out = F.lit(0).cast("long")
    for i, c in enumerate(SIGNATURE_LETTERS):
        times = (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit("")))).cast("long")
        out = out.bitwiseOR(F.shiftleft(times.bitwiseAND(F.lit(127)), 7 * i))
    return out


def _counts_apart(a: Column, b: Column) -> Column:
    """At most the sum of the differences of the letters' counts."""
    out = F.lit(0)
    for i in range(len(SIGNATURE_LETTERS)):
        x, y = (F.shiftrightunsigned(v, 7 * i).bitwiseAND(F.lit(127)) for v in (a, b))
        apart = F.abs(x - y)
        out = out + F.least(apart, F.lit(128) - apart)
    return out


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    cut = F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    return own.select("doc_id", F.xxhash64("doc_id", "text").alias("d"), cut)


def _key_of(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def _candidates(lines: DataFrame, k: int, near_chars: int, hot: int) -> DataFrame:
    """(id, id2, key, sig, sig2), written out: an index line and a probe line of one key with
    letter counts that admit ``k`` edits; of a hot key its first line and every probe line."""
    n = F.char_length("line")
    own = lines.select("line").where(n >= near_chars).withColumn("sig", _signature(F.col("line"))).distinct()
    rows = own.select("line", "sig", n.alias("n"), F.xxhash64("line").alias("id"))
    of_key = Window.partitionBy("key")
    index = rows.select(F.posexplode(_index_rows(k)).alias("segment", "key"), "id", "sig")
    index = index.select("*", F.count(F.lit(1)).over(of_key).alias("lines"), F.min("id").over(of_key).alias("least"))
    is_hot = F.col("lines") >= hot
    flags = F.shiftleft(F.col("segment").cast("long"), _SEGMENT).bitwiseOR(_flag(is_hot, _IS_HOT))
    index = index.where(~is_hot | (F.col("id") == F.col("least"))).select("key", "id", F.col("sig").bitwiseOR(flags).alias("sig"))
    probe = _probe(rows, k, near_chars)
    close = _counts_apart(F.col("sig"), F.col("sig2")) <= 2 * k
    met = index.join(probe, (index.key == probe.key) & (_has(F.col("sig"), _IS_HOT) | (_apart() & close)))
    return met.select("id", "id2", index.key, "sig", "sig2").checkpoint()


def _apart() -> Column:
    """The index line and the probe line differ, and of lines of one length this is the pair's
    one order."""
    return (F.col("id") != F.col("id2")) & (~_has(F.col("sig2"), _OWN_LENGTH) | (F.col("id") < F.col("id2")))


def _first_segment(a: Column, b: Column, k: int) -> Column:
    """The first segment of ``a`` that stands in the longer line ``b`` at an admissible place."""
    n = F.char_length(a)
    gap = F.char_length(b) - n
    out = F.lit(None).cast("int")
    for i in range(k, -1, -1):
        start, size = _segment(n, F.lit(i), k)
        part, found = F.substring(a, start, size), F.lit(False)
        for shift in range(-i, 2 * k + 1):
            admitted = (gap - (k - i) <= shift) & (gap + (k - i) >= shift) if shift <= i else F.lit(False)
            found = found | (admitted & (F.substring(b, start + shift, size) == part))
        out = F.when(found, F.lit(i)).otherwise(out)
    return out


def _wanted(lines: DataFrame, ids: DataFrame, near_chars: int) -> DataFrame:
    """(id, line) of the lines with one of the ``ids`` (each once in the filter), written out."""
    long_lines = lines.select("line").where(F.char_length("line") >= near_chars)
    named = long_lines.withColumn("id", F.xxhash64("line"))
    return named.where(may_contain(bloom(ids.distinct(), "id"), F.col("id"))).distinct().checkpoint()


def _pair_links(met: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(a, b, distance, counts) of the candidate pairs within ``k`` edits, as md5 digests;
    ``counts`` says that the pair's first common segment is no hot key."""
    hot = _has(F.col("sig"), _IS_HOT)
    close = _counts_apart(F.col("sig"), F.col("sig2")) <= 2 * k
    segment = F.expr(f"shiftleft(1, cast(shiftright(sig, {_SEGMENT}) & 15 as int))")
    pairs = met.where(_apart() & close).groupBy("id", "id2").agg(F.bit_or(F.when(hot, 0).otherwise(segment)).alias("segments"))
    first = pairs.join(wanted.select("id", F.col("line").alias("line_a")), "id")
    both = first.join(wanted.select(F.col("id").alias("id2"), F.col("line").alias("line_b")), "id2")
    a, b = F.col("line_a"), F.col("line_b")
    verified = both.withColumn("distance", edit_distance_within(a, b, k)).where("distance is not null")
    counts = F.coalesce(F.getbit(F.col("segments"), _first_segment(a, b, k)) == 1, F.lit(False))
    return verified.select(_key_of(a).alias("a"), _key_of(b).alias("b"), "distance", counts.alias("counts")).checkpoint()


def near_links(lines: DataFrame, threshold: int = THRESHOLD, near_chars: int = NEAR_CHARS, hot: int = HOT) -> DataFrame:
    """``(a, b, distance)`` for the pairs of different lines (column ``line``) of at least
    ``near_chars`` characters within ``threshold`` edits; ``a`` and ``b`` are md5 digests.  Of
    the pairs whose common segments are all hot keys, those with a key's first line."""
    met = _candidates(lines, threshold, near_chars, hot)
    wanted = _wanted(lines, met.select("id").union(met.select("id2")), near_chars)
    return _pair_links(met, wanted, threshold).select("a", "b", "distance")


# ---- hot keys --------------------------------------------------------------------------


def _hot_rows(met: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, segment, id, sig, own, indexed, line, name): the lines of each hot key once, with
    their md5 ``name``; ``own`` of them probe lines of their own length, ``indexed`` are index
    lines.  Written out."""
    hot = met.where(_has(F.col("sig"), _IS_HOT))
    once = hot.groupBy("key", F.expr(f"cast(shiftright(sig, {_SEGMENT}) & 15 as int)").alias("segment"), F.col("id2").alias("id")).agg(
        F.bit_or("sig2").alias("sig2")
    )
    rows = once.join(wanted, "id")
    letters = F.col("sig2").bitwiseAND(F.lit((1 << _SEGMENT) - 1)).alias("sig")
    own, indexed = _has(F.col("sig2"), _OWN_LENGTH).alias("own"), _has(F.col("sig2"), _IS_INDEX).alias("indexed")
    return rows.select("key", "segment", "id", letters, own, indexed, "line", _key_of(F.col("line")).alias("name")).checkpoint()


def _dealt(rows: DataFrame, sizes: DataFrame, fields: list[str]) -> DataFrame:
    """``rows`` of each key and side gathered in blocks of about ``BLOCK`` lines."""
    blocks = F.when(F.col("outside"), F.col("outer")).otherwise(F.col("inner"))
    block = F.pmod(F.xxhash64("id", F.lit("block")), blocks).cast("int").alias("block")
    return rows.join(sizes, "key").groupBy("key", "segment", "outside", block, "outer_blocks", "inner_blocks").agg(
        F.collect_list(F.struct(*fields)).alias("lines")
    )


def _block_links(rows: DataFrame, k: int, match) -> DataFrame:
    """(name, links, other): for each line of each pair of blocks the number of lines of the
    other block that it matches, and one of them.  Rows with ``outside`` false are compared
    with those outside only."""
    count = lambda outside, only: F.ceil(F.count_if((F.col("outside") == outside) & only) / BLOCK).cast("int")
    any_, index = F.lit(True), F.col("indexed")
    sizes = rows.groupBy("key").agg(
        *[count(o, only).alias(n) for n, o, only in (("outer_x", True, any_), ("inner_x", False, any_), ("outer_y", True, index), ("inner_y", False, index))]
    )
    fields = ["id", "sig", "own", "line", "name", *[c for c in ("root",) if c in rows.columns]]
    to = lambda side: sizes.select("key", F.col(f"outer_{side}").alias("outer"), F.col(f"inner_{side}").alias("inner"), F.col("outer_y").alias("outer_blocks"), F.col("inner_y").alias("inner_blocks"))
    x = _dealt(rows, to("x"), fields).withColumnRenamed("lines", "xs")  # blocks of probe lines
    y = _dealt(rows.where("indexed"), to("y"), fields).select("key", F.struct("outside", "block").alias("y"), F.col("lines").alias("ys"))
    numbers = lambda n, outside: F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.struct(F.lit(outside).alias("outside"), i.alias("block")))
    outer, inner = numbers(F.col("outer_blocks"), True), numbers(F.col("inner_blocks"), False)
    meets = F.when(F.col("outside"), F.concat(outer, inner)).otherwise(outer)
    cells = x.select("key", "segment", "xs", F.struct("outside", "block").alias("x"), F.explode(meets).alias("y")).join(y, ["key", "y"])
    # small rows with much to do: a number of tasks that adaptive planning does not put together
    cells = cells.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "x", "y")
    hits = F.transform("xs", lambda a: F.transform("ys", lambda b: match(a, b, F.col("segment"))))

    def seen(own: Column, theirs: Column, found: Column) -> Column:
        return F.struct(own["name"].alias("name"), F.size(F.filter(found, lambda h: h)).alias("links"), F.get(theirs, F.array_position(found, True).cast("int") - 1)["name"].alias("other"))

    def both(found: Column) -> Column:
        of_x = F.transform("xs", lambda a, i: seen(a, F.col("ys"), F.get(found, i)))
        of_y = F.transform("ys", lambda b, j: seen(b, F.col("xs"), F.transform(found, lambda row: F.get(row, j))))
        return F.concat(of_x, of_y)

    # bound first: as a column it would be computed again for every element
    return cells.select(F.inline(_let(hits, both))).where("links > 0")


def _match(k: int, counting: bool):
    """Whether an index line ``b`` is a link of a probe line ``a``; when ``counting``, one that
    counts in this segment, else one of another class."""

    def match(a: Column, b: Column, segment: Column) -> Column:
        ordered = (F.char_length(a["line"]) > F.char_length(b["line"])) | (a["own"] & (b["id"] < a["id"]))
        likely = (a["id"] != b["id"]) & ordered & (_counts_apart(a["sig"], b["sig"]) <= 2 * k)
        here = F.coalesce(_first_segment(b["line"], a["line"], k) == segment, F.lit(False)) if counting else a["root"] != b["root"]
        return F.when(likely & here, edit_distance_within(b["line"], a["line"], k).isNotNull()).otherwise(F.lit(False))

    return match


def _classes(links: DataFrame, hot_rows: DataFrame, k: int) -> DataFrame:
    """(node, root) after all links, also those within hot keys."""
    links = links.select("a", "b")
    while True:
        roots = connected_components(links).checkpoint()
        named = hot_rows.join(roots.select(F.col("node").alias("name"), "root"), "name", "left").withColumn("root", F.coalesce("root", "name"))
        state = named.groupBy("key").agg(F.min(F.struct("id", "root")).getField("root").alias("first"), F.min("root").alias("low"), F.max("root").alias("high"))
        several = state.where("low < high").select("key", "first")
        open_rows = named.join(several, "key").withColumn("outside", F.col("root") != F.col("first")).drop("first").checkpoint()
        if open_rows.isEmpty():
            return roots
        found = _block_links(open_rows, k, _match(k, False)).select(F.col("name").alias("a"), F.col("other").alias("b")).checkpoint()
        if found.isEmpty():
            return roots
        links = links.union(found)


def line_classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: int = THRESHOLD,
    min_chars: int = MIN_CHARS,
    near_chars: int = NEAR_CHARS,
    hot: int = HOT,
    count_links: bool = True,
) -> DataFrame:
    """One row per line that is not blank: doc_id, d (hash of the row), line_no, first (place
    of the class's first line), links (different lines within the threshold; null without
    ``count_links``) and kept (the first of its class, or shorter than ``min_chars``)."""
    spark = docs.sparkSession
    lines = _lines(docs, doc_id, text).where(F.trim("line") != "")
    path = scratch_path(spark, "lines")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "d", "line_no")
    short = (F.char_length("line") < min_chars).alias("short")
    lines.select(_key_of(F.col("line")).alias("key"), place.alias("place"), short).write.parquet(path)
    places = spark.read.parquet(path)

    near_chars = max(near_chars, min_chars, threshold + 1)
    met = _candidates(lines, threshold, near_chars, hot)
    wanted = _wanted(lines, met.select("id").union(met.select("id2")), near_chars)
    links = _pair_links(met, wanted, threshold)
    hot_rows = _hot_rows(met, wanted)
    counted = links.where("counts")
    degree = counted.select(F.col("a").alias("key")).union(counted.select(F.col("b").alias("key"))).groupBy("key").agg(F.count(F.lit(1)).alias("links"))
    pairs = links.select("a", "b")
    if not hot_rows.isEmpty() and count_links:
        within = _block_links(hot_rows.withColumn("outside", F.lit(True)), threshold, _match(threshold, True)).checkpoint()
        pairs = pairs.union(within.select(F.col("name").alias("a"), F.col("other").alias("b")))
        degree = degree.union(within.select(F.col("name").alias("key"), F.col("links").cast("long"))).groupBy("key").agg(F.sum("links").alias("links"))
    roots = _classes(pairs, hot_rows, threshold).withColumnRenamed("node", "key")
    named = places.groupBy("key").agg(F.min("place").alias("first")).join(roots, "key", "left").join(degree, "key", "left")
    total = F.coalesce("links", F.lit(0).cast("long")) if count_links else F.lit(None).cast("long")
    named = named.select("key", "first", F.coalesce("root", "key").alias("root"), total.alias("links"))
    firsts = named.groupBy("root").agg(F.min("first").alias("first"))
    classes = named.drop("first").join(firsts, "root").select("key", "first", "links")
    kept = (F.col("place") == F.col("first")) | F.col("short")
    return places.join(classes, "key").select("place.doc_id", "place.d", "place.line_no", "first", "links", kept.alias("kept"))


def dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: int = THRESHOLD,
    min_chars: int = MIN_CHARS,
    near_chars: int = NEAR_CHARS,
    hot: int = HOT,
) -> DataFrame:
    """``docs`` without the lines that occur before; all rows and columns stay."""
    spark, columns = docs.sparkSession, docs.columns
    inner = [f"c{i}" for i in range(len(columns))]  # columns may have any names
    own = docs.toDF(*inner)
    id_at, text_at = inner[columns.index(doc_id)], inner[columns.index(text)]
    own = own.withColumn("_d", F.xxhash64(id_at, text_at))
    path = scratch_path(spark, "repeats")
    (
        line_classes(own, id_at, text_at, threshold, min_chars, near_chars, hot, count_links=False)
        .where("not kept")
        .select("doc_id", "d", "line_no")
        .distinct()
        .groupBy("doc_id", "d")  # a 64-bit hash alone would mix documents up
        .agg(F.collect_list("line_no").alias("_drop"))  # the lines of one document
        .write.parquet(path)
    )
    drop = spark.read.parquet(path)
    touched = F.coalesce(may_contain(bloom(drop, "d"), F.col("_d")), F.lit(False))
    marked = own.withColumn("_touched", touched)
    lines = F.transform(F.split(text_at, "\n", -1), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    left = F.filter(lines, lambda x: ~F.array_contains(F.col("_drop"), x.i))
    shorter = F.array_join(F.transform(left, lambda x: x.line), "\n")
    same = (F.col("_d") == F.col("d")) & F.col(id_at).eqNullSafe(F.col("doc_id"))
    mended = marked.where("_touched").join(drop, same, "left")
    mended = mended.withColumn(text_at, F.when(F.col("_drop").isNull(), F.col(text_at)).otherwise(shorter))
    return marked.where("not _touched").select(*inner).union(mended.select(*inner)).toDF(*columns)
