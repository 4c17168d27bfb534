"""Word counts, regex-match counts and dictionary substitution.

Counting is ``explode`` + ``groupBy().count()``: Catalyst aggregates partially on
the map side, so a frequent word costs one row per map task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import ALL_DIGITS, char_class, jvm_trim
from quarry.plans.strategies import broadcast_if_small, is_small

#: bounds of a dictionary that is looked up inside each row
LOOKUP_ROWS, LOOKUP_BYTES = 100_000, 16 << 20


def count_tokens(df: DataFrame, token_array: Column, alias: str = "word") -> DataFrame:
    """Count every element of ``token_array`` over all rows."""
    # explode_outer + null filter: a plain explode makes Catalyst infer a
    # size(tokens) > 0 filter that splits every text a second time
    return (
        df.select(F.explode_outer(token_array).alias(alias))
        .where(F.col(alias).isNotNull())
        .groupBy(alias)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def word_count(df: DataFrame, col: str, pattern: str = "[ \n]", lower: bool = True) -> DataFrame:
    """Word count with map-side combine (A07/A08): split, drop empties, count."""
    c = F.lower(F.col(col)) if lower else F.col(col)
    return _count_words(df.select(F.explode_outer(F.split(c, pattern)).alias("word")))


def _count_words(words: DataFrame) -> DataFrame:
    return words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_filtered(
    df: DataFrame, col: str, illegal_chars: str, stop_words: Iterable[str]
) -> DataFrame:
    """Word count split on ``illegal_chars`` + space, then JVM-trimmed and lower-cased
    token by token, without stop words or empty tokens (A09, F07).

    The text is split as it stands (a separator may be an upper-case letter), and
    lower-casing sees one token at a time (a final sigma depends on its word).
    """
    raw = df.select(F.explode_outer(F.split(F.col(col), char_class(illegal_chars + " "))).alias("raw"))
    words = raw.where(F.col("raw") != "").select(F.lower(jvm_trim("raw")).alias("word"))
    stop = sorted(set(stop_words))
    return _count_words(words.where(~F.col("word").isin(stop)) if stop else words)


def pattern_frequency(df: DataFrame, col: str, pattern: str, alias: str = "match") -> DataFrame:
    """Count every regex match (one row per match, A10)."""
    return count_tokens(df, F.regexp_extract_all(F.col(col), F.lit(pattern), 0), alias=alias)


def dictionary_substitute(
    docs: DataFrame,
    id_col: str,
    token_array: Column,
    dictionary: DataFrame,
    sep: str = "#",
    max_broadcast_rows: int = 1_000_000,
    lookup_rows: int = 0,
) -> DataFrame:
    """Replace tokens by their canonical word.

    ``dictionary`` has ``(word, canonical, entry_order)``; for a word listed twice the
    entry with the smallest ``entry_order`` wins.  Unmatched all-digit tokens are
    dropped, other unmatched tokens kept; tokens are re-joined in their original
    order, each prefixed by ``sep``.

    A dictionary of ``lookup_rows`` words (``LOOKUP_ROWS`` is a sound bound) and ``LOOKUP_BYTES``
    bytes at most is looked up inside each row, and no token is shuffled or sorted.  For a larger
    one, and by default, the tokens become rows and are joined.  Each row is regrouped on a number of its own then (rows may share an id), so a
    group is never larger than the document it came from.  The compact documents are dealt by
    that number first: the broadcast join keeps the partitioning, so regrouping the tokens needs
    no exchange.
    """
    first = (
        dictionary.groupBy("word")
        .agg(F.min_by("canonical", "entry_order").alias("canonical"))
    )
    if lookup_rows and is_small(first, lookup_rows, LOOKUP_BYTES):
        return _substitute_in_rows(docs, id_col, token_array, first, sep)
    rows = docs.select(id_col, token_array.alias("_toks"), F.monotonically_increasing_id().alias("_row"))
    dealt = rows.repartition("_row")
    toks = dealt.select(id_col, "_row", F.posexplode_outer("_toks").alias("pos", "word"))
    joined = toks.join(broadcast_if_small(first, max_rows=max_broadcast_rows), "word", "left")
    keep = F.col("canonical").isNotNull() | (
        F.col("word").isNotNull() & ~F.col("word").rlike(ALL_DIGITS)
    )
    item = F.when(keep, F.struct(F.col("pos"), F.coalesce("canonical", "word").alias("w")))
    regrouped = joined.groupBy("_row", id_col).agg(F.array_sort(F.collect_list(item)).alias("_ws"))
    text = F.concat(F.lit(sep), F.array_join(F.transform("_ws", lambda s: s["w"]), sep))
    # a document whose every token was dropped keeps its row, with an empty text
    return regrouped.select(
        id_col, F.when(F.size("_ws") > 0, text).otherwise(F.lit("")).alias("substituted")
    )


def _substitute_in_rows(docs: DataFrame, id_col: str, token_array: Column, first: DataFrame, sep: str) -> DataFrame:
    """``dictionary_substitute`` with the dictionary as one value: an array of small maps, a word
    in the map that its hash gives (Spark reads a map from front to back)."""
    n = max(1, 2 * first.count())
    place = lambda w: F.pmod(F.xxhash64(w), F.lit(n)).cast("int")
    entries = first.where("word is not null").groupBy(place(F.col("word")).alias("slot")).agg(
        F.collect_list(F.struct("word", "canonical")).alias("e")
    )
    slots = first.sparkSession.range(n).select(F.col("id").cast("int").alias("slot")).join(entries, "slot", "left")
    ordered = F.array_sort(F.collect_list(F.struct("slot", "e")))
    table = slots.agg(F.transform(ordered, lambda s: F.map_from_entries(s["e"])).alias("maps")).scalar()
    rows = docs.select(id_col, token_array.alias("_toks"), table.alias("_maps"))

    def replaced(w: Column) -> Column:
        known = F.try_element_at(F.get("_maps", place(w)), w)
        return F.coalesce(known, F.when(~w.rlike(ALL_DIGITS), w))

    words = rows.select(id_col, F.array_compact(F.transform("_toks", replaced)).alias("_ws"))
    text = F.concat(F.lit(sep), F.array_join("_ws", sep))
    return words.select(id_col, F.when(F.size("_ws") > 0, text).otherwise(F.lit("")).alias("substituted"))
