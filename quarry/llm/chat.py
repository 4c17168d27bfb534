"""Preference formatting (operator 5), DataFrame operations only.

Input: turns of chosen and rejected conversations, ``(pair_id, side, turn, role, text)``
with side ``chosen`` or ``rejected``.  The longest common prefix of turns (equal role and
text) is rendered once as the prompt; what follows on either side is a completion with a
mask: the spans (start, length in characters of the completion) of assistant answers with
their end mark, the only characters a loss counts.

A turn is rendered as ``<|role|>`` + line break + text + ``<|end|>`` + line break.

One conversation is the largest group: its turns are gathered by pair, as the output row
holds them anyway.  Conversations with equal turns do not meet, so a very common one costs
no more than any other.

Edge cases: null role or text are equal to null and rendered as empty; turns of one number
are ordered by role and text; a side without turns has an empty completion; equal
conversations give empty completions (``usable`` false); rows with null pair_id or an
unknown side are left out; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ANSWER = "assistant"
END = "<|end|>\n"


def _head(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"))


def _render(turn: Column) -> Column:
    return F.concat(_head(turn.role), F.coalesce(turn.text, F.lit("")), F.lit(END))


def _same(x: Column, y: Column) -> Column:
    """Both sides have this turn, with equal role and text."""
    both = x.isNotNull() & y.isNotNull()
    return both & x.role.eqNullSafe(y.role) & x.text.eqNullSafe(y.text)


def _completion(turns: Column, skip: Column) -> Column:
    rest = F.slice(turns, skip + 1, F.greatest(F.size(turns) - skip, F.lit(0)))
    return F.array_join(F.transform(rest, _render), "")


def _mask(turns: Column, skip: Column, prompt: Column) -> Column:
    rest = F.filter(F.slice(turns, skip + 1, F.greatest(F.size(turns) - skip, F.lit(0))), lambda t: t.role == ANSWER)
    span = lambda t: F.struct(
        (t["at"] + F.char_length(_head(t.role)) - F.char_length(prompt)).alias("start"),
        (F.char_length(F.coalesce(t.text, F.lit(""))) + len(END)).cast("long").alias("length"),
    )
    return F.transform(rest, span)


def preferences(turns: DataFrame) -> DataFrame:
    """One row per pair: pair_id, prompt_turns, prompt, chosen, rejected, chosen_mask,
    rejected_mask, usable."""
    rows = turns.select("pair_id", "side", "turn", "role", "text").where("pair_id is not null and side in ('chosen', 'rejected')")
    order = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")
    size = F.char_length(_head(F.col("role"))) + F.char_length(F.coalesce("text", F.lit(""))) + len(END)
    placed = rows.withColumn("pos", F.row_number().over(order)).withColumn("at", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size)
    turn = F.struct("pos", "role", "text", "at")
    sides = placed.groupBy("pair_id").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("side") == s, turn))).alias(s) for s in ("chosen", "rejected")]
    )
    equal = F.zip_with("chosen", "rejected", _same)
    first_other = F.array_position(equal, F.lit(False))
    shared = F.when(first_other > 0, first_other - 1).otherwise(F.size(equal)).cast("int")
    skip, prompt = F.col("prompt_turns"), F.col("prompt")
    return (
        sides.withColumn("prompt_turns", shared)
        .withColumn("prompt", F.array_join(F.transform(F.slice("chosen", F.lit(1), skip), _render), ""))
        .select(
            "pair_id",
            "prompt_turns",
            "prompt",
            _completion(F.col("chosen"), skip).alias("chosen"),
            _completion(F.col("rejected"), skip).alias("rejected"),
            _mask(F.col("chosen"), skip, prompt).alias("chosen_mask"),
            _mask(F.col("rejected"), skip, prompt).alias("rejected_mask"),
        )
        .withColumn("usable", F.col("chosen") != F.col("rejected"))
    )


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Preference turns from plain conversations: chosen is a conversation as it is, rejected
    has the last answer of its neighbour (``conv_id`` with the last bit flipped) in place of
    its own last answer and what follows; without such a neighbour it ends there."""
    rows = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text").where("pair_id is not null")
    by_answer = Window.partitionBy("pair_id")
    last = F.max(F.when(F.col("role") == ANSWER, F.col("turn"))).over(by_answer)
    marked = rows.withColumn("last", last)
    chosen = marked.select("pair_id", F.lit("chosen").alias("side"), "turn", "role", "text")
    kept = marked.where("last is null or turn < last").select("pair_id", F.lit("rejected").alias("side"), "turn", "role", "text")
    answers = marked.where((F.col("turn") == F.col("last")) & (F.col("role") == ANSWER))
    swapped = answers.select(F.col("pair_id").bitwiseXOR(F.lit(1).cast("long")).alias("pair_id"), "role", "text")
    own_last = marked.where("last is not null").select("pair_id", "last").distinct()
    other = swapped.join(own_last, "pair_id").select("pair_id", F.lit("rejected").alias("side"), F.col("last").alias("turn"), "role", "text")
    return chosen.unionByName(kept).unionByName(other)
