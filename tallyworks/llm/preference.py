"""Preference pairs for training: the common start of two conversations once, then both completions.

A pair is two conversations, chosen and rejected. Their longest common prefix of turns (role and text
equal) is rendered once as the prompt; what follows in each is its completion, with a mask that trains on
the words of one role only. A mask is a list of run lengths in characters, untrained and trained in turn.

One conversation becomes one row, as its rendering does; turns are gathered once per conversation.

Defined cases: turns are ordered by number, then role, then text, nulls first; a null role or text is an empty one; equal turns
that come twice stay twice; equal conversations give two empty completions; if one conversation is the
start of the other, its completion is empty; a conversation id that is null is a conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, AFTER_ROLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def gathered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turns``: one row per conversation with its turns in order as role and text."""
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = turns.select(F.col(conv).alias("conv"), one.alias("one")).groupBy("conv").agg(F.sort_array(F.collect_list("one")).alias("all"))
    return rows.select("conv", F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(AFTER_ROLE))


def _tail(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(CLOSE))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _tail(t))), "")


def mask_runs(turns: Column, trained_role: str = "assistant") -> Column:
    """Run lengths of the rendering, untrained and trained in turn, two per turn."""

    def runs(t: Column) -> Column:
        head, tail = F.char_length(_head(t)), F.char_length(_tail(t))
        trained = t["role"] == trained_role
        return F.array(F.when(trained, head).otherwise(head + tail), F.when(trained, tail).otherwise(F.lit(0)))

    return F.flatten(F.transform(turns, runs))


def common_turns(left: Column, right: Column) -> Column:
    """Number of turns that two lists of turns share from the start."""
    shorter = F.least(F.size(left), F.size(right))
    differs = F.filter(
        F.transform(F.arrays_zip(left.alias("a"), right.alias("b")), lambda p, i: F.when(~p["a"].eqNullSafe(p["b"]), i)), lambda i: i.isNotNull()
    )
    return F.least(shorter, F.coalesce(F.array_min(differs), shorter))


OUTPUTS = ["prompt_turns", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask"]


def preference_rows(pairs: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """For rows with arrays ``chosen`` and ``rejected`` of role and text: prompt, completions and masks.

    Other columns are kept in front, but for those that bear the name of a result.
    """
    keep = [c for c in pairs.columns if c not in OUTPUTS]
    inner = [f"_k{i}" for i in range(len(keep))]
    named = pairs.select(*[F.col(c).alias(k) for c, k in zip(keep, inner)], F.col("chosen").alias("_a"), F.col("rejected").alias("_b"))
    counted = named.withColumn("_n", common_turns(F.col("_a"), F.col("_b")))
    rest = lambda c: F.slice(F.col(c), F.col("_n") + 1, F.size(c))
    split = counted.withColumn("_p", F.slice("_a", F.lit(1), F.col("_n"))).withColumn("_c", rest("_a")).withColumn("_r", rest("_b"))
    return split.select(
        *[F.col(k).alias(c) for c, k in zip(keep, inner)],
        F.col("_n").cast("bigint").alias("prompt_turns"),
        rendered(F.col("_p")).alias("prompt"),
        rendered(F.col("_c")).alias("chosen"),
        mask_runs(F.col("_c"), trained_role).alias("chosen_mask"),
        rendered(F.col("_r")).alias("rejected"),
        mask_runs(F.col("_r"), trained_role).alias("rejected_mask"),
    )


def swapped_replies(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                    trained_role: str = "assistant") -> DataFrame:
    """Pairs out of plain conversations: each up to its last reply is chosen; rejected is the same with
    the last reply of its neighbour (ids 2k and 2k + 1) in that place.

    A conversation without a reply, or whose neighbour has none, is a pair of equal conversations.
    """
    rows = gathered(turns, conv, turn, role, text)
    last = F.coalesce(F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == trained_role, i + 1))), F.size("turns"))
    rows = rows.withColumn("_last", last).select("conv", F.slice("turns", F.lit(1), F.col("_last")).alias("chosen"))
    end = F.element_at("chosen", -1)
    replies = rows.where(end["role"] == trained_role).select(F.col("conv").bitwiseXOR(F.lit(1)).alias("_of"), end.alias("_reply"))
    joined = rows.join(replies, rows["conv"] == replies["_of"], "left")
    swap = F.col("_reply").isNotNull() & (end["role"] == trained_role)
    other = F.concat(F.slice("chosen", F.lit(1), F.size("chosen") - 1), F.array("_reply"))
    return joined.select(F.col("conv"), "chosen", F.when(swap, other).otherwise(F.col("chosen")).alias("rejected"))
