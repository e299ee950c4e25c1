"""Preference pairs for training: a prompt rendered once, and two completions with masks.

The longest common prefix of turns of a chosen and a rejected conversation is the prompt; what follows in each is
its completion. A mask holds the spans of characters of a completion to learn from: the texts of its assistant
turns, each with the mark that ends it. All of it is DataFrame functions over one row per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>"


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"))


def _body(turn: Column) -> Column:
    """A text that contains the start of a mark could pose as a turn, so its marks are opened up."""
    return F.concat(F.replace(F.coalesce(turn["text"], F.lit("")), F.lit("<|"), F.lit("< |")), F.lit(END))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t), F.lit("\n"))), "")


def _mask(turns: Column) -> Column:
    """Spans (from, until) of the assistant's texts in the rendered turns."""

    def add(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(_head(turn))
        end = start + F.length(_body(turn))
        own = F.when(turn["role"] == "assistant", F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(none)
        return F.struct((end + 1).alias("at"), F.concat(state["spans"], own).alias("spans"))

    none = F.expr("cast(array() as array<struct<start: int, end: int>>)")
    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda s: s["spans"])


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id and turns (array of role, text) in order of turn.

    Repeated rows count once; rows that share a turn's number are ordered by role and text; a null turn comes last.
    Rows without conv_id belong to no conversation and are left out.
    """
    row = F.struct(F.col("turn").isNull().alias("late"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    all_turns = F.array_sort(F.collect_set(row))
    plain = F.transform(all_turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return turns.where("conv_id is not null").groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(plain.alias("turns"))


def preference_pairs(pairs: DataFrame) -> DataFrame:
    """Adds n_common, prompt, chosen_text, chosen_mask, rejected_text and rejected_mask to rows of chosen and rejected.

    Both are arrays of (role, text); null is no turns. Turns are common if role and text are equal, nulls included.
    If one is the other's prefix, its completion is empty. Columns of ``pairs`` with these names are replaced.
    """
    empty = F.expr("cast(array() as array<struct<role: string, text: string>>)")
    pairs = pairs.withColumns({c: F.coalesce(c, empty) for c in ("chosen", "rejected")})
    both = F.least(F.size("chosen"), F.size("rejected"))
    differs = F.zip_with("chosen", "rejected", lambda a, b: ~a.eqNullSafe(b))
    first = F.array_position(F.slice(differs, 1, both), True)
    pairs = pairs.withColumn("n_common", F.when(first > 0, first - 1).otherwise(both).cast("int"))
    rest = {c: F.slice(c, F.col("n_common") + 1, F.size(c) + 1) for c in ("chosen", "rejected")}
    return pairs.withColumns(
        {"prompt": _render(F.slice("chosen", F.lit(1), F.col("n_common")))}
        | {f"{c}_text": _render(r) for c, r in rest.items()}
        | {f"{c}_mask": _mask(r) for c, r in rest.items()}
    )


def mismatched(conversations: DataFrame) -> DataFrame:
    """conv_id, chosen and rejected: each conversation against itself with the last turn of its neighbour.

    The neighbour has the id that differs in the lowest bit; without one, the rejected side just lacks the last turn.
    """
    last = conversations.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.slice("turns", -1, 1).alias("last"))
    joined = conversations.join(last, "conv_id", "left")
    none = F.expr("cast(array() as array<struct<role: string, text: string>>)")
    head = F.slice("turns", F.lit(1), F.size("turns") - 1)
    return joined.select("conv_id", F.col("turns").alias("chosen"), F.concat(head, F.coalesce("last", none)).alias("rejected"))
