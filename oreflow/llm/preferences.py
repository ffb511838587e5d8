"""Preference pairs for training: a common prompt, rendered once, and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a turn is written. Openings of such marks inside texts are broken by a space.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TURNS = "array<struct<role:string,text:string>>"


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (role, text) in order, from rows of conv_id, turn, role and text.

    Rows that repeat each other wholly count once; equal turn numbers are ordered by role and text; a
    null turn number comes first, a null role is `unknown`, a null text empty. Rows with a null conv_id
    belong to no conversation and are left out.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    own = conversations.where("conv_id IS NOT NULL").select("conv_id", row.alias("row"))
    ordered = own.groupBy("conv_id").agg(F.array_distinct(F.sort_array(F.collect_list("row"))).alias("rows"))
    return ordered.select("conv_id", F.transform("rows", lambda x: F.struct(x.role.alias("role"), x.text.alias("text"))).alias("turns"))


def swapped(turns: DataFrame) -> DataFrame:
    """pair_id, chosen and rejected for each conversation that has a partner with an answer.

    Conversations 2n and 2n + 1 are partners. Rejected is the conversation with its last answer of the
    assistant replaced by the partner's last answer; what followed the answer goes. A conversation
    without an answer of its own, or whose partner has none, gives no pair.
    """
    places = F.filter(F.transform("turns", lambda x, i: F.when(x.role == "assistant", i)), lambda i: i.isNotNull())
    placed = turns.select("conv_id", "turns", F.array_max(places).alias("at")).where("at IS NOT NULL")
    answers = placed.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.expr("turns[at].text").alias("answer"))
    answer = F.array(F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("text")))
    both = placed.join(answers, "conv_id")
    return both.select(F.col("conv_id").alias("pair_id"), F.expr("slice(turns, 1, at + 1)").alias("chosen"), F.concat(F.expr("slice(turns, 1, at)"), answer).alias("rejected"))


def rendered(turn: Column) -> Column:
    plain = lambda x: F.replace(x, F.lit(OPEN), F.lit("< |"))
    return F.concat(F.lit(OPEN), plain(turn.role), F.lit(CLOSE), plain(turn.text), F.lit(END))


def _text(turns: str) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def _mask(turns: str) -> Column:
    """Spans (start, end) of a completion to learn from, in code points: what the assistant says, with its end mark."""
    parts = F.transform(turns, lambda x: F.struct(x.role.alias("role"), F.char_length(rendered(x)).alias("size"), F.char_length(F.replace(x.role, F.lit(OPEN), F.lit("< |"))).alias("name_size")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    head = len(OPEN) + len(CLOSE)
    step = lambda acc, x: F.struct(
        (acc.at + x.size).alias("at"),
        F.when(x.role == "assistant", F.concat(acc.spans, F.array(F.struct((acc.at + head + x["name_size"]).alias("start"), (acc.at + x.size).alias("end"))))).otherwise(acc.spans).alias("spans"),
    )
    return F.aggregate(parts, start, step, lambda acc: acc.spans)


def preference_rows(pairs: DataFrame, id_col: str = "pair_id") -> DataFrame:
    """Prompt, completions and masks of each pair of conversations (`chosen` and `rejected`, arrays of role and text).

    n_prompt_turns is the length of the longest common prefix of turns, equal in role and text. The
    prefix is rendered once as `prompt`; what follows it on either side as `chosen` and `rejected`, each
    with the spans that loss is taken on. If one side is a prefix of the other its completion is empty;
    equal sides leave both empty, which `identical` tells. A null side is an empty conversation. Rows
    stand for themselves, so repeated or null ids give rows alike; further columns are ignored.
    """
    none = F.array().cast(TURNS)
    sides = pairs.select(F.col(id_col).alias("pair_id"), F.coalesce("chosen", none).alias("a"), F.coalesce("rejected", none).alias("b"))
    shorter = F.least(F.size("a"), F.size("b"))
    same = F.zip_with(F.expr("slice(a, 1, least(size(a), size(b)))"), F.expr("slice(b, 1, least(size(a), size(b)))"), lambda x, y: x.role.eqNullSafe(y.role) & x.text.eqNullSafe(y.text))
    differs = F.array_position(same, F.lit(False))
    split = sides.select("pair_id", "a", "b", F.when(differs > 0, differs - 1).otherwise(shorter).cast("int").alias("n"))
    parts = split.select(
        "pair_id", "n", F.expr("slice(a, 1, n)").alias("prefix"), F.expr("slice(a, n + 1, size(a))").alias("more_a"), F.expr("slice(b, n + 1, size(b))").alias("more_b")
    )
    return parts.select(
        "pair_id",
        F.col("n").cast("long").alias("n_prompt_turns"),
        _text("prefix").alias("prompt"),
        _text("more_a").alias("chosen"),
        _text("more_b").alias("rejected"),
        _mask("more_a").alias("chosen_mask"),
        _mask("more_b").alias("rejected_mask"),
        ((F.size("more_a") == 0) & (F.size("more_b") == 0)).alias("identical"),
    )
