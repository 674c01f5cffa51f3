"""Preference formatting: one prompt and two masked completions per pair of conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, TURN, CLOSE = "<|", "|>\n", "<|end|>\n"
LEARNT = "assistant"


def _gathered(turns: DataFrame, key: str, name: str) -> DataFrame:
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.where(F.col("conv_id").isNotNull()).groupBy(F.col("conv_id").alias(key)).agg(
        F.sort_array(F.collect_list(turn)).alias(name)
    )


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(TURN))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(CLOSE))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _mask(turns: Column, learnt: str) -> Column:
    """Code-point spans, end exclusive, of what the learnt role says, with the closing marker."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(held: Column, turn: Column) -> Column:
        at = held["at"] + F.char_length(_head(turn))
        end = at + F.char_length(_body(turn))
        said = F.array(F.struct(at.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(turn["role"] == learnt, F.concat(held["spans"], said)).otherwise(held["spans"]).alias("spans"),
        )

    return F.aggregate(turns, start, step, lambda held: held["spans"])


def format_preferences(turns: DataFrame, pairs: DataFrame, learnt: str = LEARNT) -> DataFrame:
    """pair_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask per pair.

    ``turns`` has conv_id, turn, role, text; ``pairs`` has pair_id, chosen_id, rejected_id.  The
    prompt is the longest common prefix of turns, equal in role and text, rendered once; each
    completion is the rest of its conversation, with the spans that loss applies to (what the
    ``learnt`` role says there).  Turns go by turn number, then role and text; a null turn comes
    first, null roles and texts are empty, turns without a conv_id belong to none.  A pair that
    names a conversation without turns is left out; if one conversation is a prefix of the
    other, or equal to it, its completion is empty and its mask has no span.

    A conversation becomes one string, so it must fit in one row as any document does; nothing
    larger than a conversation is gathered.
    """
    both = (
        pairs.select("pair_id", "chosen_id", "rejected_id")
        .join(_gathered(turns, "chosen_id", "_c"), "chosen_id")
        .join(_gathered(turns, "rejected_id", "_r"), "rejected_id")
    )
    shorter = F.least(F.size("_c"), F.size("_r"))
    said = lambda c, i: F.struct(F.col(c)[i]["role"], F.col(c)[i]["text"])
    differ = F.filter(F.sequence(F.lit(0), shorter - 1), lambda i: said("_c", i) != said("_r", i))
    both = both.withColumn("n", F.coalesce(F.array_min(differ), shorter))
    rest = lambda c: F.slice(F.col(c), F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    return both.select(
        "pair_id", F.col("n").cast("long").alias("n_prompt_turns"),
        _render(F.slice("_c", F.lit(1), F.col("n"))).alias("prompt"),
        _render(rest("_c")).alias("chosen"), _mask(rest("_c"), learnt).alias("chosen_mask"),
        _render(rest("_r")).alias("rejected"), _mask(rest("_r"), learnt).alias("rejected_mask"),
    )


def borrowed_answers(conversations: DataFrame, learnt: str = LEARNT) -> tuple[DataFrame, DataFrame]:
    """Turns and pairs that prefer each conversation's last answer to its neighbour's.

    The table states no preferences.  A conversation's own last answer is chosen; the rejected
    conversation ends in the last answer of the conversation whose id differs in the lowest bit,
    or without an answer if that one has none.  Chosen conversations end at their last answer;
    those without an answer make no pair.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").where(
        "conv_id IS NOT NULL"
    )
    last = turns.where((F.col("role") == learnt) & F.col("turn").isNotNull()).groupBy("conv_id").agg(
        F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("answer")
    ).select(F.col("conv_id").alias("id"), F.col("answer.turn").alias("at"), F.col("answer.text").alias("answer"))
    before = turns.join(last, F.col("conv_id") == F.col("id")).where(F.coalesce(F.col("turn") < F.col("at"), F.lit(True)))
    name = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string")).alias("conv_id")
    own = last.select(name("c", "id"), F.col("at").alias("turn"), F.lit(learnt).alias("role"), F.col("answer").alias("text"))
    other = last.select(F.col("id").bitwiseXOR(F.lit(1)).alias("_for"), F.col("answer").alias("text"))
    lent = last.select("id", "at").join(other, F.col("id") == F.col("_for")).select(
        name("r", "id"), F.col("at").alias("turn"), F.lit(learnt).alias("role"), "text"
    )
    shared = before.select(F.explode(F.array(name("c", "id"), name("r", "id"))).alias("conv_id"), "turn", "role", "text")
    stop = last.select(name("r", "id"), F.col("at").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"))
    all_turns = shared.unionByName(own).unionByName(lent)
    # a rejected side without any turn would lose its pair
    silent = stop.join(all_turns.select("conv_id").distinct(), "conv_id", "left_anti").select(*all_turns.columns)
    pairs = last.select(F.col("id").alias("pair_id"), name("c", "id").alias("chosen_id"), name("r", "id").alias("rejected_id"))
    return all_turns.unionByName(silent), pairs
