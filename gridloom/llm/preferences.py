"""Preference pairs: one prompt, two masked completions.

A conversation becomes one row, an array of its turns in order, each with the
place where its rendered form ends. The arrays of the chosen and the rejected
conversation of a pair stand side by side; the first place where role or text
differ ends the longest common prefix. The prefix is rendered once as the prompt,
the rest of either side as its completion. The mask lists the spans of a completion
that are learned from: the text and end mark of assistant turns, in code points,
as 'start:end'.

Turns are shuffled once, by conversation: the running lengths and the array come
from the same exchange. A pair is one row of the result, so its turns meet in
one task by nature; no pair needs another pair's rows.

Defined cases: a null text is empty, a null role is 'unknown', a null turn
number comes first; turns of equal number are ordered by role and text; exactly
repeated turns stay repeated; rows without a conversation id belong to no
conversation and are left out; sides that are equal have empty completions; a
pair that lacks a side gets an empty one. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.ordered import row_index
from gridloom.sources.scratch import materialise

OPEN, SPLIT, CLOSE = "<|", "|>\n", "<|end|>\n"
LEARNED_ROLE = "assistant"


def _clean(turns: DataFrame, key: str, order: str) -> DataFrame:
    return turns.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("pair_id"), F.col(order).alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )


def _head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(SPLIT))


def _rendered(turn: Column) -> Column:
    return F.concat(_head(turn["role"]), turn["text"], F.lit(CLOSE))


def gathered(turns: DataFrame, key: str, order: str) -> DataFrame:
    """(pair_id, turns): each conversation's (role, text, stop) in order; ``stop`` is the end of a turn in the whole rendering.

    One exchange: the array is grouped as the window left the rows.
    """
    before = Window.partitionBy("pair_id").orderBy(F.asc_nulls_first("turn"), "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    length = F.length("role") + F.length("text") + F.lit(len(OPEN + SPLIT + CLOSE))
    placed = _clean(turns, key, order).select(
        "pair_id", "role", "text", F.sum(length).over(before).alias("stop"), F.row_number().over(before).alias("position")
    )
    held = F.sort_array(F.collect_list(F.struct("position", "role", "text", "stop")))
    return placed.groupBy("pair_id").agg(F.transform(held, lambda t: F.struct(t["role"], t["text"], t["stop"])).alias("turns"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """From (pair_id, chosen, rejected), two arrays as ``gathered`` makes them: one row per pair.

    (pair_id, prefix_turns, prompt, chosen, rejected, chosen_mask, rejected_mask)
    """
    same = lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False))
    sides = pairs.select("pair_id", F.col("chosen").alias("c"), F.col("rejected").alias("r"))
    equal = F.zip_with("c", "r", same)
    apart = F.array_position(equal, False)
    met = sides.select("*", F.when(apart > 0, apart - 1).otherwise(F.size(equal)).cast("int").alias("n"))
    prefix = F.col("n")
    begin = F.coalesce(F.get("c", prefix - 1)["stop"], F.lit(0))

    def rest(side: str) -> Column:
        return F.slice(side, prefix + 1, F.greatest(F.size(side) - prefix, F.lit(0)))

    def text(turns: Column) -> Column:
        return F.array_join(F.transform(turns, _rendered), "")

    def mask(side: str) -> Column:
        def span(turn: Column) -> Column:
            stop = turn["stop"] - begin
            start = stop - F.length(turn["text"]) - F.lit(len(CLOSE))
            return F.when(turn["role"] == LEARNED_ROLE, F.concat(start.cast("string"), F.lit(":"), stop.cast("string")))

        return F.array_join(F.transform(rest(side), span), ",")  # turns of other roles have no span

    return met.select(
        "pair_id", prefix.cast("long").alias("prefix_turns"), text(F.slice("c", 1, prefix)).alias("prompt"),
        text(rest("c")).alias("chosen"), text(rest("r")).alias("rejected"), mask("c").alias("chosen_mask"), mask("r").alias("rejected_mask"),
    )


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``format_pairs`` of two tables (pair_id, position, role, text)."""
    c = gathered(chosen, "pair_id", "position").withColumnRenamed("turns", "chosen")
    r = gathered(rejected, "pair_id", "position").withColumnRenamed("turns", "rejected")
    none = F.array().cast(c.schema["chosen"].dataType)
    met = c.join(r, "pair_id", "full")
    return format_pairs(met.select("pair_id", *[F.coalesce(s, none).alias(s) for s in ("chosen", "rejected")]))


def swapped_pairs(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected) arrays from plain conversations (conv_id, turn, role, text), one pair each.

    Chosen is the conversation itself; rejected has its last assistant turn
    replaced by that of the next conversation that has one, in order of the ids
    (after the last one comes the first). Without such a turn both are equal.

    The ids alone are put in order; of the texts only the last assistant turns
    are shuffled a second time.
    """
    whole = gathered(turns, "conv_id", "turn")
    at = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == LEARNED_ROLE, i)))
    replying = turns.filter((F.col("role") == LEARNED_ROLE) & F.col("conv_id").isNotNull()).select(F.col("conv_id").alias("giver")).distinct()
    placed = materialise(row_index(replying, ["giver"], "place"))
    n = max(placed.count(), 1)
    taker = placed.select(F.col("giver").alias("pair_id"), F.pmod(F.col("place") + 1, F.lit(n)).alias("place"))
    given = taker.join(placed, "place").select("pair_id", "giver")
    replies = whole.select(F.col("pair_id").alias("giver"), F.get("turns", at)["text"].alias("other")).filter("other IS NOT NULL")
    others = given.join(replies, "giver").select("pair_id", "other")
    met = whole.withColumn("at", at).join(others, "pair_id", "left")
    longer = F.length("other") - F.length(F.get("turns", F.col("at"))["text"])

    def swapped(turn: Column, i: Column) -> Column:
        text = F.when(i == F.col("at"), F.col("other")).otherwise(turn["text"])
        return F.struct(turn["role"].alias("role"), text.alias("text"), (turn["stop"] + F.when(i >= F.col("at"), longer).otherwise(0)).alias("stop"))

    return met.select(
        "pair_id", F.col("turns").alias("chosen"), F.when(F.col("other").isNull(), F.col("turns")).otherwise(F.transform("turns", swapped)).alias("rejected")
    )


def swapped_replies(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``swapped_pairs`` as two tables (pair_id, position, role, text) of turns."""
    pairs = materialise(swapped_pairs(turns))

    def side(name: str) -> DataFrame:
        listed = pairs.select("pair_id", F.posexplode(name).alias("position", "turn"))
        return listed.select("pair_id", F.col("position").cast("long").alias("position"), "turn.role", "turn.text")

    return side("chosen"), side("rejected")
