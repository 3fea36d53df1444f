"""Preference formatting: chosen and rejected conversations rendered as one prompt and two masked completions.

The prompt is the longest common prefix of both conversations' turns (role and text), rendered once. What remains of each is its
completion; in it, only the text of assistant turns and their end mark count for the loss, and the mask lists these
spans. A conversation is gathered into one row, as the example it becomes has to be one; nothing else meets on a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.tables import stored
from starloom.operators.positions import with_position

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED_ROLE = "assistant"


def conversations(turns: DataFrame, key: str, name: str) -> DataFrame:
    """``key, name``: the turns of each conversation in order. Null role or text count as empty; equal turn numbers go by role, then text.

    Turns without a number come last. Turns with a null key are one conversation, the one without a key. ``seen`` counts the replies before a turn.
    """
    turn = [F.col("turn").isNull().alias("unnumbered"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn")]
    turn += [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = turns.select(F.col(key).alias(key), *turn)
    # the window's shuffle serves the grouping too
    before = Window.partitionBy(key).orderBy("unnumbered", "turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("seen", F.count_if(F.col("role") == LEARNED_ROLE).over(before))
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("unnumbered", "turn", "role", "text", "seen"))).alias(name))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE))


def _render(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(_header(t), t["text"], F.lit("\n" + END))))


def _loss_spans(turns: Column) -> Column:
    """``start, length`` in characters of what is learned in a rendered completion."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(_header(t))
        size = F.length(t["text"]) + len("\n" + END)
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        spans = F.when(t["role"] == LEARNED_ROLE, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((begin + size).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, add, lambda state: state["spans"])


def format_preferences(pairs: DataFrame) -> DataFrame:
    """``pairs`` (pair_id, chosen, rejected: arrays of turns) as ``pair_id, prefix_turns, prompt, chosen, rejected, chosen_loss, rejected_loss``.

    Conversations that agree throughout give two empty completions; an empty conversation gives an empty prompt and completion. A null side is an empty one.
    """
    empty = {side: F.array().cast(pairs.schema[side].dataType) for side in ("chosen", "rejected")}
    pairs = pairs.select("pair_id", *[F.coalesce(F.col(side), nothing).alias(side) for side, nothing in empty.items()])
    same = F.zip_with("chosen", "rejected", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    first = F.array_position(same, F.lit(False)).cast("int")
    prefix = F.when(first > 0, first - 1).otherwise(F.size(same))
    pairs = pairs.withColumn("prefix", prefix)
    rest = lambda side: F.slice(side, F.col("prefix") + 1, F.size(side))
    pairs = pairs.select("pair_id", "prefix", F.slice("chosen", F.lit(1), F.col("prefix")).alias("shared"), rest("chosen").alias("chosen"), rest("rejected").alias("rejected"))
    return pairs.select(
        "pair_id", F.col("prefix").cast("long").alias("prefix_turns"), _render(F.col("shared")).alias("prompt"),
        *[_render(F.col(side)).alias(side) for side in ("chosen", "rejected")],
        *[_loss_spans(F.col(side)).alias(f"{side}_loss") for side in ("chosen", "rejected")],
    )


def swapped_pairs(turns: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations, one for each: ``pair_id, chosen, rejected``.

    Chosen is the conversation as it is. Rejected is exchanged from one of its assistant turns on: their texts become those of the replies of the
    next conversation by id (of the first after the last; without a key last), in order and over again where there are more replies than that
    one has. Which turn it starts at is drawn by a checksum of the id, so pairs part at any reply. A conversation without a reply, or
    whose next one has none, stays as it is on both sides.
    """
    rows = conversations(turns, "conv_id", "chosen")
    rows = rows.withColumn("replies", F.transform(F.filter("chosen", lambda t: t["role"] == LEARNED_ROLE), lambda t: t["text"]))
    placed = stored(with_position(rows, [F.col("conv_id").asc_nulls_last()], "place", "total", keep=stored), "preferences")
    others = placed.select(F.when(F.col("place") == 1, F.col("total")).otherwise(F.col("place") - 1).alias("place"), F.col("replies").alias("others"))
    drawn = F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % F.size("replies")
    paired = placed.join(others, "place").withColumn("since", F.when((F.size("replies") > 0) & (F.size("others") > 0), drawn.cast("int")))

    def exchanged(t: Column) -> Column:
        other = F.get("others", t["seen"] % F.size("others"))
        text = F.when((t["role"] == LEARNED_ROLE) & (t["seen"] >= F.col("since")), other).otherwise(t["text"])
        return F.struct(*[t[c].alias(c) for c in ("unnumbered", "turn", "role")], text.alias("text"), t["seen"].alias("seen"))

    return paired.select(F.col("conv_id").alias("pair_id"), "chosen", F.transform("chosen", exchanged).alias("rejected"))
