"""Dialogues seen from every participant, with DataFrame functions only.

For each participant the dialogue is rendered with that speaker as assistant and all others as
named users, and a mask says which characters the assistant is to be trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epochfold.llm.shared import pick

#: Turn numbers in a block are those with the same quotient by 2 ** BLOCK_BITS, and a segment has
#: at most 2 ** BLOCK_BITS turns of a block.
BLOCK_BITS = 5
SYSTEM = "system"
START, END = "<|im_start|>", "<|im_end|>"


def _name(role: Column) -> Column:
    """A role as a name on one line; a null or blank one is `unknown`."""
    name = F.regexp_replace(F.btrim(role), r"[\s<>|]+", "_")
    return F.coalesce(F.when(name != "", name), F.lit("unknown"))


def _body(text: Column) -> Column:
    """The text of a turn; a marker inside it is broken up, so that no text ends its own turn."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _head(name: Column, speaker: Column) -> Column:
    role = F.when(name == SYSTEM, F.lit(SYSTEM)).when(name == speaker, F.lit("assistant"))
    return F.concat(F.lit(START), role.otherwise(F.concat(F.lit("user name="), name)), F.lit("\n"))


def rotate(turns: DataFrame) -> DataFrame:
    """(conv_id, speaker, block, part, n_turns, text, mask array<struct<from, to>>).

    One row for each participant of a conversation and segment of it. A segment holds at most 32
    turns, in the order of turn, name and text; (block, part) orders segments, and the texts of a
    speaker's segments, one after another, are the dialogue. So a conversation of any length is many
    bounded rows, and is never gathered in one place. `mask` has the characters [from, to) of `text`
    that the speaker said, with the end marker.

    Every name except `system` is a participant; a conversation with none has no rows. A null role
    is named `unknown`, a null text is empty, a null turn precedes all others, repeated rows are
    turns of their own, and rows without a conv_id are one conversation. Other columns are not read.
    """
    rows = pick(turns, "conv_id", "turn", "role", "text")
    rows = rows.select(
        "conv_id",
        F.shiftright("turn", BLOCK_BITS).alias("block"),
        "turn",
        _name(F.col("role")).alias("name"),
        _body(F.col("text")).alias("body"),
    )
    order = Window.partitionBy("conv_id", "block").orderBy("turn", "name", "body")
    at = F.row_number().over(order) - 1
    numbered = rows.withColumn("at", at).withColumn("part", F.shiftright("at", BLOCK_BITS))
    turn = F.struct("at", "name", "body")
    segments = numbered.groupBy("conv_id", "block", "part").agg(
        F.array_sort(F.collect_list(turn)).alias("turns")
    )

    # who speaks is joined to blocks without their texts, and then to segments by the same key that
    # they are dealt by already
    speakers = rows.where(F.col("name") != SYSTEM).select("conv_id", F.col("name").alias("speaker"))
    speakers = speakers.distinct().withColumnRenamed("conv_id", "conv")
    blocks = rows.select("conv_id", "block").distinct()
    seen = blocks.join(speakers, F.col("conv_id").eqNullSafe(F.col("conv")))
    seen = seen.select("conv", F.col("block").alias("of_block"), "speaker")
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & F.col("block").eqNullSafe(F.col("of_block"))
    each = segments.join(seen, same)

    speaker = F.col("speaker")
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(_head(t["name"], speaker), t["body"], F.lit(f"{END}\n")).alias("text"),
            F.char_length(_head(t["name"], speaker)).alias("head"),
            (t["name"] == speaker).alias("own"),
        ),
    )
    each = each.withColumn("parts", parts)
    start = F.struct(
        F.lit(0).alias("at"), F.expr("cast(array() as array<struct<from:int,to:int>>)").alias("spans")
    )

    def add(state: Column, part: Column) -> Column:
        end = state["at"] + F.char_length(part["text"])
        span = F.struct((state["at"] + part["head"]).alias("from"), (end - 1).alias("to"))
        spans = F.when(part["own"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return each.select(
        "conv_id",
        "speaker",
        "block",
        "part",
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
        F.aggregate("parts", start, add)["spans"].alias("mask"),
    )


def listed(rotated: DataFrame) -> DataFrame:
    """The mask as text."""
    spans = F.transform("mask", lambda s: F.concat_ws("-", s["from"], s["to"]))
    return rotated.withColumn("mask", F.array_join(spans, ","))
