"""Chat formatting by perspective rotation (native).

Every participant of a conversation becomes the assistant of one rendering: that speaker's messages are
rendered as the assistant's and are trained on, those of the others as a named user's and are not.

Long conversations are rendered in blocks of ``turns`` turn numbers, one row each, whose texts put together
are the whole dialogue; so no task holds more than a block, however long a conversation is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.ordering import block_starts, ordered_blocks, with_block_value


@dataclass(frozen=True)
class ChatFormat:
    """``turns``: turn numbers in a block. ``most``: messages in a row; a block of more, which only
    repeated turn numbers can make, is cut into several rows, whose texts put together by part are the block."""

    turns: int = 32
    most: int = 128
    start: str = "<|im_start|>"
    end: str = "<|im_end|>"


def in_parts(said: DataFrame, most: int) -> DataFrame:
    """``said`` with ``part``: the messages of each block by rank, ``most`` to a part. Messages are ranged and
    counted by range first, so no task holds a block."""
    order = ["conv_id", "block", "turn", "role", "text"]
    ranged = ordered_blocks(said, order)
    starts, _ = block_starts(ranged)
    within = F.row_number().over(Window.partitionBy("_block").orderBy(*order)) - 1
    placed = with_block_value(ranged.withColumn("_within", within), starts, "_start")
    placed = placed.select(*order, (F.col("_start") + F.col("_within")).alias("at"))
    first = placed.groupBy(F.col("conv_id").alias("_conv"), F.col("block").alias("_of")).agg(F.min("at").alias("_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("block").eqNullSafe(F.col("_of"))
    part = F.floor((F.col("at") - F.col("_first")) / most).cast("long")
    return placed.join(first, same).select(*order, part.alias("part"))


def rotate(messages: DataFrame, style: ChatFormat = ChatFormat()) -> DataFrame:
    """From (conv_id, turn, role, text), a row per conversation, participant and block: conv_id, speaker,
    block, part, ``dialogue``, ``mask`` (a 1 or 0 for each message, 1 where it is trained on), n_messages,
    n_trained, and ``trained_chars``: the characters of the messages that are trained on.

    Messages stand by turn, then role, then text. A NULL turn comes first, in a block of its own (NULL); a
    NULL role is the participant ``unknown``; a NULL text is empty. Rows equal in all four columns are one
    message. A conversation without an id is a conversation too. An empty table gives an empty result.
    """
    said = messages.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).distinct()  # before anything is gathered: repeated rows are one message
    said = said.withColumn("block", F.floor(F.col("turn") / style.turns).cast("long"))
    size = said.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    large = size.filter(F.col("n") > style.most).select(F.col("conv_id").alias("_conv"), F.col("block").alias("_of"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("block").eqNullSafe(F.col("_of"))
    crowded = in_parts(said.join(large, same, "left_semi"), style.most)
    said = said.join(large, same, "left_anti").withColumn("part", F.lit(0).cast("long")).unionByName(crowded)
    order = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    blocks = said.groupBy("conv_id", "block", "part").agg(F.array_sort(F.collect_list(order)).alias("messages"))
    people = said.select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    # one row per block and participant: as many as the result has
    both = blocks.join(people, F.col("conv_id").eqNullSafe(F.col("_conv")))
    mine = lambda m: m["role"] == F.col("speaker")
    header = lambda m: F.when(mine(m), F.lit("assistant")).otherwise(F.concat(F.lit("user name="), m["role"]))
    render = lambda m: F.concat(F.lit(style.start), header(m), F.lit("\n"), m["text"], F.lit(style.end + "\n"))
    own = F.filter("messages", mine)
    return both.select(
        "conv_id",
        "speaker",
        "block",
        "part",
        F.array_join(F.transform("messages", render), "").alias("dialogue"),
        F.array_join(F.transform("messages", lambda m: F.when(mine(m), F.lit("1")).otherwise(F.lit("0"))), "").alias("mask"),
        F.size("messages").cast("long").alias("n_messages"),
        F.size(own).cast("long").alias("n_trained"),
        F.aggregate(own, F.lit(0).cast("long"), lambda n, m: n + F.length(m["text"])).alias("trained_chars"),
    )
