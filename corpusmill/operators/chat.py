"""Conversation turns to requests, responses and histories.

Messages of a conversation are ordered by ``turn``, a number from 0; gaps are allowed. Conversations
are worked on in blocks of turns, so a very long one spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def request_id(conv: Column | str = "conv_id", turn: Column | str = "turn") -> Column:
    conv = F.col(conv) if isinstance(conv, str) else conv
    turn = F.col(turn) if isinstance(turn, str) else turn
    return F.concat_ws("-", conv.cast("string"), turn.cast("string"))


def requests_with_responses(turns: DataFrame, block: int = 1024) -> DataFrame:
    """Every user turn with the assistant's answer, if the next message is one.

    The next message is looked for within the block, and for a block's last message among one edge
    row per block.
    """
    said = F.struct("turn", "role", "text")
    blocks = turns.withColumn("block", F.floor(F.col("turn") / block))
    edges = blocks.groupBy("conv_id", "block").agg(F.min(said).alias("edge"))
    edges = edges.withColumn("after", F.lead("edge").over(Window.partitionBy("conv_id").orderBy("block")))
    within = Window.partitionBy("conv_id", "block").orderBy("turn")
    asked = blocks.withColumn("within", F.lead(said).over(within)).filter(F.col("role") == "user")
    found = asked.join(edges.select("conv_id", "block", "after"), ["conv_id", "block"])
    found = found.withColumn("next", F.coalesce("within", "after"))
    answer = F.when(F.col("next.role") == "assistant", F.col("next.text"))
    return found.select(
        request_id().alias("request_id"), "conv_id", "turn", F.col("text").alias("request"), answer.alias("response")
    )


def requests_with_history(turns: DataFrame, block: int = 1024) -> DataFrame:
    """Every user turn with all messages up to and including it, in order.

    This is the nested request a chat model is given, so each row holds its own history. Conversations
    are cut into blocks of turns; each block is worked on alone, with the blocks before it as its prefix.
    """
    said = F.struct(F.col("turn"), F.col("role"), F.col("text").alias("content"))
    blocks = turns.groupBy("conv_id", F.floor(F.col("turn") / block).alias("block")).agg(
        F.array_sort(F.collect_list(said)).alias("said")
    )
    last = blocks.groupBy("conv_id").agg(F.max("block").alias("last"))
    # Every block goes to each later one by the number of that block, so a long conversation meets in many groups.
    earlier = blocks.join(last, "conv_id").filter(F.col("block") < F.col("last"))
    earlier = earlier.select(
        "conv_id", F.struct(F.col("block").alias("b"), F.col("said").alias("s")).alias("part"),
        F.explode(F.sequence(F.col("block") + 1, F.col("last"))).alias("block"),
    )
    prefix = earlier.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    prefix = prefix.select("conv_id", "block", F.flatten(F.transform("parts", lambda p: p["s"])).alias("before"))
    rows = blocks.join(prefix, ["conv_id", "block"], "left").select(
        "conv_id", "before", "said", F.posexplode("said").alias("at", "last")
    )
    own = F.slice("said", F.lit(1), F.col("at") + 1)
    history = F.when(F.col("before").isNull(), own).otherwise(F.concat("before", own))
    return rows.filter(F.col("last.role") == "user").select(
        request_id(F.col("conv_id"), F.col("last.turn")).alias("request_id"),
        "conv_id",
        F.col("last.turn").alias("turn"),
        F.transform(history, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"),
    )


def transcript(messages: Column | str) -> Column:
    """Messages as text, one ``role: content`` per line."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")
