"""Conversations as linear histories (W3): messages in order, and what each call sends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.operators.numbering import running_counts
from opinio.session import stage


def conversation_history(messages: DataFrame, system: str) -> DataFrame:
    """(conv_id, message_no, role, text, call_no): the system message as number 0, then the messages from 1 on.

    A call (a message of the user) sends the messages 0 to its own ``message_no``, so the history is stored once and
    not repeated per call; ``call_no`` numbers the calls of a conversation from 1, NULL for other rows. Messages
    stand by turn, equal turns by role and then by the text's digest (NULLs first); rows that are equal in all of this
    are numbered one after the other.

    Only ids and digests are put in order, by ranges over all conversations, so a conversation of any length is
    spread over tasks; texts join at the end.
    """
    rows = stage(messages.select("conv_id", "turn", "role", "text").withColumn("_row", F.monotonically_increasing_id()), "messages")
    narrow = rows.select("_row", "conv_id", "turn", "role", F.sha2("text", 256).alias("digest"))
    order = ["conv_id", "turn", "role", "digest", "_row"]
    numbered = stage(running_counts(narrow, order, place=F.lit(True), calls=F.col("role") == "user").drop("digest", "turn"), "numbered")
    starts = numbered.groupBy("conv_id").agg(F.min("place").alias("first"), F.min("calls").alias("calls_before"))
    call = F.when(F.col("role") == "user", F.col("calls") - F.col("calls_before") + 1)
    numbers = numbered.join(starts, numbered["conv_id"].eqNullSafe(starts["conv_id"])).select(
        "_row", (F.col("place") - F.col("first") + 1).alias("message_no"), call.alias("call_no"))
    shown = rows.join(numbers, "_row").select("conv_id", "message_no", "role", "text", "call_no")
    opening = starts.select("conv_id", F.lit(0).cast("long").alias("message_no"), F.lit("system").alias("role"),
                            F.lit(system).alias("text"), F.lit(None).cast("long").alias("call_no"))
    return opening.unionByName(shown)
