"""Chat formatting with a rotating perspective, in DataFrame functions only.

For every participant of a dialogue, the dialogue is rendered with that speaker as the assistant and the
others as users with their names; the mask holds the places (code points) that the assistant is trained on,
contents with their end mark. System messages belong to no participant and stay as they are.

A dialogue is rendered in parts of ``PART`` messages, so that one of any length, also with all of them on one turn or none, is spread over tasks;
concatenated by ``part`` they are the whole. Messages are numbered in a table sorted in ranges, which may begin and end inside a dialogue. Rows equal in conversation, turn, speaker and text are one message;
different messages of one turn follow in order of speaker and text. A null speaker is ``unknown``, a null text
empty, a null turn comes first. Rows without a conversation are dialogues of their own. A
dialogue of system messages alone has no view; an empty table gives an empty result. Marks inside a text are
broken by a space, so that no text can forge a turn. Only ``conv_id, turn, role, text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.tables import store

#: Messages of a part, and of a range of the sorted table.
PART, ROWS = 256, 200_000
START, END, SYSTEM, UNKNOWN = "<|im_start|>", "<|im_end|>", "system", "unknown"
KEYS = ["conv_id", "solo"]


def messages(chats: DataFrame, size: int | None = None) -> DataFrame:
    """Different messages with their dialogue (``conv_id, solo``) and part."""
    row = chats.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(UNKNOWN)).alias("role"),
                       F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("content")).distinct()
    solo = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "content")).otherwise(F.lit(0))
    order = [*KEYS, "turn", "role", "content"]
    ranges = max(1, -(-chats.count() // (size or ROWS)))
    ranged = row.withColumn("solo", solo).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = store(ranged.withColumn("at", F.monotonically_increasing_id()), "messages").withColumn("range", F.shiftright("at", 33))
    before = Window.partitionBy(*KEYS).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    spans = placed.groupBy(*KEYS, "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    spans = spans.select(F.col("conv_id").alias("_conv"), F.col("solo").alias("_solo"), F.col("range").alias("_range"), "first",
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("solo") == F.col("_solo")) & (F.col("range") == F.col("_range"))
    number = F.col("at") - F.col("first") + F.col("before")
    return placed.join(spans, same).select(*KEYS, "turn", "role", "content", F.floor(number / PART).cast("long").alias("part"))


def _pieces(perspective: Column) -> dict[str, Column]:
    """Head and body of each message as the perspective has it."""
    own = lambda t: t["role"] == perspective
    name = lambda t: (F.when(own(t), F.lit("assistant")).when(t["role"] == SYSTEM, F.lit(SYSTEM))
                      .otherwise(F.concat(F.lit("user name="), t["role"])))
    return {"heads": F.transform("turns", lambda t: F.concat(F.lit(START), name(t), F.lit("\n"))),
            "bodies": F.transform("turns", lambda t: F.concat(t["content"], F.lit(END))),
            "trained": F.transform("turns", own)}


def perspectives(chats: DataFrame) -> DataFrame:
    """``conv_id, perspective, part, n_turns, text, mask``: one row per participant and part, ``mask`` as array of start and end."""
    rows = messages(chats)
    parts = rows.groupBy(*KEYS, "part").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "content"))).alias("turns"))
    speakers = rows.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("_conv"), F.col("solo").alias("_solo"),
                                                         F.col("role").alias("perspective")).distinct()
    views = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("solo") == F.col("_solo")))
    views = views.withColumns(_pieces(F.col("perspective")))
    before = F.transform(F.sequence(F.lit(1), F.size("heads")), lambda i: F.aggregate(
        F.zip_with(F.slice("heads", 1, i - 1), F.slice("bodies", 1, i - 1), lambda h, b: F.length(h) + F.length(b) + 1),
        F.lit(0), lambda s, x: s + x))
    places = F.zip_with(before, F.zip_with("heads", "bodies", lambda h, b: F.struct(F.length(h).alias("h"), F.length(b).alias("b"))),
                        lambda at, n: F.struct((at + n["h"]).alias("start"), (at + n["h"] + n["b"]).alias("end")))
    mask = F.filter(places, lambda _, i: F.get("trained", i))
    text = F.concat_ws("", F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b, F.lit("\n"))))
    return views.select("conv_id", "perspective", "part", F.size("turns").cast("long").alias("n_turns"), text.alias("text"), mask.alias("mask"))
