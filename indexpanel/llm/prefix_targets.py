"""Chat formatting by prefix-target expansion. DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are its context, and only its reply is trainable.
Examples of a conversation share their contexts, so they are kept as segments: the turns after the previous reply and the
example's own reply. `examples` writes every example out, the segments of its conversation up to its own; that output grows
with the square of a conversation's turns, the segments with the turns. Turns after the last reply form a segment without a
target. `read_back` takes everything from the texts written out.

A turn is written as <|im_start|>role, a line break, the text, <|im_end|> and a line break. In roles and texts a backslash
stands before every backslash and before the bar of every <|, and before a line break in a role; `unescaped` takes them off.

Turns are ordered by turn, then role, then text, nulls first. Defined results: null text or role counts as empty; repeated
rows are turns of their own; null conv_id is a conversation; a conversation without an assistant is one segment without a
target; an empty table gives an empty result. Only the columns named are read. The turns of one conversation are gathered
in one row, as their digest needs them in one piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"
TARGET = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(turn: Column) -> Column:
    role = F.replace(escaped(turn["role"]), F.lit("\n"), F.lit("\\\n"))
    return F.concat(F.lit(START), role, F.lit("\n"), escaped(turn["text"]), F.lit(END + "\n"))


def segments(conversations: DataFrame) -> DataFrame:
    """conv_id, example, segment, context_chars (of the segments before), loss_start, loss_end (places in the segment, end
    exclusive; null without a target)."""
    blank = F.lit("")
    turns = conversations.select("conv_id", F.struct(
        "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")).alias("t"))
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # One pass: the segments closed so far, and the one that is open.
    closed = "array<struct<segment:string,context_chars:bigint,loss_start:bigint,loss_end:bigint>>"
    first = F.struct(F.array().cast(closed).alias("closed"), F.lit("").alias("open"), F.lit(0).cast("long").alias("before"))

    def step(state: Column, turn: Column) -> Column:
        written = F.concat(state["open"], formatted(turn))
        size = F.char_length(written).cast("long")
        stop = size - len(END + "\n")
        target = F.struct(written.alias("segment"), state["before"].alias("context_chars"),
                          (stop - F.char_length(escaped(turn["text"]))).alias("loss_start"), stop.alias("loss_end"))
        done = F.struct(F.concat(state["closed"], F.array(target)).cast(closed).alias("closed"), F.lit("").alias("open"),
                        (state["before"] + size).alias("before"))
        held = F.struct(state["closed"].alias("closed"), written.alias("open"), state["before"].alias("before"))
        return F.when(turn["role"] == TARGET, done).otherwise(held)

    none = F.lit(None).cast("long")
    state = F.aggregate("turns", first, step, lambda s: F.when(s["open"] == "", s["closed"]).otherwise(F.concat(
        s["closed"], F.array(F.struct(s["open"].alias("segment"), s["before"].alias("context_chars"),
                                      none.alias("loss_start"), none.alias("loss_end"))).cast(closed))))
    return gathered.select("conv_id", F.posexplode(state).alias("example", "s")).select("conv_id", "example", "s.*")


def written(parts: DataFrame) -> DataFrame:
    """conv_id, example, text, loss_start, loss_end, last: the examples written out, each with its whole context and the places
    of its target in it; then the turns after the last reply, alone and without a target. last holds of a conversation's last
    example."""
    turns = Window.partitionBy("conv_id").orderBy("example")
    so_far = F.collect_list("segment").over(turns.rowsBetween(Window.unboundedPreceding, 0))
    following = F.lead("loss_end").over(turns)
    rows = parts.select("conv_id", "example", "segment", "context_chars", "loss_start", "loss_end",
                        so_far.alias("so_far"), following.alias("following"))
    target = F.col("loss_end").isNotNull()
    return rows.select("conv_id", "example", F.when(target, F.array_join("so_far", "")).otherwise(F.col("segment")).alias("text"),
                       (F.col("context_chars") + F.col("loss_start")).alias("loss_start"),
                       (F.col("context_chars") + F.col("loss_end")).alias("loss_end"),
                       (target & F.col("following").isNull()).alias("last"))


def examples(parts: DataFrame) -> DataFrame:
    """conv_id, example, text, loss_start, loss_end: the examples written out, each with its whole context."""
    return written(parts).where(F.col("loss_end").isNotNull()).drop("last")


def read_back(parts: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), replies (the texts under the loss masks) and formatted_chars, all from the texts written out:
    the turns from the last example and those after it, a reply from each example, the characters from every text."""
    loss = F.expr("substring(text, cast(loss_start + 1 as int), cast(loss_end - loss_start as int))")
    whole = F.when(F.col("last") | F.col("loss_end").isNull(), F.col("text"))
    got = written(parts).select("conv_id", F.struct("example", loss.alias("loss"), whole.alias("whole")).alias("part"),
                                F.char_length("text").cast("long").alias("chars"))
    got = got.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"), F.sum("chars").alias("formatted_chars"))
    joined = F.array_join(F.transform("parts", lambda p: p["whole"]), "")
    pieces = F.split(joined, r"<\|im_end\|>\n", -1)
    ended = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    head = r"(?s)\A<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*)\z"
    turns = F.transform(ended, lambda w: F.struct(
        unescaped(F.regexp_extract(w, head, 1)).alias("role"), unescaped(F.regexp_extract(w, head, 2)).alias("text")))
    replies = F.transform(F.filter("parts", lambda p: p["loss"].isNotNull()), lambda p: unescaped(p["loss"]))
    return got.select("conv_id", turns.alias("turns"), replies.alias("replies"), "formatted_chars")
