"""Chat formatting by event-sourced reconstruction.

A chat log is a stream of events.  `reconstruct` folds the events of each message into its final
text and `render` writes each conversation in a template with a loss mask; `parse` reads the
rendered text back.  Everything is SQL expressions, joined by two shuffles: one on
(conversation, message), so that a conversation with very many events is spread over tasks, and one
on the conversation, whose rendered text is one value.

Events: conv_id, message (any orderable value), seq (order within the conversation), kind, role, text
  message     starts a message, or replaces all that was folded of it (role and text are taken)
  delta       appends its text (streaming)
  edit        replaces the text so far; later deltas append to it
  regenerate  discards the text so far; later deltas start anew

Defined results: a null text is empty; a null role is empty; a null conv_id is a conversation of its
own; events with equal seq are folded by kind (edit, message and regenerate before delta), then text;
repeated events are folded each time they occur; an empty table gives an empty result; any further
columns are ignored.  A conversation's turns are ordered by message.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Reversible: every backslash becomes \\b, every <| becomes \\l (so no control string is left)."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<|")), F.lit("\\b"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\l"), F.lit("<|")), F.lit("\\n"), F.lit("\n")),
                     F.lit("\\b"), F.lit("\\"))


def reconstruct(events: DataFrame) -> DataFrame:
    """One row per (conv_id, message): its last role and its folded text."""
    rank = F.when(F.col("kind") == "delta", 1).otherwise(0)
    order = F.struct(F.col("seq").alias("seq"), rank.alias("rank"), F.coalesce("text", F.lit("")).alias("text"))
    e = events.select("conv_id", "message", "kind", "role", order.alias("o"))
    folded = e.groupBy("conv_id", "message").agg(
        F.max(F.when(F.col("kind") != "delta", F.struct("o", "kind"))).alias("reset"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("o"))).alias("role"),
        F.sort_array(F.collect_list(F.when(F.col("kind") == "delta", F.col("o")))).alias("deltas"))
    base = F.when(F.col("reset.kind").isin("message", "edit"), F.col("reset.o.text")).otherwise("")
    after = F.filter("deltas", lambda d: F.col("reset").isNull() | (d > F.col("reset.o")))
    return folded.select(
        "conv_id", "message", F.coalesce("role", F.lit("")).alias("role"),
        F.concat(base, F.array_join(F.transform(after, lambda d: d["text"]), "")).alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: `formatted`, and `loss_spans`, the [start, length) of every trained
    text in code points of `formatted`."""
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    m = messages.select("conv_id", "message", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    m = m.withColumn("size", F.length("head") + F.length("body") + F.lit(len(END) + 1))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    m = m.select("conv_id", F.struct(
        "start", F.concat("head", "body", F.lit(END + "\n")).alias("turn"),
        F.when(F.col("role") == LOSS_ROLE,
               F.struct((F.col("start") + F.length("head")).cast("int").alias("start"),
                        F.length("body").cast("int").alias("length"))).alias("loss")).alias("t"))
    g = m.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return g.select("conv_id", F.array_join(F.transform("t", lambda t: t["turn"]), "").alias("formatted"),
                    F.filter(F.transform("t", lambda t: t["loss"]), lambda s: s.isNotNull()).alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation, as an array of (role, text)."""
    pieces = F.slice(F.split(formatted, r"<\|im_start\|>"), F.lit(2), F.length(formatted))
    cut = F.transform(pieces, lambda p: F.struct(F.instr(p, F.lit("\n")).alias("at"), p.alias("p")))
    return F.transform(cut, lambda c: F.struct(
        _unescape_role(F.substring(c["p"], F.lit(1), c["at"] - 1)).alias("role"),
        unescape(F.substring(c["p"], c["at"] + 1, F.length(c["p"]) - c["at"] - len(END) - 1)).alias("text")))


def masked(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, one after the other."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(
        F.substring(formatted, s["start"] + 1, s["length"]))), "")


def events_of(conversations: DataFrame) -> DataFrame:
    """Finished turns as events: each row is a `message` that opens the turn and a `delta` with its
    text.  Rows of one turn number are messages of their own, in the order of role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    tie = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumn("message", F.struct("turn", F.row_number().over(tie).alias("copy")))
    opened = F.struct(F.lit(0).alias("seq"), F.lit("message").alias("kind"), F.col("role"), F.lit("").alias("text"))
    said = F.struct(F.lit(1).alias("seq"), F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"),
                    F.col("text"))
    return rows.select("conv_id", "message", F.inline(F.array(opened, said)))
