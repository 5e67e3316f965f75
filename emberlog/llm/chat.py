"""Operator 3, chat formatting: prefix-target expansion (DataFrame functions only).

A conversation is written turn by turn as ``<|turn|>role\\ntext<|end|>``.  Every
assistant turn becomes an example of its own: all turns before it and its own
head are context, and only its text is trainable.  All examples of a
conversation are prefixes of its formatted text, so an example is a pair of
places in that text; ``context`` and ``target`` are cut from it when they are
asked for, and a long conversation costs one copy and not one per turn.  A
conversation that ends without an assistant turn (or has none) gets a last
example without a target, so that no turn is lost.

Escapes keep markers out of texts and can be undone: ``\\`` becomes ``\\\\``, then
``<|`` becomes ``<\\|``; in roles a line feed becomes ``<\\n>``.

Turns stand in order of turn, then role and text (nulls first).  A null text or
role is empty; a null conv_id is a conversation like any other; rows repeated
exactly are turns of their own; an empty table gives no rows; other columns are
ignored.  One conversation is one row at the end and must fit in it (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\n>"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\n>"), F.lit("\n")))


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, examples: array of (example, loss_start, loss_end, end, is_last)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    head = F.concat(F.lit(TURN), escaped_role(F.col("role")), F.lit("\n"))
    rows = (rows.withColumn("n", F.row_number().over(order))
            .withColumn("head", head).withColumn("body", escaped(F.col("text")))
            .withColumn("size", F.length("head") + F.length("body") + F.lit(len(END)))
            .withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("is_last", F.lead(F.lit(False), 1, True).over(order)))
    reply = F.col("role") == "assistant"
    start = F.col("end") - F.col("size") + F.length("head")
    example = F.struct(F.col("n").alias("example"), F.when(reply, start).otherwise(F.col("end")).alias("loss_start"),
                       F.when(reply, F.col("end") - F.lit(len(END))).otherwise(F.col("end")).alias("loss_end"), "end", "is_last")
    return (rows.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("n", F.concat("head", "body", F.lit(END)).alias("text")))).alias("texts"),
                 F.sort_array(F.collect_list(F.when(reply | F.col("is_last"), example))).alias("examples"))
            .select("conv_id", F.array_join(F.col("texts.text"), "").alias("formatted"), "examples"))


def examples(turns: DataFrame) -> DataFrame:
    """One row per example: conv_id, example, context, target, formatted, is_last.

    ``target`` is the trainable text, ``formatted`` the whole example
    (context, target and end mark); texts are still escaped.
    """
    rows = formatted(turns).select("conv_id", "formatted", F.explode("examples").alias("e"))
    part = lambda a, b: F.substring(F.col("formatted"), (a + 1).cast("int"), (b - a).cast("int"))
    zero, start, end = F.lit(0), F.col("e.loss_start"), F.col("e.loss_end")
    return rows.select("conv_id", "e.example", part(zero, start).alias("context"), part(start, end).alias("target"),
                       part(zero, F.col("e.end")).alias("formatted"), "e.is_last")


def parsed(whole: Column) -> Column:
    """The turns of a formatted text: array of (role, text), unescaped."""
    marks = F.split(whole, r"<\|turn\|>")
    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = F.substring(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - len(END))
        return F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text"))
    return F.transform(F.slice(marks, F.lit(2), F.greatest(F.size(marks) - 1, F.lit(0))), turn)


def read_back(expanded: DataFrame) -> DataFrame:
    """Per conversation, from its examples: the turns and everything under the loss mask."""
    replies = F.sort_array(F.collect_list(F.struct("example", "target")))
    per = (expanded.groupBy("conv_id")
           .agg(replies.alias("replies"), F.max(F.when(F.col("is_last"), F.col("formatted"))).alias("whole"))
           .select("conv_id", parsed(F.col("whole")).alias("turns"), F.length("whole").alias("chars"),
                   F.array_join(F.transform("replies", lambda r: unescaped(r["target"])), "").alias("loss")))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.col("chars").cast("long").alias("formatted_chars"))
