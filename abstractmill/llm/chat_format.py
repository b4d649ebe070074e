"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context,
its reply is the only trainable part. Turns after the last reply (or a conversation
without any) make one last example without a trainable part, so no turn is lost.

Template: ``<|start|>role\\nbody<|end|>\\n`` for each turn. Inside roles and bodies a
backslash is doubled, and one is put after the first character of every control string
(CONTROLS), so that no control string is left in a body; `unescape` takes both back.

Defined cases: a null role or text is empty; turns are in order of turn, then role, then
text, so repeated rows and equal turn numbers keep their place and each counts; a null
conversation id is a conversation; extra columns are ignored; an empty table gives no
example.

Scale: one shuffle by conversation, used for the running lengths, the contexts and the
read back. The text of one conversation meets in one task because every example repeats
its prefix; nothing larger than a conversation does.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|start|>", "<|end|>\n"
#: Control strings that must not appear inside a text.
CONTROLS = ("<|start|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")


def escape(text: Column, controls: tuple[str, ...] = CONTROLS) -> Column:
    """The text with its backslashes doubled and its control strings broken."""
    pattern = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in controls)
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), pattern, r"\\")


def unescape(text: Column) -> Column:
    """The text that `escape` was given."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def prefix_examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per example: conv_id, example (from 0), text, loss_start, loss_end, in code points.

    The reply lies at [loss_start, loss_end) of text, escaped; the last example of a
    conversation that does not end with a reply has an empty span.
    """
    said = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("said"),
    )
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit("\n"))
    marked = said.withColumns({"head": head, "body": escape(F.col("said"))}).withColumn(
        "piece", F.concat("head", "body", F.lit(END))
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "said")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = marked.withColumns(
        {
            "before": F.coalesce(F.sum(F.char_length("piece")).over(upto), F.lit(0)),
            "last": F.lead(F.lit(True)).over(order).isNull(),
            "replies": F.count(F.when(F.col("role") == "assistant", 1)).over(upto),
            "context": F.array_join(F.collect_list("piece").over(upto), ""),
        }
    )
    reply = F.col("role") == "assistant"
    start = F.col("before") + F.char_length("head")
    return placed.filter(reply | F.col("last")).select(
        "conv_id",
        F.col("replies").alias("example"),
        F.concat("context", "piece").alias("text"),
        F.when(reply, start).otherwise(F.lit(0)).cast("long").alias("loss_start"),
        F.when(reply, start + F.char_length("body")).otherwise(F.lit(0)).cast("long").alias("loss_end"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Turns and trainable text of each conversation, taken from its examples alone."""
    replies = examples.withColumn(
        "reply",
        F.when(
            F.col("loss_end") > F.col("loss_start"),
            unescape(F.expr("substring(text, int(loss_start) + 1, int(loss_end - loss_start))")),
        ).otherwise(F.lit("")),
    )
    whole = replies.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("whole"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "reply"))), lambda x: x["reply"]), "").alias("loss"),
        F.sum(F.char_length("text")).alias("formatted_chars"),
    )
    parts = F.filter(F.split("whole", re.escape(END)), lambda x: x != "")
    turns = F.transform(parts, lambda x: unescape(F.concat(F.substring(x, len(START) + 1, 2147483647), F.lit("\n"))))
    return whole.withColumn("turns", turns).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
