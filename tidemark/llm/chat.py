"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted, and adjacent turns of one role become one block:

    <|im_start|>role<|im_text|>text<|im_sep|>text<|im_end|>

Texts and roles are escaped, so that no control string, of this template or another common one, can come
from them: a backslash is doubled, and one is put behind the first character of each control string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, TEXT, SEP, END = "<|im_start|>", "<|im_text|>", "<|im_sep|>", "<|im_end|>"
#: What is broken up inside texts: a backslash, or the first character of a control string.
_CONTROL = r"\\|<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])"


def escaped(text: Column) -> Column:
    """The text with its control strings broken up."""
    return F.regexp_replace(text, _CONTROL, r"$0\\")


def unescaped(text: Column) -> Column:
    """What escaped() was given."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(
    turns: DataFrame,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """(conv_id, formatted, loss_spans) for every conversation.

    Rows are sorted by turn, nulls first; ties by role, then text. Null texts and roles are empty strings; rows
    with a null id are one conversation. Repeated rows are turns of their own. loss_spans holds the code
    points [start, end) of each text of loss_role in the formatted string, escapes included. Other columns
    are not read; an empty table has no conversations. One row must hold a whole conversation, so the
    longest conversation bounds the memory of a task; conversations are spread by id.
    """
    clean = turns.select(
        F.col(id_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    grouped = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("t"))
    # the places at which the role changes begin the blocks
    firsts = F.filter(
        F.sequence(F.lit(0), F.size("t") - 1),
        lambda i: (i == 0) | (F.get("t", i)["role"] != F.get("t", i - 1)["role"]),
    )
    blocks = grouped.withColumn("f", firsts).select(
        "conv_id",
        F.transform(
            "f",
            lambda a, k: F.struct(
                F.get("t", a)["role"].alias("role"),
                F.transform(
                    F.slice("t", a + 1, F.coalesce(F.get("f", k + 1), F.size("t")) - a), lambda x: escaped(x["text"])
                ).alias("texts"),
            ),
        ).alias("blocks"),
    )
    head = lambda b: F.concat(F.lit(START), escaped(b["role"]), F.lit(TEXT))
    formatted = F.array_join(
        F.transform("blocks", lambda b: F.concat(head(b), F.array_join(b["texts"], SEP), F.lit(END))), ""
    )
    # each block's length, and within blocks of loss_role each text's, summed up from the left
    empty = F.array().cast("array<struct<start:int,end:int>>")
    zero = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def text_span(acc: Column, text: Column) -> Column:
        end = acc["at"] + F.length(text)
        own = F.struct(acc["at"].alias("start"), end.alias("end"))
        return F.struct((end + len(SEP)).alias("at"), F.array_append(acc["spans"], own).alias("spans"))

    def block_spans(acc: Column, b: Column) -> Column:
        begin = acc["at"] + F.length(head(b))
        inner = F.aggregate(b["texts"], F.struct(begin.alias("at"), empty.alias("spans")), text_span)
        plain = begin + F.length(F.array_join(b["texts"], SEP)) + len(END)
        return F.struct(
            plain.alias("at"),
            F.when(b["role"] == loss_role, F.concat(acc["spans"], inner["spans"])).otherwise(acc["spans"]).alias("spans"),
        )

    spans = F.aggregate("blocks", zero, block_spans)["spans"]
    return blocks.select("conv_id", formatted.alias("formatted"), spans.alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted string: every turn as it was given."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>"), lambda b: b != "")
    turns = F.transform(
        blocks,
        lambda b: F.transform(
            F.split(F.substring_index(b, TEXT, -1), r"<\|im_sep\|>"),
            lambda x: F.struct(
                unescaped(F.regexp_replace(F.substring_index(b, TEXT, 1), r"^<\|im_start\|>", "")).alias("role"),
                unescaped(x).alias("text"),
            ),
        ),
    )
    return F.flatten(turns)


def under_mask(formatted: Column, loss_spans: Column) -> Column:
    """The text that the loss mask covers, escapes undone."""
    cut = F.transform(loss_spans, lambda s: F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))
    return F.array_join(F.transform(cut, unescaped), "")
