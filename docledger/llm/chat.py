"""Chat formatting, relational: Spark expressions only.

A conversation's rows are collected as structs and sorted (turn, role, text); adjacent turns of one role become
one block; the blocks are rendered and joined.  The template:

    <|im_start|>role \\n text [<|im_sep|> text ...] <|im_end|> \\n

with an <|im_sep|> between the merged turns of a block, so the turns can be read back.  Escaping: in a
text, every control string (`<s>`, `</s>`, `[INST]`, `[/INST]`, `<<SYS>>`, `<</SYS>>`, `<|name|>`) gets a
backslash behind its first character, and one that has n backslashes there already gets one more, so
taking one away again gives exactly the text.  Roles are percent-encoded.  `segments` cuts the formatted text
into pieces with a loss mark: true for exactly the assistant's texts, not for marks and separators.

Null text: empty; null role: empty; null turns sort first.  Rows that repeat a turn: kept, sorted by role and text.
Null conversation id: one conversation.  Empty tables: an empty result.  One conversation is one output
row, so its turns are gathered by design; conversations are spread over tasks by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
_TAIL = r"/?s>|/?INST\]|<SYS>>|</SYS>>|\|[a-z_]+\|>"
CONTROL = rf"([<\[])(\\*)({_TAIL})"
ESCAPED = rf"([<\[])\\(\\*)({_TAIL})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def format_conversations(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", learn_role="assistant") -> DataFrame:
    """conv, formatted, segments (array of text and loss): a row for each conversation."""
    row = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    convs = turns.groupBy(F.col(conv_col).alias("conv")).agg(F.array_sort(F.collect_list(row)).alias("t"))
    convs = convs.withColumn("n", F.size("t"))
    # A block starts at a turn whose role differs from the one before it.
    starts = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: (i == 1) | (F.element_at("t", i)["role"] != F.element_at("t", F.greatest(i - 1, F.lit(1)))["role"]))
    convs = convs.withColumn("starts", starts)

    def block(start: Column, k: Column) -> Column:
        after = F.coalesce(F.get(F.col("starts"), k + 1), F.col("n") + 1)
        members = F.slice("t", start, after - start)
        role = F.element_at("t", start)["role"]
        head = F.struct(F.concat(F.lit(START), F.url_encode(role), F.lit("\n")).alias("text"), F.lit(False).alias("loss"))
        body = F.transform(members, lambda m, j: F.array(F.struct(F.when(j > 0, F.lit(SEP)).otherwise(F.lit("")).alias("text"), F.lit(False).alias("loss")), F.struct(escape(m["text"]).alias("text"), (role == learn_role).alias("loss"))))
        tail = F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss"))
        return F.concat(F.array(head), F.flatten(body), F.array(tail))

    convs = convs.withColumn("segments", F.filter(F.flatten(F.transform("starts", block)), lambda s: s["loss"] | (s["text"] != "")))
    return convs.select("conv", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments").withColumnRenamed("conv", conv_col)


def parse(formatted: Column) -> Column:
    """The turns, read back: array of structs of role and text."""
    blocks = F.filter(F.split(formatted, r"\Q" + START + r"\E"), lambda b: b != "")

    def turns(b: Column) -> Column:
        cut = F.instr(b, "\n")
        role = F.url_decode(F.substring(b, F.lit(1), cut - 1))
        body = F.substring(b, cut + 1, F.length(b) - cut - len(END))
        return F.transform(F.split(body, r"\Q" + SEP + r"\E"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def learned(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
