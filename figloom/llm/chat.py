"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; adjacent turns of one role share one block of the template

    <|turn|>role<|says|>text<|more|>next text of the same role<|end|>

and everything is concatenated. Inside roles and texts `<|`, `<\\|`, `<\\\\|` ... get one more backslash, so they hold
no mark and the output reads back exactly. The loss mask is a list of spans (code points) over the assistant's texts.

Turns are ordered by turn, then role and text, nulls first; repeated rows are turns of their own; null roles and texts
count as empty; rows with a null conv_id make one conversation; other columns are not read; an empty table gives none.
One conversation is one output string, so it has to fit in a row; nothing else is gathered.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, SAYS, MORE, END = "<|turn|>", "<|says|>", "<|more|>", "<|end|>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans array<struct<start, chars>> (start from 1) of each conversation."""
    rows = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))

    def piece(t: Column, i: Column) -> Column:
        first = (i == 0) | (F.get("t", i - 1)["role"] != t["role"])
        last = (i == F.size("t") - 1) | (F.get("t", i + 1)["role"] != t["role"])
        head = F.when(first, F.concat(F.lit(TURN), escape(t["role"]), F.lit(SAYS))).otherwise(F.lit(MORE))
        tail = F.when(last, F.lit(END)).otherwise(F.lit(""))
        return F.struct(head.alias("head"), escape(t["text"]).alias("text"), tail.alias("tail"), (t["role"] == loss_role).alias("loss"))

    pieces = sorted_turns.withColumn("p", F.transform("t", piece))
    formatted = F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["text"], x["tail"])), "")
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,chars:int>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["head"])
        after = begin + F.length(x["text"]) + F.length(x["tail"])
        span = F.array(F.struct(begin.alias("start"), F.length(x["text"]).alias("chars")))
        return F.struct(after.alias("at"), F.when(x["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return pieces.select("conv_id", formatted.alias("formatted"), F.aggregate("p", start, step)["spans"].alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds turns array<struct<role, text>> as they were, and loss_text: what is under the loss mask, unescaped."""

    def block(b: Column) -> Column:
        role = unescape(F.substring_index(b, SAYS, 1))
        begin = F.instr(b, SAYS) + len(SAYS)
        body = F.substr(b, begin, F.length(b) - begin + 1 - len(END))
        return F.transform(F.split(body, r"<\|more\|>", -1), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    blocks = F.slice(F.split("formatted", r"<\|turn\|>", -1), 2, 1 << 30)
    under = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"], s["chars"])))
    return formatted.withColumn("turns", F.flatten(F.transform(blocks, block))).withColumn("loss_text", F.array_join(under, ""))

