"""Chat formatting with Spark expressions only.

A conversation's turn structs are collected, sorted and folded into blocks of adjacent turns of one role; the blocks are
concatenated. ``<|role|>`` opens a block, ``<+>`` stands between the turns of a block, ``</turn>`` closes it. Inside roles
and texts a backslash becomes ``\\s``, ``<`` becomes ``\\l``, ``|`` becomes ``\\p`` and ``#`` becomes ``\\h``, so no text holds a
control string, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SHUT, NEXT, CLOSE = "<|", "|>\n", "\n<+>\n", "\n</turn>\n"


def escaped(text: Column) -> Column:
    """The text without ``<``, ``|`` and ``#``; every backslash is followed by s, l, p or h."""
    for old, new in (("\\", "\\s"), ("<", "\\l"), ("|", "\\p"), ("#", "\\h")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def unescaped(text: Column) -> Column:
    """Inverse of ``escaped``: the backslash comes last, as it makes no new pair then."""
    for old, new in (("\\h", "#"), ("\\p", "|"), ("\\l", "<"), ("\\s", "\\")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _blocks(turns: Column) -> Column:
    """Adjacent turns of one role as one struct of role and texts."""
    empty = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def add(done: Column, turn: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        alone = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        same = (F.size(done) > 0) & (last["role"] == turn["role"])
        return F.when(same, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(alone)))

    return F.aggregate(turns, empty, add)


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: (conv_id, formatted).

    Turns are ordered by turn, then role and text, so ties and repeated rows have one order and all stay; a null turn
    comes first, a null role or text is empty. Rows without a conversation form one conversation of null. A
    conversation is one string and so must fit a row. Other columns are not looked at.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = turns.select(F.col(conv).alias("conv_id"), one.alias("turn")).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    def shown(block: Column) -> Column:
        return F.concat(F.lit(OPEN), escaped(block["role"]), F.lit(SHUT), F.array_join(F.transform(block["texts"], escaped), NEXT), F.lit(CLOSE))

    return own.select("conv_id", F.array_join(F.transform(_blocks(F.col("turns")), shown), "").alias("formatted"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """Inverse of ``format_chats``: (conv_id, formatted, turns array of role and text)."""
    blocks = F.filter(F.split("formatted", CLOSE), lambda b: b != "")

    def turns(block: Column) -> Column:
        who = unescaped(F.substring_index(F.substring(block, F.lit(len(OPEN) + 1), F.length(block)), SHUT, 1))
        texts = F.split(F.substring(block, F.instr(block, SHUT) + len(SHUT), F.length(block)), NEXT.replace("+", r"\+"), -1)
        return F.transform(texts, lambda x: F.struct(who.alias("role"), unescaped(x).alias("text")))

    return formatted.select("conv_id", "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"))


def digests(read: DataFrame) -> DataFrame:
    """Figures of conversations read back: counts of turns and characters, and digests of the turns and of the text under the loss mask (assistant texts)."""
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
