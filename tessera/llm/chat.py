"""Chat formatting in DataFrame expressions only.

A conversation's turns are collected as structs and sorted, neighbouring turns of one role become
one block, and blocks are concatenated:

    <|start|>ROLE<|message|>TEXT<|turn|>TEXT<|end|>\\n

``<|turn|>`` parts the texts of a block. In roles and texts every backslash is doubled, and a
backslash is put after the first character of whatever could be read as a control string (of this
template or of other common ones), so the output holds no control string but its own and reading
back is exact. The loss mask is a list of runs (code points, whether they count) over the output:
each assistant text is a run of its own, marks never count.

Cases: null roles and texts are empty; rows are ordered by turn, null first, then by role and text
(ties and repeated rows are turns like any other); a null conv_id is one conversation; a
conversation is one row and so is held as one; an empty table gives an empty result; columns beyond
those named are not read, and their names do not matter. Very long texts and conversations of many
turns are formatted and read whole; reading cuts the output in blocks of runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import cuts
from tessera.session import attach

START, MESSAGE, TURN, END = "<|start|>", "<|message|>", "<|turn|>", "<|end|>\n"

#: Beginnings of control strings of common templates, escaped inside texts.
CONTROL = r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_conversations(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant") -> DataFrame:
    """(key, formatted, loss_mask array<struct<chars, counts>>), one row a conversation."""
    attach(df.sparkSession)
    row = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sorted_turns = df.groupBy(F.col(key).alias("k")).agg(F.array_sort(F.collect_list(row)).alias("turns"))
    # where blocks start: the role differs from the turn before
    first = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (i == 1) | (F.element_at("turns", i)["role"] != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"]))
    starts = sorted_turns.withColumn("first", first)

    def block(i: Column, k: Column) -> Column:
        stop = F.coalesce(F.try_element_at("first", k + 2), F.size("turns") + 1)
        return F.struct(
            F.element_at("turns", i)["role"].alias("role"),
            F.transform(F.slice("turns", i, stop - i), lambda t: escape(t["text"])).alias("texts"),
        )

    merged = starts.select("k", F.transform("first", block).alias("blocks"))

    def runs(b: Column) -> Column:
        head = F.concat(F.lit(START), escape(b["role"]), F.lit(MESSAGE))
        counts = b["role"] == learn
        piece = lambda t, i: F.array(
            F.struct(F.when(i == 0, head).otherwise(F.lit(TURN)).alias("text"), F.lit(False).alias("counts")),
            F.struct(t.alias("text"), counts.alias("counts")),
        )
        tail = F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("counts")))
        return F.concat(F.flatten(F.transform(b["texts"], piece)), tail)

    pieces = merged.select("k", F.flatten(F.transform("blocks", runs)).alias("pieces"))
    return pieces.select(
        F.col("k").alias(key),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        F.transform("pieces", lambda p: F.struct(F.length(p["text"]).alias("chars"), p["counts"].alias("counts"))).alias("loss_mask"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>\n", -1), lambda b: b != "")

    def turns(b: Column) -> Column:
        parts = F.split(b, r"<\|message\|>", 2)
        role = unescape(F.regexp_replace(F.element_at(parts, 1), r"^<\|start\|>", ""))
        return F.transform(F.split(F.element_at(parts, 2), r"<\|turn\|>", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def masked_texts(formatted: Column, loss_mask: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    parts = cuts.pieces(formatted, F.transform(loss_mask, lambda r: r["chars"]))
    counted = F.filter(F.zip_with(parts, loss_mask, lambda p, r: F.when(r["counts"], p)), lambda p: p.isNotNull())
    return F.transform(counted, unescape)


def digests(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read from the output."""
    read = formatted.select(key, "formatted", read_back(F.col("formatted")).alias("turns"), F.array_join(masked_texts(F.col("formatted"), F.col("loss_mask")), "").alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        key, F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
