"""Conversations as one text each, in Spark expressions only.

Turns are collected as structs and sorted, adjacent turns of one role become
one block, and blocks are joined:

    <|im_start|>ROLE\\nTEXT<|turn|>TEXT<|im_end|>\\n

``<|turn|>`` separates the turns merged into a block, so they can be read back.
Inside roles and texts each backslash is doubled, ``<|`` becomes ``<\\|`` and a
line break in a role ``<\\n``; no control string can come from a text, and
``plain`` undoes it exactly.

Cases: null texts and roles count as empty; null turns come first; turns with
equal numbers go by role, then text; repeated rows stay repeated turns; a null
conv_id is one conversation; no rows give no conversations. Other columns are
ignored. A conversation has to fit into one task, as its output is one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, TURN, END = "<|im_start|>", "<|turn|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\n"))


def plain(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def plain_role(role: Column) -> Column:
    opened = F.replace(F.replace(role, F.lit("<\\|"), F.lit("<|")), F.lit("<\\n"), F.lit("\n"))
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def _quoted(control: str) -> str:
    return "\\Q" + control + "\\E"


def formatted(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, segments (the same text in pieces, each with its loss flag)."""
    empty = F.lit("")
    turn = F.struct(F.col("turn"), F.coalesce(F.col("role"), empty).alias("role"), F.coalesce(F.col("text"), empty).alias("text"))
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    starts = F.filter(
        F.sequence(F.lit(1), F.size("t")),
        lambda i: (i == 1) | (F.element_at("t", i)["role"] != F.element_at("t", F.greatest(i - 1, F.lit(1)))["role"]),
    )
    cut = sorted_turns.select("conv_id", "t", starts.alias("s"))
    stops = F.concat(F.slice("s", F.lit(2), F.size("s")), F.array(F.size("t") + 1))
    blocks = F.transform(
        F.arrays_zip(F.col("s").alias("first"), stops.alias("stop")),
        lambda b: F.struct(
            F.element_at("t", b["first"])["role"].alias("role"),
            F.transform(F.slice("t", b["first"], b["stop"] - b["first"]), lambda x: escaped(x["text"])).alias("texts"),
        ),
    )

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_block(b: Column) -> Column:
        head = piece(F.concat(F.lit(START), escaped_role(b["role"]), F.lit("\n")), F.lit(False))
        texts = F.transform(b["texts"], lambda x, i: F.array(
            piece(F.when(i > 0, F.lit(TURN)).otherwise(F.lit("")), F.lit(False)), piece(x, b["role"] == loss_role)))
        return F.concat(F.array(head), F.flatten(texts), F.array(piece(F.lit(END), F.lit(False))))

    built = cut.select("conv_id", F.flatten(F.transform(blocks, of_block)).alias("segments"))
    text = F.array_join(F.transform("segments", lambda x: x["text"]), "")
    return built.select("conv_id", text.alias("formatted"), F.filter("segments", lambda x: x["text"] != "").alias("segments"))


def read_back(text: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""
    blocks = F.filter(F.split(text, _quoted(END), -1), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        inside = F.substring(block, F.lit(len(START) + 1), F.length(block))
        role = F.substring_index(inside, "\n", 1)
        body = F.substring(inside, F.length(role) + 2, F.length(inside))
        return F.transform(F.split(body, _quoted(TURN), -1), lambda x: F.struct(plain_role(role).alias("role"), plain(x).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, without escapes."""
    marked = F.filter(segments, lambda x: x["loss"])
    return F.array_join(F.transform(marked, lambda x: plain(x["text"])), "")
