"""Chat formatting with Spark expressions only: sorted turn structs, merged blocks, one string a conversation.

Adjacent turns of one role share a block and are parted by a seam mark, so every turn can be read back. A mark inside a
text is escaped by one more backslash after its ``<``; nothing else in a text changes.

Turns sort by (turn, role, text), nulls first, and repeated rows are turns of their own. A null text or role is empty.
A row without a conversation id belongs to no other row: it is a conversation of one turn with a null id. A conversation is
formatted in one task, as its output is one string. Columns beside the four named are not read, whatever their names; an
empty table has no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeweave.llm.store import text_of

START, END, SEAM = "<|im_start|>", "<|im_end|>\n", "<|im_more|>"


def escape(text: Column) -> Column:
    """``<|`` becomes ``<\\|``, ``<\\|`` becomes ``<\\\\|`` and so on: no mark is left in the text."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _header(role: Column) -> Column:
    """A role on one line, reversibly."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role(header: Column) -> Column:
    """Pairs of backslashes are backslashes; what lies between them holds escaped line breaks only."""
    parts = F.split(unescape(header), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def merged_blocks(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: ``conv``, ``blocks array<struct<role, texts>>`` with equal neighbours merged."""
    one = F.struct(F.col(turn).alias("turn"), text_of(role).alias("role"), text_of(text).alias("text"))
    grouped = turns.filter(F.col(conv).isNotNull()).groupBy(F.col(conv).alias(conv)).agg(F.sort_array(F.collect_list(one)).alias("t"))
    lone = turns.filter(F.col(conv).isNull()).select(F.col(conv), F.array(one).alias("t"))
    numbered = grouped.unionByName(lone).withColumn(
        "starts",
        F.filter(
            F.sequence(F.lit(1), F.size("t")),
            lambda i: (i == 1) | (F.element_at("t", i)["role"] != F.get("t", i - 2)["role"]),
        ),
    )
    return numbered.select(
        conv,
        F.transform(
            "starts",
            lambda s, k: F.struct(
                F.element_at("t", s)["role"].alias("role"),
                F.transform(
                    F.slice("t", s, F.coalesce(F.get("starts", k + 1), F.size("t") + 1) - s), lambda x: x["text"]
                ).alias("texts"),
            ),
        ).alias("blocks"),
    )


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _block_segments(block: Column) -> Column:
    mute, trained = F.lit(False), block["role"] == "assistant"
    seam = _segment(F.lit(SEAM), mute)
    return F.concat(
        F.array(_segment(F.concat(F.lit(START), _header(block["role"]), F.lit("\n")), mute)),
        F.flatten(
            F.transform(
                block["texts"],
                lambda t, i: F.when(i == 0, F.array(_segment(escape(t), trained))).otherwise(
                    F.array(seam, _segment(escape(t), trained))
                ),
            )
        ),
        F.array(_segment(F.lit(END), mute)),
    )


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``formatted`` and ``segments``: the pieces of ``formatted`` in order, ``loss`` true on assistant text."""
    pieces = merged_blocks(turns, conv, turn, role, text).select(
        conv, F.flatten(F.transform("blocks", _block_segments)).alias("segments")
    )
    return pieces.select(conv, F.array_join("segments.text", "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, ``array<struct<role, text>>``, as they went in."""

    def turns_of(block: Column) -> Column:
        header = F.substring_index(block, "\n", 1)
        body = F.substring(block, F.length(header) + 2, F.length(block) - F.length(header) - 1 - len(END))
        return F.transform(
            F.split(body, r"<\|im_more\|>", -1),
            lambda t: F.struct(_role(header).alias("role"), unescape(t).alias("text")),
        )

    blocks = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda b, i: i > 0)
    return F.flatten(F.transform(blocks, turns_of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
