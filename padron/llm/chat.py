"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted; adjacent turns of one role
become one block. The template::

    <|im_start|>role\\ntext<|turn|>text<|im_end|>

marks blocks and, inside a block, turns, so that nothing of the input is lost. Control
strings inside texts are escaped: a backslash becomes two, and `<|` becomes `<\\|`; in a
role, a line break becomes a backslash and `n`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, NEXT, END = "<|im_start|>", "<|turn|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def _escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(_escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    # a line break is restored where its backslash is not itself an escaped one
    return _unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, segments for each conv_id of ``conversations(conv_id, turn, role, text)``.

    ``segments`` is the formatted text in pieces, array of (text, loss): what is said by
    the assistant is under the loss mask, template and other roles are not.

    Turns are sorted by turn, then role, then text; null turns come first, null roles and
    texts are empty, repeated rows are turns of their own. A null conv_id is a
    conversation. Other columns are ignored; an empty table gives no rows.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    talks = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    role_at = lambda i: F.get(F.col("turns"), i)["role"]

    def pieces(t: Column, i: Column) -> Column:
        opens = (i == 0) | (role_at(i - 1) != t["role"])
        closes = (i == F.size("turns") - 1) | (role_at(i + 1) != t["role"])
        lead = F.when(opens, F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n"))).otherwise(F.lit(NEXT))
        return F.array(
            F.struct(lead.alias("text"), F.lit(False).alias("loss")),
            F.struct(_escape(t["text"]).alias("text"), (t["role"] == TRAINED_ROLE).alias("loss")),
            F.struct(F.when(closes, F.lit(END)).otherwise(F.lit("")).alias("text"), F.lit(False).alias("loss")),
        )

    segments = F.flatten(F.transform("turns", pieces))
    talks = talks.select("conv_id", segments.alias("segments"))
    return talks.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    parts = F.split(formatted, r"<\|im_start\|>")
    blocks = F.slice(parts, F.lit(2), F.size(parts))
    header = lambda block: F.substring_index(block, "\n", 1)
    body = lambda block: F.regexp_replace(block, r"(?s)^[^\n]*\n(.*)<\|im_end\|>$", "$1")
    turns = lambda block: F.transform(
        F.split(body(block), r"<\|turn\|>", -1),
        lambda text: F.struct(_unescape_role(header(block)).alias("role"), _unescape(text).alias("text")),
    )
    return F.flatten(F.transform(blocks, turns))


def read_loss_text(segments: Column) -> Column:
    """Unescaped text under the loss mask, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: _unescape(s["text"])), "")


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and checksums read back from the output of ``format_conversations``."""
    told = formatted.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss_text(F.col("segments")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
