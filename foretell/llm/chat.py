"""Conversations as training text, from typed content parts.

A turn's content is a list of parts (``PART``): text, image, audio or document. A visitor
goes over the parts in order and writes text escaped, and every attachment as a placeholder
``<|type:turn.part|>``; it records the attachment's reference and how many tokens its
placeholder stands for. A turn is ``<|turn|>role<|text|>content<|end|>``. Inside texts and
roles a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can look like a control
string, and unescaping (a backslash keeps the next character) gives back every text.

The loss mask lists spans (turn, start, length) of the assistant's texts; starts count code
points from 1 inside the turn's piece of the output, which ``pieces`` cuts at ``<|turn|>``.

Cases: null texts and roles are empty; a turn without parts is empty; parts of unknown type
count as text if they have one, else as nothing; turns with equal numbers go by role and
content, nulls first, and repeated rows are repeated turns; a null conversation id is a
conversation of its own. An empty table gives no rows. Other columns are not read. One
output row holds one conversation, so a conversation must fit in a task, as its text must
in a string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
#: Pixels of a patch side, tokens for a second of audio, tokens for a page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """One text part."""
    return F.struct(
        F.lit("text").alias("type"),
        F.coalesce(text, F.lit("")).alias("text"),
        *(F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))),
    )


def expanded(part: Column) -> Column:
    """Tokens that an attachment's placeholder stands for."""
    patches = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    return (
        F.when(part["type"] == "image", patches)
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * PER_SECOND))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(0)) * PER_PAGE)
        .otherwise(0)
        .cast("bigint")
    )


def _attached(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("")).isin("image", "audio", "document")


def flatten(parts: Column, turn: Column) -> Column:
    """struct(content, attachments) of a turn: escaped text with placeholders in order."""
    slot = lambda i: F.concat_ws(".", F.coalesce(turn.cast("string"), F.lit("")), i.cast("string"))
    placeholder = lambda p, i: F.concat(F.lit("<|"), p["type"], F.lit(":"), slot(i), F.lit("|>"))
    content = F.array_join(
        F.transform(
            parts, lambda p, i: F.when(_attached(p), placeholder(p, i)).otherwise(escape(F.coalesce(p["text"], F.lit(""))))
        ),
        "",
    )
    visited = F.transform(
        parts,
        lambda p, i: F.struct(
            slot(i).alias("slot"), p["type"].alias("type"), p["ref"].alias("ref"), expanded(p).alias("tokens"), _attached(p).alias("is")
        ),
    )
    attachments = F.transform(
        F.filter(visited, lambda v: v["is"]),
        lambda v: F.struct(v["slot"].alias("slot"), v["type"].alias("type"), v["ref"].alias("ref"), v["tokens"].alias("tokens")),
    )
    return F.struct(F.coalesce(content, F.lit("")).alias("content"), F.coalesce(attachments, F.array()).alias("attachments"))


def format_conversations(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    learn_role: str = "assistant",
) -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans, attachments, attachment_tokens; a row for each conversation."""
    flat = df.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        flatten(F.col(parts_col), F.col(turn_col)).alias("flat"),
    ).select("conv_id", "turn", "role", "flat.content", "flat.attachments")
    # ordered once for all that follows
    turns = flat.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "content", "attachments"))).alias("turns")
    )
    head = lambda t: F.concat(escape(t["role"]), F.lit(TEXT))
    spans = F.transform(
        F.filter(
            F.transform(
                "turns",
                lambda t, i: F.struct(
                    i.alias("turn"),
                    (F.length(head(t)) + 1).alias("start"),
                    F.length(t["content"]).alias("length"),
                    (t["role"] == learn_role).alias("learn"),
                ),
            ),
            lambda s: s["learn"],
        ),
        lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"), s["length"].alias("length")),
    )
    attachments = F.flatten(F.transform("turns", lambda t: t["attachments"]))
    return turns.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(F.lit(TURN), head(t), t["content"], F.lit(END))), "").alias(
            "formatted"
        ),
        spans.alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def pieces(formatted: Column) -> Column:
    """The turns of an output, each from behind its ``<|turn|>`` to its end."""
    parts = F.split(formatted, r"<\|turn\|>")
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from an output, unescaped; placeholders stay as they are."""

    def turn(piece):
        fields = F.split(piece, r"<\|text\|>|<\|end\|>")
        return F.struct(unescape(fields[0]).alias("role"), unescape(fields[1]).alias("text"))

    return F.transform(pieces(formatted), turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, read from an output."""
    cut = pieces(formatted)
    return F.array_join(F.transform(spans, lambda s: unescape(F.get(cut, s["turn"]).substr(s["start"], s["length"]))), "")
