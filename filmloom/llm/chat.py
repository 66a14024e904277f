r"""Conversations of typed content parts as one training text each, in DataFrame operations only.

A turn is ``<turn:ROLE>`` newline BODY ``</turn>`` newline. A body holds its parts in order: text as it is, each other
part as a placeholder ``<image:T.P>``, ``<audio:T.P>`` or ``<document:T.P>`` with the places of its turn and part.
Markers start with ``<``, and no text or role does hold one: in both, a backslash becomes ``\b`` and ``<`` becomes
``\l``, in a role also ``>`` becomes ``\g``. Reversed in the opposite order that gives any text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PARTS = f"array<{PART}>"
#: Tokens that a placeholder expands to: one for each square of an image, so many a second, so many a page.
SQUARE, TOKENS_A_SECOND, TOKENS_A_PAGE = 28, 25, 800
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\g"), F.lit(">")))


def text_part(text: Column) -> Column:
    """A content of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).cast("array<struct<type:string,text:string>>")


def _tokens(part: Column) -> Column:
    squares = F.ceil(part["width"] / F.lit(SQUARE)) * F.ceil(part["height"] / F.lit(SQUARE))
    return F.coalesce(
        F.when(part["type"] == "image", squares)
        .when(part["type"] == "audio", F.ceil(part["seconds"] * TOKENS_A_SECOND))
        .when(part["type"] == "document", part["pages"] * TOKENS_A_PAGE),
        F.lit(0),
    ).cast("long")


def visit(content: Column, turn: Column) -> tuple[Column, Column]:
    """Body of a turn, and its attachments in order, from its content parts. Parts of another type are text."""
    content = F.coalesce(content, F.array().cast(PARTS))
    attached = lambda part: F.coalesce(part["type"].isin("image", "audio", "document"), F.lit(False))
    mark = lambda part, i: F.concat(F.lit("<"), part["type"], F.lit(":"), turn.cast("string"), F.lit("."), i.cast("string"), F.lit(">"))
    shown = F.transform(content, lambda part, i: F.when(attached(part), mark(part, i)).otherwise(escape(F.coalesce(part["text"], F.lit("")))))
    kept = F.filter(F.transform(content, lambda part, i: F.struct(part.alias("part"), i.alias("i"))), lambda x: attached(x["part"]))
    found = F.transform(kept, lambda x: F.struct(
        turn.alias("turn"), x["i"].alias("part"), x["part"]["type"].alias("type"), x["part"]["ref"].alias("ref"), _tokens(x["part"]).alias("tokens"),
    ))
    return F.array_join(shown, ""), found


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row for each conversation of ``turns`` (conv_id, turn, role, content): ``formatted`` text, ``loss_spans``,
    ``attachments`` and ``expanded_tokens``, the tokens that the attachments stand for.

    ``content`` is an array of ``PART`` structs, or of structs with ``type`` and ``text`` alone. A loss span is the body
    of an assistant's turn: its turn, its place in that turn's text, its place in the whole (both from 0) and its length,
    in code points. Turns are in order of turn (null first), role and body; repeated turns each count. Null roles, texts
    and contents are empty; a null conv_id is a conversation of its own. An empty table gives no rows. A conversation
    is one row of the result, so its turns meet in one task. Other columns are not read.
    """
    if "ref" not in turns.select(F.explode("content").alias("part")).select("part.*").columns:
        full = F.transform("content", lambda p: F.struct(
            p["type"].alias("type"), p["text"].alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
            F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
        ))
        turns = turns.select("conv_id", "turn", "role", full.alias("content"))
    role = escape_role(F.coalesce("role", F.lit("")))
    ordered = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.to_json("content"))
    at = turns.select("conv_id", "role", "content", (F.row_number().over(ordered) - 1).alias("at"))
    body, attachments = visit(F.col("content"), F.col("at"))
    pieces = at.select("conv_id", "at", "role", F.concat(F.lit("<turn:"), role, F.lit(">\n")).alias("head"), body.alias("body"), attachments.alias("attachments"))
    text = pieces.withColumn("piece", F.concat("head", "body", F.lit("</turn>\n")))
    before = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = text.withColumn("start", F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)))
    span = F.when(F.col("role") == LEARNED, F.struct(
        F.col("at").alias("turn"), F.char_length("head").alias("place"), (F.col("start") + F.char_length("head")).alias("start"), F.char_length("body").alias("length"),
    ))
    grouped = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "piece", span.alias("span"), "attachments"))).alias("turns"))
    attached = F.flatten(F.col("turns.attachments"))
    return grouped.select(
        "conv_id", F.array_join("turns.piece", "").alias("formatted"),
        F.filter("turns.span", lambda s: s.isNotNull()).alias("loss_spans"), attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def turn_texts(formatted: Column) -> Column:
    """Texts of the turns, markers included, as they stand in the formatted text."""
    return F.filter(F.split(formatted, "(?<=</turn>\n)"), lambda t: t != "")


def parse_turn(piece: Column) -> Column:
    """Role and text of a turn's text; placeholders stay as they are."""
    head = F.instr(piece, ">")
    role = F.substring(piece, F.lit(7), head - 7)
    body = F.substring(piece, head + 2, F.char_length(piece) - head - 1 - F.lit(len("</turn>\n")))
    return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between. Read turn by turn, in linear time."""
    pieces = turn_texts(formatted)
    return F.array_join(F.transform(F.arrays_zip(spans.alias("span"), F.transform(spans, lambda s: F.get(pieces, s["turn"])).alias("piece")),
                                    lambda x: unescape(F.substring(x["piece"], x["span"]["place"] + 1, x["span"]["length"]))), "")
