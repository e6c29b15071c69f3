"""Operator 10: chat formatting with typed content parts, in DataFrame functions only.

A turn holds parts: text, image, audio or document. Parts are visited in order: a text is escaped, an
attachment becomes a placeholder that is repeated once per token it expands to, and is recorded with its
turn, kind, reference, place and token count. Turns are framed by ``<|im_start|>role`` and ``<|im_end|>``;
inside texts and roles ``&`` and ``<|`` are written as ``&amp;`` and ``&lt;|``, so the frame cannot be
forged and everything can be read back. The loss mask covers the texts of assistant turns.

Defined cases: a null text, role or part list is empty; parts of an unknown kind are skipped; turns are
ordered by number (null first), equal numbers by role and content, repeated rows stay; null conversation
ids form one conversation; an empty table gives no conversation; a negative token count counts as 0; other
columns are not carried. One conversation is one output row, so it must fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"
KINDS = ("image", "audio", "document")
PART = "struct<kind:string,text:string,ref:string,tokens:int>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def role_escape(c: Column) -> Column:
    """A role ends with its line, so line feeds are escaped too."""
    return F.replace(escape(c), F.lit("\n"), F.lit("&#10;"))


def role_unescape(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&#10;"), F.lit("\n")))


def text_part(text: Column) -> Column:
    """The content of a turn that is only a text."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).alias("tokens")))


def placeholder(part: Column) -> Column:
    return F.repeat(F.concat(F.lit("<|"), part.kind, F.lit("|>")), F.greatest(F.coalesce(part.tokens, F.lit(0)), F.lit(0)))


def visit(part: Column) -> Column:
    """What one part writes."""
    return (
        F.when(part.kind == "text", escape(F.coalesce(part.text, F.lit(""))))
        .when(part.kind.isin(*KINDS), placeholder(part))
        .otherwise(F.lit(""))
    )


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """(conv_id, formatted, n_turns, loss_spans, attachments), a row per conversation.

    ``loss_spans``: (start, length) in characters of ``formatted`` of each assistant text. ``attachments``:
    (turn_no, kind, ref, tokens). One shuffle by conversation; each turn is written before it.
    """
    parts = F.coalesce(F.col(parts_col).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    one = turns.select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        role.alias("role"),
        F.array_join(F.transform(parts, visit), "").alias("body"),
        F.transform(F.filter(parts, lambda p: p.kind.isin(*KINDS)), lambda p: F.struct(p.kind.alias("kind"), p.ref.alias("ref"), F.greatest(F.coalesce(p.tokens, F.lit(0)), F.lit(0)).alias("tokens"))).alias("files"),
    )
    one = one.select("*", F.concat(F.lit(START), role_escape(F.col("role")), F.lit("\n")).alias("head"))
    size = F.length("head") + F.length("body") + F.lit(len(END))
    earlier = Window.partitionBy("conv_id").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    placed = one.select("conv_id", F.struct(F.coalesce(F.sum(size).over(earlier), F.lit(0)).cast("int").alias("start"), "role", "head", "body", "files").alias("t"))
    convs = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    spans = F.transform(F.filter("ts", lambda t: t.role == LEARNED), lambda t: F.struct((t.start + F.length(t.head)).alias("start"), F.length(t.body).alias("length")))
    files = F.flatten(F.transform("ts", lambda t, i: F.transform(t.files, lambda f: F.struct(i.alias("turn_no"), f.kind.alias("kind"), f.ref.alias("ref"), f.tokens.alias("tokens")))))
    return convs.select(
        "conv_id",
        F.array_join(F.transform("ts", lambda t: F.concat(t.head, t.body, F.lit(END))), "").alias("formatted"),
        F.size("ts").cast("bigint").alias("n_turns"),
        spans.alias("loss_spans"),
        files.alias("attachments"),
    )


def read_back(formatted: DataFrame, *carry: str) -> DataFrame:
    """(conv_id, turns, loss_text, and the columns in ``carry``): roles and texts parsed from the output, and the text under its loss mask.

    Placeholders of attachments stay in the texts as they are written.
    """
    pieces = F.split("formatted", r"<\|im_end\|>\n")
    turns = F.transform(
        F.filter(pieces, lambda p: p.startswith(START)),
        lambda p: F.struct(
            role_unescape(F.substring_index(F.substr(p, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
            unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text"),
        ),
    )
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s.start + 1, s.length)))
    return formatted.select("conv_id", turns.alias("turns"), F.array_join(loss, "").alias("loss_text"), *carry)
