"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is rendered as ``<|role|>`` + text + ``</s>``; a conversation is its turns
in order. The deterministic parser splits the output at ``</s>``, takes the role
up to the first ``|>`` and undoes the escapes ``~1`` (<), ``~2`` (|) and ``~0``
(~). A text is first rendered as it is; where the parser does not give it back
(it holds ``</s>`` or something that reads as an escape) its ``~`` and ``<`` are
escaped, which leaves no control string in it. Roles are always escaped. After
that every conversation reads back identical; ``round_trip`` records the check.

The loss mask lists, for every assistant turn, where its text lies: the turn's
number, the offset in the rendered turn and the length, in code points.

Defined cases: a null text or role is empty; turns with equal numbers (null
first) order by role and text, so repeated rows stay as repeated turns; a null
``conv_id`` is a conversation of its own; other columns are ignored; no rows, no
conversations. A conversation is one output string, so its turns meet in one
row, whatever its length.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings_lake.llm.common import bound

END, OPEN, CLOSE = "</s>", "<|", "|>"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("~"), F.lit("~0"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("~1")), F.lit("|"), F.lit("~2"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("~1"), F.lit("<")), F.lit("~2"), F.lit("|"))
    return F.replace(text, F.lit("~0"), F.lit("~"))


def parsed_turn(piece: Column) -> Column:
    """``(role, text)`` of one rendered turn without its end mark."""
    stop = F.locate(CLOSE, piece)
    role = F.substring(piece, F.lit(len(OPEN) + 1), stop - F.lit(len(OPEN) + 1))
    body = F.substring(piece, stop + F.lit(len(CLOSE)), F.length(piece))
    return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))


def pieces(formatted: Column) -> Column:
    """The rendered turns of a conversation, without their end marks."""
    cut = F.split(formatted, "</s>", -1)
    return F.slice(cut, F.lit(1), F.size(cut) - 1)


def parsed(formatted: Column) -> Column:
    return F.transform(pieces(formatted), parsed_turn)


def rendered(turn: Column) -> Column:
    """One turn: as it is where the parser gives it back, escaped otherwise."""
    head = F.concat(F.lit(OPEN), escape(turn["role"]), F.lit(CLOSE))
    plain = F.concat(head, turn["text"], F.lit(END))
    back = parsed(plain)
    same = (F.size(back) == 1) & (F.get(back, F.lit(0)) == F.struct(turn["role"].alias("role"), turn["text"].alias("text")))
    return F.when(same, plain).otherwise(F.concat(head, escape(turn["text"]), F.lit(END)))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row for each ``conv_id``: ``formatted``, ``loss_mask`` (array of turn,
    offset, length) and ``round_trip`` (read back identical)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    plain = grouped.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    out = plain.withColumn("formatted", F.array_join(F.transform("turns", rendered), ""))
    head = F.length(F.lit(OPEN + CLOSE))
    mask = F.filter(
        F.transform(pieces(F.col("formatted")), lambda piece, i: F.struct(
            i.alias("turn"), (F.length(escape(parsed_turn(piece)["role"])) + head).alias("offset"),
            (F.length(piece) - F.length(escape(parsed_turn(piece)["role"])) - head).alias("length"),
            parsed_turn(piece)["role"].alias("role"))),
        lambda m: m["role"] == "assistant")
    return out.select(
        "conv_id", "formatted",
        F.transform(mask, lambda m: m.dropFields("role")).alias("loss_mask"),
        (parsed(F.col("formatted")) == F.col("turns")).alias("round_trip"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (array of role, text) parsed from ``formatted`` and
    ``loss_text``, everything under the loss mask, unescaped."""
    masked = bound(pieces(F.col("formatted")), lambda cut: F.transform("loss_mask", lambda m: unescape(
        F.substring(F.get(cut, m["turn"]), m["offset"] + 1, m["length"]))))
    return formatted.withColumns({"turns": parsed(F.col("formatted")), "loss_text": F.array_join(masked, "")})
