"""Chat formatting from event logs: fold events into final messages, render them, read them back.

An event is (conversation, sequence, turn, kind, role, text).  Within a turn, in sequence order,
``message`` starts a message, ``delta`` appends to it, ``edit`` and ``regenerate`` replace all of
it so far; a role given later replaces an earlier one.  Events before the first message of a
turn form a message of their own.  Null text and null roles count as empty; a null conversation is
a conversation; events that tie are ordered by kind, role and text, so any order of the input
gives the same result, and each repeated ``message`` row stays a message.

A turn is rendered as ``### role: text </turn>`` and a line end.  In texts and roles the
characters that could form these marks are written as two: a backslash and a letter.  Every
backslash in the output is thus part of such a pair and reading back is exact.  All steps are
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaweave.llm.common import pick

HEAD, MIDDLE, TAIL = "### ", ": ", " </turn>\n"
#: Character and its written form, in the order of writing; reading goes backwards.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
KINDS = ("message", "delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def fold_events(events: DataFrame, conv: str = "conv_id", seq: str = "seq", turn: str = "turn",
                kind: str = "kind", role: str = "role", text: str = "text") -> DataFrame:
    """Final messages: conv_id, turn, nth (message of the turn), role, text."""
    rows = pick(events, conv_id=conv, seq=seq, turn=turn, kind=kind, role=role, text=text).select(
        "conv_id", "seq", "turn", F.coalesce("kind", F.lit("message")).alias("kind"), "role",
        F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("seq"), F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), F.col("role"), F.col("text")]
    nth = F.sum(F.when(F.col("kind") == "message", 1).otherwise(0)).over(
        Window.partitionBy("conv_id", "turn").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    event = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order[:2])], F.col("role").alias("role"),
                     F.col("text").alias("text"), (F.col("kind") != "delta").alias("resets"))
    grouped = rows.withColumn("nth", nth).groupBy("conv_id", "turn", "nth").agg(
        F.sort_array(F.collect_list(event)).alias("events"))
    last = F.aggregate(F.transform("events", lambda e, i: F.when(e["resets"], i)), F.lit(0),
                       lambda a, b: F.greatest(a, b))
    grouped = grouped.withColumn("last", last)
    return grouped.select(
        "conv_id", "turn", "nth",
        F.coalesce(F.get(F.reverse(F.array_compact(F.transform("events", lambda e: e["role"]))), F.lit(0)),
                   F.lit("")).alias("role"),
        F.array_join(F.transform(F.slice("events", F.col("last") + 1, F.size("events")),
                                 lambda e: e["text"]), "").alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One formatted string per conversation, with the place of every turn and of its loss span.

    ``turns`` holds, in order, where a turn starts, how long it is, and where the text under the
    loss mask starts and how long it is (null for other roles); all in code points.
    """
    head = F.concat(F.lit(HEAD), escape(F.col("role")), F.lit(MIDDLE))
    body = escape(F.col("text"))
    rows = messages.select("conv_id", "turn", "nth", (F.col("role") == loss_role).alias("loss"),
                           head.alias("head"), body.alias("body"))
    length = F.length("head") + F.length("body") + len(TAIL)
    before = Window.partitionBy("conv_id").orderBy("turn", "nth").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("length", length).withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0)))
    turn = F.struct(
        "turn", "nth", F.concat("head", "body", F.lit(TAIL)).alias("piece"), "start", "length",
        F.when(F.col("loss"), F.col("start") + F.length("head")).alias("loss_start"),
        F.when(F.col("loss"), F.length("body")).alias("loss_length"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("all"))
    return rows.select(
        "conv_id", F.array_join(F.transform("all", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("all", lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"),
                                              t["loss_start"].alias("loss_start"),
                                              t["loss_length"].alias("loss_length"))).alias("turns"))


def read_back(rendered: DataFrame) -> DataFrame:
    """The turns of ``render``'s output, from its string and its spans: role, text and text under the mask."""
    parts = F.split("formatted", TAIL)
    rows = rendered.select("conv_id", "formatted", "turns", F.slice(parts, F.lit(1), F.size(parts) - 1).alias("parts"))

    def one(part: Column, turn: Column) -> Column:
        role = F.substring_index(part, MIDDLE, 1)
        text = F.substr(part, F.length(role) + len(MIDDLE) + 1)
        loss = F.substr(part, (turn["loss_start"] - turn["start"] + 1).cast("int"), turn["loss_length"])
        return F.struct(unescape(F.substr(role, F.lit(len(HEAD) + 1))).alias("role"),
                        unescape(text).alias("text"), unescape(loss).alias("loss"))

    return rows.select("conv_id", "formatted", F.zip_with("parts", "turns", one).alias("read"))
