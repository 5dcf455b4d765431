"""Conversations rebuilt from event logs and rendered for training, in DataFrame expressions only.

A log holds one row an event. Events of one message are folded first, so a conversation with many messages is many
groups: sorted by sequence, the last event that sets the text (``start``, ``edit``, ``regenerate``) discards what came
before it, and the deltas after it are appended. The final messages are then gathered by conversation and rendered.

A rendered conversation is one string. Control strings mark where a turn begins, where its text begins and where it
ends. The same strings inside roles and texts are escaped by a backslash after their first character (one more where
backslashes already stand there), so unescaping is exact and splitting at control strings finds the turns again. The
loss mask is a list of spans over the code points of the string: the texts of the roles that are learnt.

Source: Fowler, "Event Sourcing" (2005).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNT = ("assistant",)
# Code points of a delta, and lengths summed in one run.
DELTA_CHARS = 512
RUN = 256
RESETS = ("start", "edit", "regenerate")


@dataclass(frozen=True)
class Template:
    """The control strings: before a conversation, a turn and its text, and after it."""

    first: str = "<s>"
    turn: str = "[INST]"
    body: str = "[/INST]"
    end: str = "</s>"

    def __post_init__(self):
        marks = self.marks()
        inner = "".join(m[1:] for m in marks)
        if any(len(m) < 2 or "\\" in m for m in marks) or any(m[0] in inner for m in marks) or len(set(marks)) < 4:
            raise ValueError("control strings differ, have two characters or more, no backslash, and begin with a character that occurs nowhere else in them")

    def marks(self) -> tuple[str, ...]:
        return (self.first, self.turn, self.body, self.end)

    def _found(self, slashes: str) -> str:
        return "|".join(rf"(?<={re.escape(m[0])}){slashes}(?=\\*{re.escape(m[1:])})" for m in self.marks())

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._found(""), r"\\")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._found(r"\\"), "")


def log(df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chars: int = DELTA_CHARS) -> DataFrame:
    """The event log that streaming the rows of ``df`` leaves: ``conv, message, seq, kind, role, text``.

    Each text is streamed in deltas. A text of a learnt role is begun twice: the first attempt is regenerated after its
    first delta. Any other has its first delta edited. Messages are ordered by turn (null first), role, text; equal
    rows stay separate messages. Null roles and texts are empty.
    """
    who, what = F.coalesce(F.col(f"`{role}`"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    message = F.struct(F.col(f"`{turn}`").alias("turn"), who.alias("role"), F.xxhash64(what).alias("mark"), F.monotonically_increasing_id().alias("row"))
    rows = df.select(F.col(f"`{conv}`").alias("conv"), message.alias("message"), who.alias("role"), F.regexp_extract_all(what, F.lit(rf"(?s).{{1,{chars}}}"), F.lit(0)).alias("cut"))

    def event(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col("role").alias("role"), value.alias("text"))

    deltas = F.transform("cut", lambda c: event("delta", c))
    begun = F.array(event("start", F.lit("")))
    again = F.concat(begun, F.slice(deltas, 1, 1), F.array(event("regenerate", F.lit(""))), deltas)
    edited = F.concat(begun, F.slice(deltas, 1, 1), F.transform(F.slice("cut", 1, 1), lambda c: event("edit", c)), F.slice(deltas, 2, 2_000_000_000))
    events = rows.select("conv", "message", F.posexplode(F.when(F.col("role").isin(*LEARNT), again).otherwise(edited)).alias("seq", "event"))
    return events.select("conv", "message", F.col("seq").cast("bigint").alias("seq"), "event.kind", "event.role", "event.text")


def fold(events: DataFrame) -> DataFrame:
    """``conv, message, role, text`` of every message of a log; ``message`` may be anything that sorts.

    Sequence numbers order the events of a message; events with equal ones take the order of kind, role and text.
    A message without a resetting event is made of its deltas. Its role is the first one named. Null texts are empty.
    """
    event = F.struct("seq", F.col("kind").isin(*RESETS).alias("resets"), "role", F.coalesce("text", F.lit("")).alias("text"))
    sorted_events = F.array_sort(F.collect_list(event))
    held = events.groupBy("conv", "message").agg(sorted_events.alias("events"))
    last = F.array_max(F.transform("events", lambda e, i: F.when(e["resets"], i).otherwise(0)))
    held = held.select("conv", "message", "events", last.alias("last"))
    kept = F.expr("slice(events, last + 1, size(events))")
    role = F.coalesce(F.get(F.filter("events", lambda e: e["role"].isNotNull()), F.lit(0))["role"], F.lit(""))
    return held.select("conv", "message", role.alias("role"), F.array_join(F.transform(kept, lambda e: e["text"]), "").alias("text"))


def running(lengths: str) -> Column:
    """The sum of all entries before each one of a bigint array column, in runs so that long arrays stay cheap."""
    total = "aggregate({}, 0L, (s, x) -> s + x)".format
    return F.expr(
        f"""CASE WHEN size({lengths}) = 0 THEN array() ELSE flatten(transform(
            transform(sequence(0, (size({lengths}) - 1) div {RUN}), c -> struct(slice({lengths}, c * {RUN} + 1, {RUN}) AS own,
                CASE WHEN c = 0 THEN 0L ELSE {total(f"slice({lengths}, 1, c * {RUN})")} END AS base)),
            r -> transform(r.own, (x, i) -> r.base + {total("slice(r.own, 1, i)")}))) END"""
    )


def render(messages: DataFrame, template: Template = Template(), learnt: tuple[str, ...] = LEARNT) -> DataFrame:
    """``conv, formatted string, loss array<struct<start bigint, length bigint>>`` of every conversation.

    ``messages`` are those of ``fold``, ordered by ``message``. Spans count code points from 0; an empty text of a
    learnt role has a span of length 0. A conversation is one string of at most 2 GB.
    """
    head = F.concat(F.lit(template.turn), template.escape(F.col("role")), F.lit(template.body))
    body = template.escape(F.col("text"))
    cut = messages.select("conv", "message", F.col("role").isin(*learnt).alias("learnt"), head.alias("head"), body.alias("body"))
    turn = F.struct("message", "learnt", "head", "body")
    held = cut.groupBy("conv").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    lengths = F.transform("turns", lambda t: (F.char_length(t["head"]) + F.char_length(t["body"]) + len(template.end)).cast("bigint"))
    held = held.select("conv", "turns", lengths.alias("lengths"))
    held = held.select("conv", "turns", running("lengths").alias("begins"))
    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(template.end)))
    spans = F.transform(
        F.filter(F.arrays_zip("turns", "begins"), lambda z: z["turns"]["learnt"]),
        lambda z: F.struct(
            (z["begins"] + F.char_length(z["turns"]["head"]) + len(template.first)).cast("bigint").alias("start"),
            F.char_length(z["turns"]["body"]).cast("bigint").alias("length"),
        ),
    )
    return held.select("conv", F.concat(F.lit(template.first), F.array_join(pieces, "")).alias("formatted"), spans.alias("loss"))


def read_back(rendered: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv, formatted, turns array<struct<role, text>>, lost array<string>``: the turns and the texts under the mask.

    Both come from the string alone: turns between control strings, masked texts where a span begins at a text.
    """
    first, end = len(template.first), len(template.end)
    pieces = F.split(F.substr("formatted", F.lit(first + 1)), F.lit(re.escape(template.end)), -1)
    parts = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.split(F.substr(p, F.lit(len(template.turn) + 1)), re.escape(template.body), 2))
    made = rendered.select("conv", "formatted", "loss", parts.alias("parts"))
    around = len(template.turn) + len(template.body)
    lengths = F.transform("parts", lambda p: (F.char_length(p[0]) + F.char_length(p[1]) + around + end).cast("bigint"))
    made = made.select("*", lengths.alias("lengths"))
    made = made.select("conv", "formatted", "loss", "parts", running("lengths").alias("begins"))
    # spans and texts sorted together by where they begin; a span stands just before its text
    texts = F.transform(
        F.arrays_zip("parts", "begins"),
        lambda z: F.struct((z["begins"] + F.char_length(z["parts"][0]) + around + first).cast("bigint").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("length"), z["parts"][1].alias("text")),
    )
    marks = F.transform("loss", lambda s: F.struct(s["start"].alias("at"), F.lit(0).alias("kind"), s["length"].alias("length"), F.lit(None).cast("string").alias("text")))
    made = made.select("conv", "formatted", "parts", F.array_sort(F.concat(marks, texts)).alias("met"))
    under = F.expr(
        """transform(filter(transform(met, (m, i) -> struct(m.kind AS kind, m.text AS text, get(met, i - 1) AS mark, m.at AS at)),
            m -> m.kind = 1 AND m.mark.kind = 0 AND m.mark.at = m.at), m -> substring(m.text, 1, CAST(m.mark.length AS INT)))"""
    )
    turns = F.transform("parts", lambda p: F.struct(template.unescape(p[0]).alias("role"), template.unescape(p[1]).alias("text")))
    return made.select("conv", "formatted", turns.alias("turns"), F.transform(under, template.unescape).alias("lost"))


def format_log(events: DataFrame, template: Template = Template(), learnt: tuple[str, ...] = LEARNT) -> DataFrame:
    """Fold a log and render its conversations: see ``fold`` and ``render``. An empty log gives an empty result."""
    return render(fold(events), template, learnt)
