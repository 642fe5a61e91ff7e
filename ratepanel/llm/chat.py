"""Chat formatting: a finite-state machine over roles, segments with loss flags.

A template is data: for each role the text before and after a turn and whether
the turn counts for the loss, a form for any other role, and the machine's
transitions. `segments` turns the turns of a conversation into segments (marker
or text, each with its flag) and says whether their order is one the machine
accepts; `formatted` joins them; `read_back` recovers roles and texts from the
formatted string alone.

Control strings inside texts and role names are broken by a backslash after their
first character, and backslashes are doubled before. A control string then holds
no backslash and no text holds a control string, so the string can be taken apart
at the markers, and removing the backslashes gives the text back.

Defined cases: a null text and a null role are empty strings. Turns are ordered
by turn number (null first), then role, then text; repeated rows stay repeated
turns. An order the machine refuses is formatted like any other and marked by
`valid`, so no conversation is lost. Conversations of a null id form one
conversation. An empty table gives an empty result. Extra columns are ignored.
Everything is built of native functions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """What stands around the turns of a role, and whether they count for the loss."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Markers by role, markers for other roles, and the machine."""

    roles: Mapping[str, Turn]
    #: The role's name stands between the two parts of the marker.
    other: tuple[str, str, str]
    #: state -> role -> next state.
    moves: Mapping[str, Mapping[str, str]]
    begin: str = "start"
    accepting: frozenset[str] = field(default_factory=frozenset)

    def control(self) -> list[str]:
        """Every string that may not stand in a text."""
        return sorted({m.strip() for t in self.roles.values() for m in (t.before, t.after)} | {m.strip() for m in self.other})


INSTRUCT = Template(
    roles={
        "system": Turn("<<SYS>>", "<</SYS>>"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("<s>", "</s>", loss=True),
    },
    other=("<<ROLE>>", "<<SAYS>>", "<</ROLE>>"),
    moves={
        "start": {"system": "told", "user": "asked"},
        "told": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    },
    accepting=frozenset({"answered"}),
)


def escape(text: Column, template: Template) -> Column:
    """The text without control strings."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in template.control():
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column, template: Template) -> Column:
    """The text as it was."""
    out = text
    for mark in template.control():
        out = F.replace(out, F.lit(mark[0] + "\\" + mark[1:]), F.lit(mark))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def _final_state(roles: Column, template: Template) -> Column:
    step = F.create_map(*[F.lit(x) for s, ms in template.moves.items() for role, to in ms.items() for x in (f"{s} {role}", to)])
    return F.aggregate(roles, F.lit(template.begin), lambda state, role: F.coalesce(F.try_element_at(step, F.concat(state, F.lit(" "), role)), F.lit("refused")))


def _segment(text: Column | str, loss: bool) -> Column:
    return F.struct((F.lit(text) if isinstance(text, str) else text).alias("text"), F.lit(loss).alias("loss"))


def _turn_segments(turn: Column, template: Template) -> Column:
    said = escape(turn["text"], template)
    one, between, end = template.other
    out = F.array(
        _segment(F.concat(F.lit(one), escape(turn["role"], template), F.lit(between)), False), _segment(said, False), _segment(end, False)
    )
    for role, marks in template.roles.items():
        parts = F.array(_segment(marks.before, False), _segment(said, marks.loss), _segment(marks.after, False))
        out = F.when(turn["role"] == role, parts).otherwise(out)
    return out


def segments(
    rows: DataFrame,
    template: Template = INSTRUCT,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: id, number of turns, `valid`, and `segments array<struct<text, loss>>`."""
    said = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    # A conversation is one row of the result, so its turns meet by contract.
    turns = rows.select(F.col(f"`{conversation}`").alias("id"), said.alias("said")).groupBy("id").agg(F.sort_array(F.collect_list("said")).alias("turns"))
    roles = F.transform("turns", lambda t: t["role"])
    return turns.select(
        F.col("id").alias(conversation),
        F.size("turns").cast("long").alias("n_turns"),
        _final_state(roles, template).isin(*sorted(template.accepting)).alias("valid"),
        F.flatten(F.transform("turns", lambda t: _turn_segments(t, template))).alias("segments"),
    )


def formatted(parts: Column) -> Column:
    """The segments as one string."""
    return F.array_join(F.transform(parts, lambda s: s["text"]), "")


def loss_mask(parts: Column) -> Column:
    """`array<struct<begin, length>>` of the characters of the formatted string that count for the loss."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,length:int>>").alias("spans"))
    walked = F.aggregate(
        parts,
        begin,
        lambda acc, s: F.struct(
            (acc["at"] + F.length(s["text"])).alias("at"),
            F.when(s["loss"], F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("begin"), F.length(s["text"]).alias("length")))))
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
    )
    return walked["spans"]


def _quoted(mark: str) -> str:
    return "\\Q" + mark + "\\E"


def read_back(whole: Column, template: Template = INSTRUCT) -> Column:
    """`array<struct<role, text>>` of a formatted string; markers occur in it as markers only."""
    one, between, end = template.other
    forms = [f"{_quoted(t.before)}.*?{_quoted(t.after)}" for t in template.roles.values()]
    forms.append(f"{_quoted(one)}.*?{_quoted(end)}")
    found = F.regexp_extract_all(whole, F.lit("(?s)" + "|".join(forms)), F.lit(0))

    def parse(part: Column) -> Column:
        inner = F.substring(part, F.lit(len(one) + 1), F.length(part) - len(one) - len(end))
        cut = F.instr(inner, between)
        out = F.struct(
            unescape(F.substring(inner, F.lit(1), cut - 1), template).alias("role"),
            unescape(F.substring(inner, cut + len(between), F.length(inner)), template).alias("text"),
        )
        for role, marks in template.roles.items():
            said = F.substring(part, F.lit(len(marks.before) + 1), F.length(part) - len(marks.before) - len(marks.after))
            out = F.when(F.startswith(part, F.lit(marks.before)), F.struct(F.lit(role).alias("role"), unescape(said, template).alias("text"))).otherwise(out)
        return out

    return F.transform(found, parse)


def digest(parts: DataFrame, template: Template = INSTRUCT, conversation: str = "conv_id") -> DataFrame:
    """Counts and digests of each conversation, read back from its formatted string and its mask."""
    whole = parts.select(
        f"`{conversation}`", "n_turns", "valid", formatted(F.col("segments")).alias("whole"), loss_mask(F.col("segments")).alias("mask")
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    # A masked span is one whole escaped text.
    learned = F.array_join(F.transform("mask", lambda m: unescape(F.substring(F.col("whole"), m["begin"] + 1, m["length"]), template)), "")
    read = whole.select("*", read_back(F.col("whole"), template).alias("turns"), learned.alias("learned"))
    return read.select(
        f"`{conversation}`",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("whole").cast("long").alias("formatted_chars"),
        "valid",
    )
