"""Chat formatting by a finite-state machine (DataFrame operations only).

A ``Template`` declares the machine: for each state, the roles that may follow,
the next state, and whether the turn's text is trained on.  A role that may not
follow is still written out, by the machine's ``otherwise`` row for it; the
conversation is then marked as not valid.  Each turn becomes three segments,
header, text and end mark, of which only the text of a trained role is under the
loss.  Control strings inside roles and texts are escaped by two-character codes,
so the marks occur in the output only as marks and ``read_back`` is exact.

All turns of a conversation meet in one row, because the formatted conversation
is one value: one shuffle by conversation.  The machine runs over the turns in
blocks of ``BLOCK``, so that the states of n turns cost n * (BLOCK + n / BLOCK)
copied references, not n * n.

Edge cases: a null text or role is the empty string; an unknown role is written
as it is, leaves the state and is not valid; turns are ordered by turn, role and
text, nulls first, so repeated rows are kept and ties have one order; rows
without a conversation id are one conversation with a null id; an empty table
gives an empty result; further columns are not read.  A formatted conversation
must fit one value (2 GB).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256


@dataclass(frozen=True)
class Move:
    state: str  # after the turn
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """The machine and its marks.  ``otherwise`` holds the moves of roles that
    come out of order; ``codes`` maps control strings to their escapes (the
    escape character itself comes first)."""

    start: str
    moves: dict[str, dict[str, Move]]
    otherwise: dict[str, Move]
    final: tuple[str, ...]
    opening: str = "### "
    after_role: str = ": "
    closing: str = "</turn>\n"
    codes: tuple[tuple[str, str], ...] = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
    role_codes: tuple[tuple[str, str], ...] = field(default=((":", "\\c"),))


#: An optional system turn, then user and assistant in turn, ending with the assistant.
CHAT = Template(
    start="start",
    moves={
        "start": {"system": Move("briefed"), "user": Move("asked")},
        "briefed": {"user": Move("asked")},
        "asked": {"assistant": Move("answered", loss=True)},
        "answered": {"user": Move("asked")},
    },
    otherwise={"system": Move("briefed"), "user": Move("asked"), "assistant": Move("answered", loss=True)},
    final=("answered",),
)


def _escaped(text: Column, codes) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def _unescaped(text: Column, codes) -> Column:
    """Every escape character in an escaped text starts a code, so codes can be
    undone one kind after the other; the escape character's own comes last."""
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _role_codes(t: Template):
    return (*t.codes, *t.role_codes)


def _step(t: Template, state: Column, role: Column) -> Column:
    """(state, loss, ok) of one turn."""
    def row(move: Move, ok: bool) -> Column:
        return F.struct(F.lit(move.state).alias("state"), F.lit(move.loss).alias("loss"), F.lit(ok).alias("ok"))

    out = F.struct(state.alias("state"), F.lit(False).alias("loss"), F.lit(False).alias("ok"))
    for name, move in t.otherwise.items():
        out = F.when(role == name, row(move, False)).otherwise(out)
    for at, moves in t.moves.items():
        for name, move in moves.items():
            out = F.when((state == at) & (role == name), row(move, True)).otherwise(out)
    return out


def _run(t: Template, turns: Column) -> Column:
    """The machine's (state, loss, ok) for each turn, in order."""
    empty = F.array().cast("array<struct<state:string,loss:boolean,ok:boolean>>")

    def block(acc: Column, first: Column) -> Column:
        inner = F.aggregate(
            F.slice(turns, first, BLOCK), F.struct(acc["state"].alias("state"), empty.alias("steps")),
            lambda a, turn: F.transform(F.array(_step(t, a["state"], turn["role"])), lambda s: F.struct(
                s["state"].alias("state"), F.concat(a["steps"], F.array(s)).alias("steps")))[0])
        return F.transform(F.array(inner), lambda i: F.struct(
            i["state"].alias("state"), F.concat(acc["blocks"], F.array(i["steps"])).alias("blocks")))[0]

    start = F.struct(F.lit(t.start).alias("state"),
                     F.array().cast("array<array<struct<state:string,loss:boolean,ok:boolean>>>").alias("blocks"))
    return F.aggregate(F.sequence(F.lit(1), F.size(turns), F.lit(BLOCK)), start, block, lambda a: F.flatten(a["blocks"]))


def format_chat(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """(conv_id, segments array<struct<text, loss>>, valid, first_bad_turn): one
    row a conversation.  ``first_bad_turn`` counts from 1; it is null where every
    turn is in order, and then the conversation is valid if its last state is final."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    turn = F.struct(F.col("turn"), text("role").alias("role"), text("text").alias("text"))
    grouped = conversations.select("conv_id", turn.alias("turn")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("turn")).alias("turns"))
    # a zip, because a lambda that holds an expression computes it for each element
    stepped = grouped.select("conv_id", F.arrays_zip(F.col("turns").alias("turn"), _run(template, F.col("turns")).alias("step"))
                             .alias("rows"))

    def segments(row: Column) -> Column:
        header = F.concat(F.lit(template.opening), _escaped(row["turn"]["role"], _role_codes(template)), F.lit(template.after_role))
        parts = ((header, F.lit(False)), (_escaped(row["turn"]["text"], template.codes), row["step"]["loss"]),
                 (F.lit(template.closing), F.lit(False)))
        return F.array(*[F.struct(x.alias("text"), loss.alias("loss")) for x, loss in parts])

    bad = F.array_position(F.transform("rows", lambda r: r["step"]["ok"]), False)
    last = F.element_at("rows", -1)["step"]["state"]
    return stepped.select("conv_id", F.flatten(F.transform("rows", segments)).alias("segments"),
                          ((bad == 0) & last.isin(*template.final)).alias("valid"),
                          F.nullif(bad, F.lit(0).cast("long")).alias("first_bad_turn"))


def formatted(segments: str = "segments") -> Column:
    """The text a model is trained on."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def trained(segments: str = "segments", template: Template = CHAT) -> Column:
    """The text under the loss, unescaped."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: _unescaped(s["text"], template.codes)), "")


def read_back(text: Column, template: Template = CHAT) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    parts = F.split(text, re.sub(r"([^A-Za-z0-9\s])", r"\\\1", template.closing), -1)
    bodies = F.transform(F.filter(parts, lambda p: p.startswith(template.opening)),
                         lambda p: F.substr(p, F.lit(len(template.opening) + 1)))

    def turn(body: Column) -> Column:
        name = F.substring_index(body, template.after_role, 1)
        said = F.substr(body, F.char_length(name) + F.lit(len(template.after_role) + 1))
        return F.struct(_unescaped(name, _role_codes(template)).alias("role"), _unescaped(said, template.codes).alias("text"))

    return F.transform(bodies, turn)


#: The conversation that holds marks and escapes inside its texts.
PROBE_ID = -7
PROBE = r"\### Assistant: </turn> ok"


def chat_digest(conversations: DataFrame) -> DataFrame:
    """One row a conversation, all read back from the formatted output."""
    types = {c: t for c, t in conversations.dtypes}
    probe = conversations.sparkSession.createDataFrame(
        [(PROBE_ID, 0, "user", PROBE), (PROBE_ID, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(
        probe.select(F.col("conv_id").cast(types["conv_id"]), F.col("turn").cast(types["turn"]), "role", "text"))
    out = format_chat(rows).select("conv_id", "valid", formatted().alias("formatted"), trained().alias("trained"))
    out = out.select("*", read_back(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                      F.char_length("trained").cast("long").alias("loss_chars"),
                      F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")
