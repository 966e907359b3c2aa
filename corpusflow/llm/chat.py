"""Chat formatting: a finite-state machine over roles and a declarative template.

The template states the marks around the text of each role and whether the text counts for the loss;
the machine states which role may follow which. Control strings inside a text or a role are escaped
by one backslash after their first character (``</s>`` becomes ``<\\/s>``, which becomes ``<\\\\/s>``),
so a formatted conversation can be cut back into its turns without loss.

Defined cases: a null text is empty and a null role is the empty role; roles without an entry in the
template are written with the entry ``""``, their name in front of the text; turns are ordered by
(turn, role, text), nulls first, and repeated rows are repeated turns; rows with a null conversation
id form one conversation. An invalid order is formatted all the same, with ``valid`` false. Columns
beside the four that are named are not read, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role; the role ``""`` stands for any other, and ``start`` opens a conversation."""

    start: str = "<s>"
    roles: dict[str, Role] = field(default_factory=lambda: {
        "system": Role("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": Role("[INST] ", " [/INST]"),
        "assistant": Role("<|a|> ", "</s>", loss=True),
        "": Role("<|r|>", "<|/r|>"),
    })
    control: tuple[str, ...] = (
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|a|>", "<|r|>", "<|:|>", "<|/r|>",
    )
    #: Between the name and the text of a role without an entry of its own.
    colon: str = "<|:|>"
    #: state -> role -> next state; the role of a state is its name.
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    final: tuple[str, ...] = ("user", "assistant")


def escape(text: Column, template: Template) -> Column:
    """One more backslash after the first character of every control string in ``text``."""
    for first, rests in _by_first(template).items():
        text = F.regexp_replace(text, f"{re.escape(first)}(\\\\*)({rests})", f"{_dollar(first)}\\\\$1$2")
    return text


def unescape(text: Column, template: Template) -> Column:
    for first, rests in _by_first(template).items():
        text = F.regexp_replace(text, f"{re.escape(first)}\\\\(\\\\*)({rests})", f"{_dollar(first)}$1$2")
    return text


def _dollar(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def _by_first(template: Template) -> dict[str, str]:
    firsts = dict.fromkeys(c[0] for c in template.control)
    return {f: "|".join(re.escape(c[1:]) for c in template.control if c[0] == f) for f in firsts}


def _role_case(role: Column, template: Template, value) -> Column:
    """``value(name, entry)`` of the entry of a role; the entry ``""`` for roles without one."""
    out = None
    for name, entry in template.roles.items():
        if name:
            found = value(name, entry)
            out = F.when(role == name, found) if out is None else out.when(role == name, found)
    other = value("", template.roles[""])
    return other if out is None else out.otherwise(other)


def valid_order(roles: Column, template: Template) -> Column:
    """Whether the machine takes a list of roles from ``start`` to a final state."""
    pairs = [F.lit(f"{state}>{role}") for state, nexts in template.moves.items() for role in nexts]
    allowed = F.array(*pairs)

    def step(state: Column, role: Column) -> Column:
        return F.when(F.array_contains(allowed, F.concat(state, F.lit(">"), role)), role).otherwise(F.lit("!"))

    return F.aggregate(roles, F.lit("start"), step).isin(*template.final)


def format_chat(
    turns: DataFrame,
    template: Template = Template(),
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(id, segments, formatted, valid) per conversation.

    ``segments`` is a list of (text, loss) whose texts on end are ``formatted``.
    """
    said = F.coalesce(F.col(text), F.lit(""))
    who = F.coalesce(F.col(role), F.lit(""))
    rows = turns.select(F.col(conv_id).alias("_id"), F.struct(
        F.col(turn).alias("at"), who.alias("role"), escape(said, template).alias("text"),
    ).alias("row"))
    # One conversation is one result row, so its turns have to meet; they meet once, escaped.
    gathered = rows.groupBy("_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def segments(row: Column) -> Column:
        def of(name: str, entry: Role) -> Column:
            head = F.lit(entry.before)
            if not name:
                head = F.concat(head, escape(row["role"], template), F.lit(template.colon))
            return F.array(
                F.struct(head.alias("text"), F.lit(False).alias("loss")),
                F.struct(row["text"].alias("text"), F.lit(entry.loss).alias("loss")),
                F.struct(F.lit(entry.after).alias("text"), F.lit(False).alias("loss")),
            )

        return _role_case(row["role"], template, of)

    opening = F.array(F.struct(F.lit(template.start).alias("text"), F.lit(False).alias("loss")))
    parts = F.concat(opening, F.flatten(F.transform("rows", segments)))
    return gathered.select(
        F.col("_id").alias(conv_id),
        parts.alias("segments"),
        F.array_join(F.transform(parts, lambda s: s["text"]), "").alias("formatted"),
        valid_order(F.transform("rows", lambda r: r["role"]), template).alias("valid"),
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The list of (role, text) that a formatted conversation was made of."""
    names = [n for n in template.roles if n]

    def around(entry: Role, head: str = "") -> str:
        return f"{re.escape(entry.before)}{head}(?s:.*?){re.escape(entry.after)}"

    either = "|".join(around(template.roles[n]) for n in [*names, ""])
    body = F.substring(formatted, len(template.start) + 1, 2_147_483_647)
    pieces = F.regexp_extract_all(body, F.lit(f"({either})"), 1)

    def turn_of(piece: Column) -> Column:
        def inner(entry: Role) -> Column:
            return F.substr(
                piece, F.lit(len(entry.before) + 1), F.length(piece) - F.lit(len(entry.before) + len(entry.after))
            )

        rest = inner(template.roles[""])
        at = F.instr(rest, template.colon)
        out = None
        for name in names:
            entry = template.roles[name]
            value = F.struct(F.lit(name).alias("role"), unescape(inner(entry), template).alias("text"))
            test = F.startswith(piece, F.lit(entry.before))
            out = F.when(test, value) if out is None else out.when(test, value)
        return out.otherwise(F.struct(
            unescape(F.substr(rest, F.lit(1), at - 1), template).alias("role"),
            unescape(F.substr(rest, at + F.lit(len(template.colon)), F.length(rest)), template).alias("text"),
        ))

    return F.transform(pieces, turn_of)
