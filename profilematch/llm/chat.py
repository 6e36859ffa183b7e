"""Chat formatting: a state machine checks the order of turns; a template gives text segments with loss flags.

DataFrame functions only. Marks begin with ``<`` or ``[``, and texts have these (and ``]`` and ``~``) replaced, so a
mark never occurs in a text and every text can be read back. A role that the template doesn't name gets the general
mark, with the role inside it. Null texts and roles are empty; a null conv_id is one conversation. Turns are ordered by
turn (null first), then role, then text, so ties have one result; a repeated row is a turn of its own. An empty table
gives no rows. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    opens: str
    closes: str
    loss: bool


#: role: how its turns are marked, and whether its text is trained on
TEMPLATE = {
    "system": Turn("[SYS]", "[/SYS]", False),
    "user": Turn("[INST]", "[/INST]", False),
    "assistant": Turn("[OUT]", "</s>", True),
}
START = "<s>"
OTHER = ("[ROLE=", "]", "[/ROLE]")
#: state: {role: next state}; a turn without an entry is out of order
MACHINE = {
    "start": {"system": "ready", "user": "asked"},
    "ready": {"user": "asked"},
    "asked": {"assistant": "answered"},
    "answered": {"user": "asked"},
}
ACCEPTED = ("answered",)
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"), ("]", "~3"))
_MARKED = r"(\[[^\[\]<]*\])([^\[\]<]*)(\[/[A-Z]+\]|</s>)"


def escape(c: Column) -> Column:
    for plain, code in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def _of_role(role: Column, field, other: Column) -> Column:
    out = F.when(F.lit(False), other)
    for name, turn in TEMPLATE.items():
        out = out.when(role == name, F.lit(field(turn)))
    return out.otherwise(other)


def _next(state: Column, role: Column) -> Column:
    table = F.create_map(
        *[F.lit(x) for s, moves in MACHINE.items() for r, to in moves.items() for x in (f"{s} {r}", to)]
    )
    return F.coalesce(F.element_at(table, F.concat(state, F.lit(" "), role)), F.lit("rejected"))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, valid, segments (role, text, loss), formatted.

    The text of each turn is marked and escaped before turns of one conversation meet.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    opens = _of_role(role, lambda t: t.opens, F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1])))
    closes = _of_role(role, lambda t: t.closes, F.lit(OTHER[2]))
    loss = _of_role(role, lambda t: t.loss, F.lit(False))
    segments = F.array(
        F.struct(role.alias("role"), opens.alias("text"), F.lit(False).alias("loss")),
        F.struct(role.alias("role"), escape(text).alias("text"), loss.alias("loss")),
        F.struct(role.alias("role"), closes.alias("text"), F.lit(False).alias("loss")),
    )
    rows = turns.select("conv_id", F.struct("turn", role.alias("role"), text.alias("raw"), segments.alias("segments")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    begin = F.array(F.struct(F.lit("").alias("role"), F.lit(START).alias("text"), F.lit(False).alias("loss")))
    state = F.aggregate("turns", F.lit("start"), lambda s, t: _next(s, t["role"]))
    parts = F.concat(begin, F.flatten(F.transform("turns", lambda t: t["segments"])))
    return (
        whole.select("conv_id", state.isin(*ACCEPTED).alias("valid"), parts.alias("segments"))
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    )


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns that a formatted text holds."""
    opens = F.regexp_extract_all(formatted, F.lit(_MARKED), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(_MARKED), F.lit(2))
    return F.zip_with(opens, texts, lambda o, t: F.struct(_role_of(o).alias("role"), unescape(t).alias("text")))


def _role_of(opens: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for name, turn in TEMPLATE.items():
        out = out.when(opens == turn.opens, F.lit(name))
    inner = F.substring(opens, len(OTHER[0]) + 1, F.length(opens) - len(OTHER[0]) - len(OTHER[1]))
    return out.otherwise(unescape(inner))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    under = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return F.array_join(under, "")
