"""Chat formatting (DataFrame functions only).

A declarative ``Template`` names the control strings, the roles under the loss
mask and a finite-state machine over roles.  A conversation becomes segments
(text, loss) whose texts, joined, are the formatted conversation; the machine
reports the first turn that is out of order and whether the conversation ends
in a final state.  Invalid conversations are formatted and flagged, never
dropped.

Escaping is reversible: in texts a ``<`` followed by any number of
backslashes and ``|`` gets one backslash more, so no control string can occur
in a text.  In roles ``%``, line feeds and ``|`` after ``<`` are written as
%25, %0A and %7C.

A conversation is one output row, so its turns meet in one task; nothing else is
grouped.  Turns order by turn (nulls last), then role, then text; repeated rows
are turns of their own.  A null text or role is empty; a null conversation id
is a conversation.  An empty table gives an empty result; columns other than
the four named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    open: str = "<|im_start|>"
    close: str = "<|im_end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    final: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state
    order: dict = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user"},
        }
    )


CHATML = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<|"), F.lit("<%7C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%7C"), F.lit("|")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _walk(roles: Column, t: Template) -> Column:
    """struct(state, at, bad): the machine's end state and its first bad turn."""

    def step(acc: Column, role: Column) -> Column:
        to = F.lit(None).cast("string")
        for state, moves in t.order.items():
            for name, after in moves.items():
                to = F.when((acc["state"] == state) & (role == name), F.lit(after)).otherwise(to)
        bad = F.coalesce(acc["bad"], F.when(to.isNull(), acc["at"]))
        return F.struct(F.coalesce(to, acc["state"]).alias("state"), (acc["at"] + 1).alias("at"), bad.alias("bad"))

    zero = F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))
    return F.aggregate(roles, zero, step)


def format_chat(turns: DataFrame, template: Template = CHATML, *, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """(conv_id, formatted, segments array<struct<text, loss>>, bad_turn, valid)."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    one = F.struct(F.col(turn_col).isNull().alias("last"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    convs = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(one)).alias("turns"))

    def segment(s: Column, loss: Column) -> Column:
        return F.struct(s.alias("text"), loss.alias("loss"))

    def parts(t: Column) -> Column:
        head = F.concat(F.lit(template.open), escape_role(t["role"]), F.lit("\n"))
        trained = t["role"].isin(*template.loss_roles)
        return F.array(segment(head, F.lit(False)), segment(escape(t["text"]), trained), segment(F.lit(template.close + "\n"), F.lit(False)))

    out = convs.withColumn("segments", F.flatten(F.transform("turns", parts)))
    out = out.withColumn("walk", _walk(F.transform("turns", lambda t: t["role"]), template))
    return out.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        F.col("walk.bad").alias("bad_turn"),
        (F.col("walk.bad").isNull() & F.col("walk.state").isin(*template.final)).alias("valid"),
    )


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """array<struct<role, text>> parsed from a formatted conversation."""
    pieces = F.split(formatted, "\\Q" + template.close + "\n\\E")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    bare = F.transform(pieces, lambda p: F.substring(p, len(template.open) + 1, 2_147_483_647))

    def turn(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        body = F.substring(p, F.char_length(head) + 2, F.lit(2_147_483_647))
        return F.struct(unescape_role(head).alias("role"), unescape(body).alias("text"))

    return F.transform(bare, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped segment by segment."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
