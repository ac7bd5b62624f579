"""Chat formatting from a declarative template, in DataFrame expressions only.

A template names the control strings around a turn and a finite-state machine over roles. The machine
reads a conversation's roles in turn order; every move leads to a state and says whether the turn's text
is under the loss. What it emits, turn by turn, becomes the text segments with their loss flags; a role
it has no move for leads to the error state, which it does not leave, and there the template says whether
texts are still under the loss. Control strings all begin with the same two characters; a backslash
between these, and doubled backslashes, make sure that no text or role holds a control string, and undo
without loss, so the output can be read back.

Turns are ordered by turn number, then role, then text; null numbers come first. Defined cases: a null
text is empty, a null role is the empty role; repeated rows are turns of their own; each row without a
conversation id is a conversation of one turn; an empty table gives no conversations. Other columns are
not read. A conversation is one output row, so its turns meet in one task, which holds them; very long
texts count there with their length. Conversations never meet.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Template(NamedTuple):
    opens: str
    body: str
    closes: str
    trained: tuple[str, ...]  # roles whose texts are under the loss
    moves: dict[tuple[str, str], str]  # (state, role): next state
    start: str
    accepts: tuple[str, ...]
    error: str = "error"
    error_trains: bool = True  # whether trained roles keep their loss once the machine is in its error state


TURNS = Template(
    opens="<|turn|>",
    body="<|body|>",
    closes="<|end|>\n",
    trained=("assistant",),
    moves={
        ("start", "system"): "instructed",
        ("start", "user"): "asked",
        ("instructed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
    start="start",
    accepts=("answered",),
)
#: The same turns, but what follows a wrong turn, and the wrong turn itself, is not learned from.
STRICT = TURNS._replace(error_trains=False)
#: Turns that the machine reads at a time: what it emitted before them is not copied for each turn.
STRETCH = 64


def _check(template: Template) -> None:
    marks = (template.opens, template.body, template.closes)
    if any(not m.startswith("<|") for m in marks) or len(set(marks)) < 3:
        raise ValueError("control strings must differ and begin with <|")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _quoted(mark: str) -> str:
    return "".join("\\" + c if c in "<|>[](){}.*+?^$\\" else c for c in mark)


def machine(roles: Column, template: Template = TURNS) -> Column:
    """What the machine emits for an array of roles: a struct of state and loss for each of them."""
    wrong = lambda role: F.struct(F.lit(template.error).alias("state"), (role.isin(*template.trained) if template.error_trains else F.lit(False)).alias("loss"))
    moves = F.create_map(
        *[x for (state, role), to in template.moves.items() for x in (F.lit(f"{state}\n{role}"), F.struct(F.lit(to).alias("state"), F.lit(role in template.trained).alias("loss")))]
    )
    begin = F.array(F.struct(F.lit(template.start).alias("state"), F.lit(False).alias("loss")))
    move = lambda done, role: F.array_append(done, F.coalesce(F.try_element_at(moves, F.concat_ws("\n", F.element_at(done, -1)["state"], role)), wrong(role)))
    # Each stretch begins with the last emission of the one before it.
    stretch = lambda done, k: F.array_append(done, F.aggregate(F.slice(roles, k * STRETCH + 1, F.lit(STRETCH)), F.slice(F.element_at(done, -1), -1, 1), move))
    stretches = F.aggregate(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(roles) - 1) / STRETCH).cast("int"))), F.array(begin), stretch)
    return F.flatten(F.transform(stretches, lambda s, i: F.when(i == 0, F.slice(s, 2, 0)).otherwise(F.slice(s, F.lit(2), F.greatest(F.lit(0), F.size(s) - 1)))))


def format_conversations(
    turns: DataFrame, template: Template = TURNS, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(id, segments, formatted, state, valid): a row per conversation; segments are structs of text and loss."""
    _check(template)
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    alone = F.when(F.col(f"`{conv_col}`").isNull(), F.monotonically_increasing_id())
    rows = turns.select(F.col(f"`{conv_col}`").alias("_id"), alone.alias("_alone"), F.struct(F.col(f"`{turn_col}`").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text")).alias("t"))
    grouped = rows.groupBy("_id", "_alone").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    read = grouped.select("_id", "turns", machine(F.transform("turns", lambda t: t["role"]), template).alias("out"))
    piece = lambda value, loss: F.struct(value.alias("text"), loss.alias("loss"))
    emit = lambda t, out: F.array(
        piece(F.concat(F.lit(template.opens), escape(t["role"]), F.lit(template.body)), F.lit(False)),
        piece(escape(t["text"]), out["loss"]),
        piece(F.lit(template.closes), F.lit(False)),
    )
    done = read.select("_id", F.flatten(F.zip_with("turns", "out", emit)).alias("segments"), F.element_at("out", -1)["state"].alias("state"))
    return done.select(
        F.col("_id").alias(conv_col), "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "state", F.col("state").isin(*template.accepts).alias("valid")
    )


def read_turns(formatted: Column, template: Template = TURNS) -> Column:
    """The turns in a formatted text, as an array of structs of role and text."""
    parts = F.filter(F.split(formatted, _quoted(template.closes), -1), lambda p: p != "")
    halves = F.transform(parts, lambda p: F.split(F.substr(p, F.lit(len(template.opens) + 1)), _quoted(template.body), 2))
    return F.transform(halves, lambda h: F.struct(unescape(h[0]).alias("role"), unescape(h[1]).alias("text")))


def loss_text(segments: Column) -> Column:
    """All text under the loss, unescaped, joined."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
