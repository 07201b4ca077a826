"""Chat formatting from a declarative template, in DataFrame expressions only.

A template names its control strings, the roles whose text carries loss, and the
transitions of a finite-state machine over roles. Formatting turns a conversation
into segments; each segment is a piece of the formatted text and says whether the
loss covers it. The formatted text is the segments put together.

Control strings that occur inside roles or texts are escaped: a backslash becomes
two, and ``<|`` becomes ``<\\|``. No escaped text contains ``<|``, so the formatted
text splits into its turns again without a doubt, and unescaping gives the roles and
texts back unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "start"
WRONG = "wrong"


@dataclass(frozen=True)
class Template:
    """Control strings, loss roles and allowed turn order.

    Each control string begins with ``<|``. ``follows`` maps a state to the roles that
    may come next; a role is also the name of the state after it, and ``start`` is the
    state before the first turn. ``ends`` are the states in which a conversation may end.
    """

    turn: str = "<|im_start|>"
    body: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    ends: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant",),
        }
    )

    def __post_init__(self):
        marks = (self.turn, self.body, self.end)
        if not all(m.startswith("<|") for m in marks) or len(set(marks)) < 3:
            raise ValueError("three different control strings that begin with <|")
        if {START, WRONG} & {r for roles in self.follows.values() for r in roles}:
            raise ValueError("roles cannot be named like the states start and wrong")


CHAT = Template()


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _last_state(roles: Column, template: Template) -> Column:
    """State after all turns, and the index of the first turn out of order (or -1)."""
    allowed = F.array(
        *(F.lit(f"{state}>{role}") for state, roles_ in template.follows.items() for role in roles_)
    )

    def step(state: Column, role: Column) -> Column:
        fits = F.array_contains(allowed, F.concat(state["state"], F.lit(">"), role))
        return F.struct(
            F.when(fits, role).otherwise(F.lit(WRONG)).alias("state"),
            (state["at"] + 1).alias("at"),
            F.when((state["bad"] < 0) & ~fits, state["at"]).otherwise(state["bad"]).alias("bad"),
        )

    start = F.struct(F.lit(START).alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("bad"))
    return F.aggregate(roles, start, step)


def format_conversations(turns: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per conversation: conv_id, n_turns, segments, formatted, valid, bad_turn.

    Reads the columns conv_id, turn, role and text; other columns are ignored. Turns are
    put in order of turn, then role, then text; null turn numbers come first. A null role
    or text counts as empty, and a null conv_id is a conversation of its own. Repeated
    rows are repeated turns. ``valid`` is true if the machine accepts all turns and ends
    in an end state; ``bad_turn`` is the index of the first turn out of order, or null.
    Invalid conversations are formatted all the same. ``segments`` holds structs of text
    and loss. An empty table gives no row.

    Rows of a conversation are gathered into one value, since that value is the result;
    nothing larger than one conversation meets in a task.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("row"),
    )
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))

    def pieces(row: Column) -> Column:
        learned = row["role"].isin(*template.loss_roles) if template.loss_roles else F.lit(False)
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            piece(F.concat(F.lit(template.turn), escaped(row["role"]), F.lit(template.body)), F.lit(False)),
            piece(escaped(row["text"]), learned),
            piece(F.lit(template.end + "\n"), F.lit(False)),
        )

    made = grouped.select(
        "conv_id",
        F.size("rows").cast("long").alias("n_turns"),
        F.flatten(F.transform("rows", pieces)).alias("segments"),
        _last_state(F.transform("rows", lambda r: r["role"]), template).alias("end"),
    )
    return made.select(
        "conv_id",
        "n_turns",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        ((F.col("end.bad") < 0) & F.col("end.state").isin(*template.ends)).alias("valid"),
        F.when(F.col("end.bad") >= 0, F.col("end.bad")).alias("bad_turn"),
    )


def read_turns(formatted: Column, template: Template = CHAT) -> Column:
    """The turns of a formatted conversation as an array of structs of role and text."""
    literal = lambda mark: "".join("\\" + c if not c.isalnum() else c for c in mark)
    parts = F.split(formatted, literal(template.end + "\n").replace("\\\n", "\n"))
    whole = F.slice(parts, F.lit(1), F.size(parts) - 1)  # nothing follows the last end mark

    def turn(part: Column) -> Column:
        sides = F.split(F.substr(part, F.lit(len(template.turn) + 1)), literal(template.body))
        return F.struct(
            unescaped(sides[0]).alias("role"), unescaped(sides[1]).alias("text")
        )

    return F.transform(whole, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between the pieces."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescaped(s["text"])), "")
