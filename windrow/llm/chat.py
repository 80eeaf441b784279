r"""Chat formatting: a finite-state machine over roles and a declarative template.

The template says how a turn of each role begins, how a turn ends, which roles are trained
on and which role may follow which state.  A conversation is worked on in blocks of turns, so
a long one is spread: a block first folds its roles from every state at once (a table from
the state before to the state after), the blocks' tables are chained per conversation, and
then each block knows its first state and emits its segments.

Characters that control strings are made of are written as a backslash and a letter in
texts, so that no text can end its turn or start another, and the output can be read back
without loss.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import null_key

BLOCK_TURNS = 256


@dataclass(frozen=True)
class ChatTemplate:
    """How turns look, and which order of roles is right."""

    # A turn is mark + name + colon + text + end.  Each holds a character that an escaped
    # text does not have.
    mark: str = "### "
    colon: str = ": "
    end: str = "</turn>\n"
    names: Mapping[str, str] = field(
        default_factory=lambda: {
            "system": "System",
            "user": "User",
            "assistant": "Assistant",
        }
    )
    trained: Sequence[str] = ("assistant",)
    # Roles that may follow a state.  The state after a turn is its role, also after a wrong
    # turn; a role that has no state leads to "other".
    follows: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
            "other": ("system", "user"),
        }
    )

    def __post_init__(self):
        if not {*self.trained} <= {*self.follows} - {"start", "other"}:
            raise ValueError("a trained role needs a state of its own")

    @property
    def states(self) -> list[str]:
        return list(self.follows)


TEMPLATE = ChatTemplate()

# Written before a role that is spelled like another role's name; no escaped text has it.
AS_IS = "\\r"

# The characters that control strings cannot do without, and what texts have instead of them.
# The escape itself comes first.
ESCAPES = (("\\", "\\\\"), ("#", "\\h"), (":", "\\c"), ("<", "\\l"))


def escape(text: Column) -> Column:
    for char, code in ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Doubled backslashes are cut at first, so that what is left of codes stands alone."""

    def plain(part: Column) -> Column:
        for char, code in ESCAPES[1:]:
            part = F.replace(part, F.lit(code), F.lit(char))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def _step(template: ChatTemplate) -> Column:
    """(state, role) as text -> [state after, 1 if the turn is in order]."""
    known = [s for s in template.states if s not in ("start", "other")]
    entries = []
    for state, allowed in template.follows.items():
        for role in [*known, "other"]:
            entries += [F.lit(f"{state}>{role}"), F.lit(f"{role}>{int(role in allowed)}")]
    return F.create_map(*entries)


def _role_state(role: Column, template: ChatTemplate) -> Column:
    known = [s for s in template.states if s not in ("start", "other")]
    return F.when(role.isin(known), role).otherwise(F.lit("other"))


def _states(turns: Column, first: Column, template: ChatTemplate) -> Column:
    """The steps ``state>ok`` of every turn of a block, from its first state on."""
    step = _step(template)

    def take(done: Column, turn: Column) -> Column:
        before = F.substring_index(F.element_at(done, -1), ">", 1)
        key = F.concat(before, F.lit(">"), _role_state(turn["role"], template))
        return F.concat(done, F.array(F.element_at(step, key)))

    begun = F.array(F.concat(first, F.lit(">1")))
    return F.slice(F.aggregate(turns, begun, take), F.lit(2), F.size(turns))


def format_chat(
    conversations: DataFrame, template: ChatTemplate = TEMPLATE, block_turns: int = BLOCK_TURNS
) -> DataFrame:
    """Per block of turns: ``conv_id, block, formatted, segments, n_turns, n_wrong``.

    ``segments`` are (text, loss) whose texts in order are ``formatted``; under the loss mask
    lie the texts alone, without marks or ends, of turns that lead the machine to a trained state.  ``n_wrong`` counts turns
    that may not follow the one before; they are formatted like others.

    Rows of a conversation go by turn, NULL first, then role and text; repeated rows all
    count.  A NULL role or text is empty; a role without a name in the template is written as
    it is, escaped, and marked as such where it is spelled like a name of the template.  Rows with a NULL conv_id are one conversation.  An empty table gives no
    rows; other columns are not read.  Blocks are cut by turn number.
    """
    rows = conversations.select(
        "conv_id",
        null_key(F.col("conv_id")).alias("_conv"),
        F.coalesce(F.floor(F.col("turn") / F.lit(block_turns)), F.lit(-(1 << 62))).alias("block"),
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("_turn"),
    )
    blocks = rows.groupBy("_conv", "conv_id", "block").agg(
        F.sort_array(F.collect_list("_turn")).alias("turns")
    )
    # Where a block leads to from every state: all the chaining needs of it.
    states = F.array(*[F.lit(s) for s in template.states])
    last = lambda s: F.element_at(_states(F.col("turns"), F.lit(s), template), -1)
    after = F.array(*[F.substring_index(last(s), ">", 1) for s in template.states])
    chain = blocks.groupBy("_conv").agg(
        F.sort_array(F.collect_list(F.struct("block", after.alias("after")))).alias("chain")
    )

    def through(done: Column, block: Column) -> Column:
        leads = F.map_from_arrays(states, block["after"])
        return F.concat(done, F.array(F.element_at(leads, F.element_at(done, -1))))

    begun = F.aggregate("chain", F.array(F.lit("start")), through)
    begins = F.arrays_zip(F.col("chain.block").alias("block"), begun.alias("first"))
    firsts = chain.select("_conv", F.explode(begins).alias("b")).select(
        "_conv", F.col("b.block").alias("block"), F.col("b.first").alias("_first")
    )
    steps = blocks.join(firsts, ["_conv", "block"]).withColumn(
        "_steps", _states(F.col("turns"), F.col("_first"), template)
    )
    names = F.create_map(*[x for k, v in template.names.items() for x in (F.lit(k), F.lit(v))])

    clashes = list(template.names.values())

    def turn_segments(turn: Column, step: Column) -> Column:
        plain = F.when(turn["role"].isin(clashes), F.lit(AS_IS)).otherwise(F.lit(""))
        plain = F.concat(plain, escape(turn["role"]))
        name = F.coalesce(F.element_at(names, turn["role"]), plain)
        trained = F.substring_index(step, ">", 1).isin(list(template.trained))
        head = F.concat(F.lit(template.mark), name, F.lit(template.colon))
        segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            segment(head, F.lit(False)),
            segment(escape(turn["text"]), trained),
            segment(F.lit(template.end), F.lit(False)),
        )

    segments = F.flatten(F.zip_with("turns", "_steps", turn_segments))
    wrong = F.size(F.filter("_steps", lambda s: s.endswith(">0"))).cast("long")
    out = steps.select(
        "conv_id",
        "block",
        segments.alias("segments"),
        F.size("turns").cast("long").alias("n_turns"),
        wrong.alias("n_wrong"),
    )
    text = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return out.select("conv_id", "block", text.alias("formatted"), "segments", "n_turns", "n_wrong")


def read_turns(formatted: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """The turns (role, text) of formatted text: what was formatted, read from the text alone."""
    roles = F.create_map(*[x for k, v in template.names.items() for x in (F.lit(v), F.lit(k))])
    parts = F.split(formatted, template.end, -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    pattern = rf"(?s)^{template.mark}([^:]*){template.colon}(.*)$"

    def turn(part: Column) -> Column:
        name = F.regexp_extract(part, pattern, 1)
        plain = F.regexp_replace(name, r"^\\r", "")
        role = F.coalesce(F.element_at(roles, name), unescape(plain))
        text = unescape(F.regexp_extract(part, pattern, 2))
        return F.struct(role.alias("role"), text.alias("text"))

    return F.transform(parts, turn)
