"""Chat formatting: a state machine over roles and a declarative template.

The machine reads a conversation's roles in turn order and says whether they follow the
template's grammar; the template turns every turn into text segments, each with a flag
that says whether a model is trained on it. Control strings inside texts are escaped, so
the formatted text can be read back turn by turn.
"""

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What an escaped ``guard`` looks like: its first character, one backslash more, the rest.
START = "start"


@dataclass(frozen=True)
class Template:
    """How turns are written.

    ``before`` and ``after`` mark a turn (``{role}`` stands for its role); every mark must
    contain ``guard``, two characters that never stand unescaped in a formatted text
    outside a mark. ``trained`` are the roles whose texts count for the loss. ``grammar``
    maps a state and a role to the next state; a state is the last role, or ``start``.
    ``final`` are the states a conversation may end in.
    """

    before: str = "<|im_start|>{role}\n"
    after: str = "<|im_end|>\n"
    guard: str = "<|"
    trained: frozenset[str] = frozenset({"assistant"})
    grammar: Mapping[str, frozenset[str]] = field(
        default_factory=lambda: {
            START: frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user", "tool"}),
            "tool": frozenset({"assistant"}),
        }
    )
    final: frozenset[str] = frozenset({"assistant"})

    def __post_init__(self):
        if len(self.guard) != 2 or self.guard[0] == self.guard[1] or "\\" in self.guard:
            raise ValueError("the guard is two different characters without a backslash")
        if self.guard not in self.before or self.guard not in self.after or "{role}\n" not in self.before:
            raise ValueError("both marks contain the guard, the first one also {role} and a line end")


def _regex(text: str) -> str:
    """``text`` as a literal in a Java regular expression."""
    return "".join("\\" + c if not c.isalnum() and not c.isspace() else c for c in text)


def escape(text: Column, template: Template) -> Column:
    """Put one more backslash inside every guard, however many it has already."""
    first, second = template.guard
    return F.regexp_replace(text, F.lit(rf"{_regex(first)}(\\*){_regex(second)}"), F.lit(rf"\{first}\\$1\{second}"))


def unescape(text: Column, template: Template) -> Column:
    first, second = template.guard
    return F.regexp_replace(text, F.lit(rf"{_regex(first)}\\(\\*){_regex(second)}"), F.lit(rf"\{first}$1\{second}"))


def _escape_role(role: Column, template: Template) -> Column:
    """Roles end at a line end, so theirs are written otherwise."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), template)


def _unescape_role(role: Column, template: Template) -> Column:
    return F.replace(F.replace(unescape(role, template), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _state_after(roles: Column, template: Template) -> Column:
    """The machine's state after all roles: the last role, or ``!`` and the first role
    out of turn (states and roles cannot be mixed up, since ``!`` only leads to itself)."""

    def step(state: Column, role: Column) -> Column:
        allowed = F.lit(False)
        for at, following in template.grammar.items():
            for role_next in sorted(following):
                allowed = allowed | ((state == at) & (role == role_next))
        return F.when(state.startswith("!"), state).when(allowed, role).otherwise(F.concat(F.lit("!"), role))

    return F.aggregate(roles, F.lit(START), step)


def format_chats(df: DataFrame, template: Template = Template(), key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``key``, ``n_turns``, ``valid``, ``out_of_turn`` (the first
    role that breaks the grammar, or the last one if the conversation ends too early; null
    if valid), ``segments`` (array of ``text`` and ``loss``) and ``formatted``, the
    segments' texts joined.

    Turns are taken by ``order``, equal ones by role and text; a null order comes first. A
    null text or role counts as empty, a null key is a conversation of its own, repeated
    rows are repeated turns. Conversations out of turn are formatted all the same. Other
    columns are left out; an empty table gives an empty one. A conversation is one output
    value, so its turns meet in one task, as the rows of one document do; many
    conversations spread by their key.
    """
    turn = F.struct(
        df[order].alias("at"),
        F.coalesce(df[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(df[text].cast("string"), F.lit("")).alias("text"),
    )
    turns = df.groupBy(df[key].alias("key")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    mark_start, mark_end = template.before.split("{role}")

    def segments(t: Column) -> Column:
        loss = t["role"].isin(sorted(template.trained))
        return F.array(
            F.struct(F.concat(F.lit(mark_start), _escape_role(t["role"], template), F.lit(mark_end)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"], template).alias("text"), loss.alias("loss")),
            F.struct(F.lit(template.after).alias("text"), F.lit(False).alias("loss")),
        )

    state = F.col("state")
    ended = state.isin(sorted(template.final))
    return (
        turns.withColumn("state", _state_after(F.col("turns")["role"], template))
        .withColumn("segments", F.flatten(F.transform("turns", segments)))
        .select(
            F.col("key").alias(key),
            F.size("turns").cast("long").alias("n_turns"),
            ended.alias("valid"),
            F.when(~ended, F.regexp_replace(state, "^!", "")).alias("out_of_turn"),
            "segments",
            F.array_join(F.col("segments")["text"], "").alias("formatted"),
        )
    )


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """The turns (array of ``role`` and ``text``) a formatted text was made from."""
    mark_start, mark_end = (_regex(x) for x in template.before.split("{role}"))
    first, second = (_regex(x) for x in template.guard)
    # What lies between marks has no guard in it.
    inside = rf"(?:(?!{first}{second})[\s\S])*+"
    pattern = rf"{mark_start}([^\n]*){mark_end}({inside}){_regex(template.after)}"
    every = [F.regexp_extract_all(formatted, F.lit(pattern), F.lit(group)) for group in (1, 2)]
    return F.zip_with(every[0], every[1], lambda r, t: F.struct(_unescape_role(r, template).alias("role"), unescape(t, template).alias("text")))


def loss_text(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, in order, as it was before formatting."""
    trained = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(trained, lambda s: unescape(s["text"], template)), "")
