"""Chat formatting by a finite-state machine over roles (operator 13).

A declarative ``Template`` names the marks around each role's text, whether a
text counts in the loss, and the moves of a finite-state machine: which role
may follow which.  A conversation's rows, in the order of their turns, run
through the machine; each turn emits three segments (opening mark, text,
closing mark), each with its loss flag, and the conversation is their text in a
row.  A turn order that the machine refuses is formatted all the same and
reported: ``valid`` and ``n_accepted`` (the turns before the first refusal).

Control strings inside texts are escaped reversibly: a backslash goes in after
the first character of each, and after that of each that already has
backslashes there, so one taken away from each gives the text back.
The template checks that no control string can begin inside another one, so
the marks of a formatted conversation are exactly those the machine set.

Everything is DataFrame functions: one exchange by conversation, then
projections.  A conversation is one value in the end, so it has to fit a value
(2 GB).

Edge cases: a null text or role is empty; turns of equal number go by role,
then text; null turns come first; repeated rows are turns of their own; a row
without conv_id is a conversation of its own, as nothing says what it belongs
to; roles outside the template get the marks of ``other`` around their escaped
name and never count in the loss; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    begin: str
    end: str
    turns: dict[str, Turn]
    other: Turn                       # for roles that the template doesn't name
    name_end: str                     # after the name of such a role
    moves: dict[tuple[str, str], str] = field(default_factory=dict)   # (state, role) -> state
    start: str = "start"
    final: tuple[str, ...] = ()

    def __post_init__(self):
        opens, closes = [t.open for t in self._all()], [t.close for t in self._all()]
        if len(set(opens)) < len(opens) or set(opens) & set(closes) or self.name_end in opens + closes:
            raise ValueError("marks must tell the roles, and openings from closings, apart")
        heads = {c[0] for c in self.controls()}
        if any(len(c) < 2 or ESCAPE in c or heads & set(c[1:]) for c in self.controls()):
            raise ValueError("control strings have two characters or more, no backslash, and none begins inside another")
        if any(t.loss for t in (self.other,)):
            raise ValueError("only named roles can count in the loss")

    def _all(self) -> list[Turn]:
        return [*self.turns.values(), self.other]

    def controls(self) -> list[str]:
        return list(dict.fromkeys([self.begin, self.end, self.name_end, *(m for t in self._all() for m in (t.open, t.close))]))


INSTRUCT = Template(
    begin="<s>", end="</s>",
    turns={"system": Turn("[SYS]", "[/SYS]"), "user": Turn("[INST]", "[/INST]"), "assistant": Turn("[OUT]", "[/OUT]", loss=True)},
    other=Turn("[ROLE]", "[/ROLE]"), name_end="[TEXT]",
    moves={("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
           ("user", "assistant"): "assistant", ("assistant", "user"): "user"},
    final=("user", "assistant"),
)


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text)


def _by_head(template: Template, backslashes: str) -> str:
    """Pattern of the first character of each control string, before ``backslashes`` and its rest; the character is group 1."""
    heads: dict[str, list[str]] = {}
    for c in template.controls():
        heads.setdefault(c[0], []).append(_quoted(c[1:]))
    return "|".join(f"{_quoted(h)}(?={backslashes}(?:{'|'.join(rests)}))" for h, rests in heads.items())


def escape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, f"({_by_head(template, ESCAPE * 2 + '*')})", "$1" + ESCAPE * 2)


def unescape(text: Column, template: Template) -> Column:
    # the head of a control string, and the first of the backslashes after it
    return F.regexp_replace(text, f"({_by_head(template, ESCAPE * 2 + '+')}){ESCAPE * 2}", "$1")


def _per_role(role: Column, template: Template, of, other: Column) -> Column:
    return reduce(lambda out, name: F.when(role == name, of(template.turns[name])).otherwise(out), template.turns, other)


def conversations_of(rows: DataFrame) -> DataFrame:
    """``conv_id, turns`` (array of turn, role, text, in order) of the rows."""
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    flat = rows.select("conv_id", turn.alias("t"))
    together = flat.filter("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    alone = flat.filter("conv_id is null").select("conv_id", F.array("t").alias("turns"))
    # array_sort puts null struct fields last; a null turn comes first here
    nulls = F.filter("turns", lambda t: t["turn"].isNull())
    there = F.filter("turns", lambda t: t["turn"].isNotNull())
    return together.unionByName(alone).select("conv_id", F.when(F.exists("turns", lambda t: t["turn"].isNull()), F.concat(nulls, there))
                                              .otherwise(F.col("turns")).alias("turns"))


def accepted(turns: Column, template: Template) -> tuple[Column, Column]:
    """State after all turns (null: refused) and the number of turns before the first refusal."""
    key = lambda state, role: F.concat(state, F.lit("\n"), role)
    table = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)])
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("n"))

    def step(at, turn):
        to = F.try_element_at(table, key(at["state"], turn["role"]))
        return F.struct(to.alias("state"), (at["n"] + to.isNotNull().cast("int")).alias("n"))

    run = F.aggregate(turns, begin, step)
    return run["state"], run["n"]


def segments_of(turns: Column, template: Template) -> Column:
    """Array of (text, loss): begin mark, three segments for each turn, end mark."""
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    mark = lambda text: piece(F.lit(text), F.lit(False))

    def emit(t):
        named = F.concat(F.lit(template.other.open), escape(t["role"], template), F.lit(template.name_end))
        opening = _per_role(t["role"], template, lambda x: F.lit(x.open), named)
        closing = _per_role(t["role"], template, lambda x: F.lit(x.close), F.lit(template.other.close))
        loss = t["role"].isin([n for n, x in template.turns.items() if x.loss])
        return F.array(piece(opening, F.lit(False)), piece(escape(t["text"], template), loss), piece(closing, F.lit(False)))

    return F.concat(F.array(mark(template.begin)), F.flatten(F.transform(turns, emit)), F.array(mark(template.end)))


def format_chats(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """``conv_id, valid, n_accepted, segments, formatted`` of every conversation in ``rows`` (conv_id, turn, role, text)."""
    state, n = accepted(F.col("turns"), template)
    found = conversations_of(rows).select("conv_id", F.struct(state.alias("state"), n.alias("n")).alias("run"), segments_of(F.col("turns"), template).alias("segments"))
    return found.select("conv_id", F.coalesce(F.col("run.state").isin(list(template.final)), F.lit(False)).alias("valid"),
                        F.col("run.n").alias("n_accepted"), "segments",
                        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_back(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (array of role, text) of a formatted conversation."""
    closes = "|".join(_quoted(t.close) for t in template._all())
    body = F.substr(formatted, F.lit(len(template.begin) + 1), F.length(formatted) - len(template.begin) - len(template.end))
    pieces = F.split(body, closes, -1)

    def turn(p):
        named = F.substring_index(p, template.name_end, 1)
        rest = F.substr(p, F.length(named) + len(template.name_end) + 1)
        role = unescape(F.substr(named, F.lit(len(template.other.open) + 1)), template)
        for name, t in template.turns.items():
            is_it = F.startswith(p, F.lit(t.open))
            role = F.when(is_it, F.lit(name)).otherwise(role)
            rest = F.when(is_it, F.substr(p, F.lit(len(t.open) + 1))).otherwise(rest)
        return F.struct(role.alias("role"), unescape(rest, template).alias("text"))

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def loss_text(segments: Column, template: Template = INSTRUCT) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")


def digests(chats: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Counts and hashes of what ``format_chats`` gave, read back from its output."""
    back = chats.select("conv_id", read_back(F.col("formatted"), template).alias("turns"),
                        loss_text(F.col("segments"), template).alias("masked"), F.length("formatted").cast("long").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), sha(said).alias("turns_sha256"),
                       F.length("masked").cast("long").alias("loss_chars"), sha(F.col("masked")).alias("loss_sha256"), "formatted_chars")
