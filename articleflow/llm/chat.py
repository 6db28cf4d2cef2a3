"""Chat formatting from a declarative template, in DataFrame functions only.

Every turn becomes segments: its opening, its text and its closing, each with a flag that says
whether a loss is taken on it. Control strings start with ``MARK``; texts and roles are escaped so
that they never hold it, and reading back undoes that. A finite-state machine over the roles
says whether the turns of a conversation are in order. A row is formatted by itself and the
machine runs over chunks of turns whose transitions are composed, so a conversation of any
length is spread; only ``assemble`` brings a conversation into one value.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "<|"
_NEWLINE = "<|nl|>"
# Turn numbers that share so many leading bits are one chunk of the machine.
CHUNK_BITS = 12


@dataclass(frozen=True)
class Template:
    """Strings around a turn (those that mark begin with ``MARK``), the roles whose texts bear a
    loss, and the machine: ``moves[state][role]`` is the next state, no entry an illegal turn."""

    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>"
    after_turn: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    final: tuple[str, ...] = ("answered",)
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "briefed", "user": "asked"},
            "briefed": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )

    def __post_init__(self):
        if not (self.opening.startswith(MARK) and self.closing.startswith(MARK)):
            raise ValueError(f"control strings begin with {MARK}")
        if _NEWLINE in (self.opening, self.closing):
            raise ValueError(f"{_NEWLINE} stands for a line break inside a role")


CHATML = Template()


def escape(text: Column) -> Column:
    """``<``, any number of backslashes and ``|`` get one backslash more; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def _role_out(role: Column, template: Template) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(_NEWLINE)) if "\n" in template.after_role else escape(role)


def _role_in(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(_NEWLINE), F.lit("\n")))


def segments(role: Column, text: Column, template: Template = CHATML) -> Column:
    """The segments (text, loss) of one turn."""

    def part(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    bears = F.coalesce(role.isin(*template.loss_roles), no)
    head = F.concat(F.lit(template.opening), _role_out(role, template), F.lit(template.after_role))
    return F.array(part(head, no), part(escape(text), bears), part(F.lit(template.closing + template.after_turn), no))


def turn_order(df: DataFrame, template: Template = CHATML, conv: str = "conv_id", turn: str = "turn", role: str = "role") -> DataFrame:
    """Rows (conversation, order_valid, first_bad): whether the machine accepts the roles by turn,
    and how many turns come before the first without a move (null if there is none).

    Null turns come first; equal turns go by role. A null or unknown role has no move. A chunk gives, for each
    state it may be entered in, the state it is left in; a conversation adds up its chunks.
    """
    states = [template.start, *(s for s in template.moves if s != template.start)]
    states += [s for m in template.moves.values() for s in m.values() if s not in states]
    states = list(dict.fromkeys(states))
    dead = len(states)
    roles = list(dict.fromkeys(r for m in template.moves.values() for r in m))
    table = [states.index(template.moves.get(s, {}).get(r, "")) if r in template.moves.get(s, {}) else dead for s in states for r in roles]
    moves = F.array(*(F.lit(t) for t in table))
    known = F.array(*(F.lit(r) for r in roles))
    number = F.coalesce(F.array_position(known, F.col(role)), F.lit(0)).cast("int")  # 0: no such role

    def step(at: Column, code: Column) -> Column:
        found = F.get(moves, at["state"] * F.lit(len(roles)) + code - F.lit(1))
        after = F.when((at["state"] == dead) | (code == 0), F.lit(dead)).otherwise(found)
        return F.struct(after.alias("state"), (at["good"] + F.when(after == dead, 0).otherwise(1)).alias("good"))

    def entered(state: int, codes: Column) -> Column:
        first = F.struct(F.lit(state).alias("state"), F.lit(0).cast("long").alias("good"))
        return F.aggregate(codes, first, lambda at, x: step(at, x["code"]))

    rows = df.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), F.col(role).alias("_role"), number.alias("_code"))
    chunk = F.shiftright(F.col("_turn").cast("long"), CHUNK_BITS).alias("_chunk")
    inside = F.sort_array(F.collect_list(F.struct(F.col("_turn").alias("turn"), F.col("_role").alias("role"), F.col("_code").alias("code"))))
    chunks = rows.groupBy("_conv", chunk).agg(inside.alias("codes"))
    ends = F.array(*(entered(s, F.col("codes")) for s in range(dead)))
    parts = chunks.select("_conv", F.struct("_chunk", F.size("codes").cast("long").alias("n"), ends.alias("ends")).alias("part"))

    def join(at: Column, part: Column) -> Column:
        end = F.get(part["ends"], at["state"])
        over = at["state"] == dead
        return F.struct(F.when(over, dead).otherwise(end["state"]).alias("state"), (at["good"] + F.when(over, F.lit(0)).otherwise(end["good"])).alias("good"))

    begin = F.struct(F.lit(states.index(template.start)).alias("state"), F.lit(0).cast("long").alias("good"))
    whole = parts.groupBy("_conv").agg(F.aggregate(F.sort_array(F.collect_list("part")), begin, join).alias("end"))
    accepted = F.col("end.state").isin(*[states.index(s) for s in template.final])
    return whole.select(F.col("_conv").alias(conv), accepted.alias("order_valid"), F.when(F.col("end.state") == dead, F.col("end.good")).alias("first_bad"))


def format_turns(df: DataFrame, template: Template = CHATML, role: str = "role", text: str = "text", name: str = "segments") -> DataFrame:
    """``df`` with the segments of each row's turn; a row by itself, so no conversation is gathered.
    A null text or role is empty. A column called ``name`` gives way; all others stay."""
    return df.withColumn(name, segments(F.col(role), F.col(text), template))


def assemble(df: DataFrame, template: Template = CHATML, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: its segments in turn order, ``order_valid`` and ``first_bad``.

    A conversation is one value here, at most the 2 GB that Spark gives to one; longer ones stay
    with ``format_turns``. Null turns come first, equal ones go by role and text; repeated rows all
    stay; a null id is a conversation of its own. No rows give no conversations. Columns of ``df``
    that are not named are dropped, so their names don't matter.
    """
    rows = df.select(F.col(conv).alias("_conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    whole = rows.groupBy("_conv").agg(F.flatten(F.transform(ordered, lambda t: segments(t["role"], t["text"], template))).alias("segments"))
    order = turn_order(df, template, conv, turn, role)
    checks = order.select(F.col(conv).alias("_of"), "order_valid", "first_bad")
    return whole.join(checks, F.col("_conv").eqNullSafe(F.col("_of")), "left").select(F.col("_conv").alias(conv), "segments", "order_valid", "first_bad")


def read_back(formatted: DataFrame, template: Template = CHATML, name: str = "segments") -> DataFrame:
    """Undo ``assemble``: its columns with formatted (the whole string), turns (role and text, read
    from that string alone) and loss_texts (unescaped texts under the loss mask)."""

    def quoted(s: str) -> str:
        return rf"\Q{s}\E"

    whole = F.array_join(F.transform(F.col(name), lambda s: s["text"]), "")
    pieces = F.slice(F.split(F.col("formatted"), quoted(template.opening)), F.lit(2), F.greatest(F.size(F.split(F.col("formatted"), quoted(template.opening))) - 1, F.lit(0)))
    pattern = f"(?s)^(.*?){quoted(template.after_role)}(.*){quoted(template.closing + template.after_turn)}$"

    def turn(piece: Column) -> Column:
        return F.struct(_role_in(F.regexp_extract(piece, pattern, 1)).alias("role"), unescape(F.regexp_extract(piece, pattern, 2)).alias("text"))

    borne = F.filter(F.col(name), lambda s: s["loss"])
    return formatted.withColumn("formatted", whole).withColumns({"turns": F.transform(pieces, turn), "loss_texts": F.transform(borne, lambda s: unescape(s["text"]))})
