"""Operator 6: chat formatting with a role machine, a template and loss flags.

A finite-state machine over the roles says whether a conversation's turns are in order. A
declarative template turns every turn into segments, each with a loss flag; their texts in
order are the formatted conversation. Control strings inside roles and texts are broken by
an escape character after their first character, and escape characters are doubled, so no
control string of the template is left in a text and the escape can be undone.

DataFrame functions only. Escapes and segments are made turn by turn, without an exchange. The
role machine reads turn numbers and roles alone: rows alike in both are counted first, a range
sort numbers the rest, so that it cuts through a long conversation, every block of ``BLOCK``
turns becomes a table from state to state, and a conversation is the product of its blocks'
tables. Only what needs a whole conversation as one value, ``format_chats`` and the two digests
of ``digests``, gathers it, and is bounded by the 2 GB that Spark allows a row.

Defined cases: a null role or text is empty; turns are ordered by (turn, role, text), null
turns first, so repeated turns keep all their rows; a null ``conv_id`` is a conversation of
its own; an empty table gives no conversations; conversations out of order are formatted as
well and have ``valid`` false. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import numbered, text_or_empty

ESCAPE = "\\"
BLOCK = 4096            # turns whose moves one row composes
_POWERS = 48            # rows alike in conversation, turn and role: less than 2 ** 48


@dataclass(frozen=True)
class Template:
    """Marks around role and text, which roles bear loss, and the order of roles.

    ``moves`` maps (state, role) to the next state; a turn without a move leads to no state.
    ``reserved`` are control strings of the consumer that texts must not contain either.
    """

    opening: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    closing: str = "<|im_end|>"
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accept: tuple[str, ...] = ("answered",)
    moves: dict = field(default_factory=lambda: {
        ("start", "system"): "primed", ("start", "user"): "asked", ("primed", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked",
        ("asked", "tool"): "asked", ("answered", "tool"): "asked",
    })

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.opening, self.middle, self.closing, *self.reserved)

    def __post_init__(self) -> None:
        for mark in self.controls:
            if len(mark) < 2 or ESCAPE in mark:
                raise ValueError(f"control string {mark!r}: two characters or more, no escape character")


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in text)


def escape(text: Column, template: Template) -> Column:
    """Doubles escape characters, then puts one after the first character of every control
    string; the look-ahead also finds control strings that overlap."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    begins = "|".join(f"{_quoted(c[0])}(?={_quoted(c[1:])})" for c in template.controls)
    return F.regexp_replace(doubled, f"({begins})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _steps(template: Template) -> tuple[list[str], dict[str, list[int]]]:
    """The states by number, state 0 being the one no move leads out of, and for each role the
    state that every state goes to."""
    states = ["", *sorted({template.start, *template.moves.values(), *(state for state, _ in template.moves)} - {""})]
    table = {role: [0] * len(states) for _, role in template.moves}
    for (state, role), to in template.moves.items():
        table[role][states.index(state)] = states.index(to)
    return states, table


def _then(first: Column, second: Column) -> Column:
    """Where every state leads by ``first`` and then ``second``."""
    return F.transform(first, lambda state: F.get(second, state))


def _repeated(step: Column, times: Column, same: Column) -> Column:
    """A step taken ``times`` times, by squaring."""
    powers = F.array(*[F.lit(1 << b) for b in range(_POWERS)])
    more = F.aggregate(
        powers, F.struct(same.alias("done"), step.alias("power")),
        lambda a, bit: F.struct(
            F.when(times.bitwiseAND(bit) != 0, _then(a["done"], a["power"])).otherwise(a["done"]).alias("done"),
            _then(a["power"], a["power"]).alias("power")),
        lambda a: a["done"])
    return F.when(times == 1, step).otherwise(more)


def judge(turns: DataFrame, template: Template = Template(), block: int = BLOCK) -> DataFrame:
    """``conv_id, n_turns, valid`` per conversation: whether its roles are in order."""
    states, table = _steps(template)

    def numbers(values: list[int]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    same = numbers(list(range(len(states))))
    known = F.create_map(*[x for role, to in sorted(table.items()) for x in (F.lit(role), numbers(to))])
    step = F.coalesce(F.element_at(known, F.col("role")), numbers([0] * len(states))) if table else numbers([0] * len(states))
    runs = turns.select("conv_id", "turn", text_or_empty("role").alias("role")).groupBy("conv_id", "turn", "role").agg(
        F.count("*").alias("n"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    placed = numbered(runs, order, "conv_id", "place").select(
        "conv_id", "place", "n", _repeated(step, F.col("n"), same).alias("step"))

    def product(place: str) -> list[Column]:
        rows = F.sort_array(F.collect_list(F.struct(place, "step")))
        return [F.aggregate(rows, same, lambda done, row: _then(done, row["step"])).alias("step"), F.sum("n").alias("n")]

    blocks = placed.groupBy("conv_id", F.floor(F.col("place") / block).alias("block")).agg(*product("place"))
    whole = blocks.groupBy("conv_id").agg(*product("block"))
    good = [states.index(s) for s in template.accept if s in states]
    return whole.select("conv_id", F.col("n").alias("n_turns"),
                        F.get("step", F.lit(states.index(template.start))).isin(*good).alias("valid"))


def format_turns(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, turn, role, text, segments array<struct<text,loss>>, formatted`` per turn. The
    ``formatted`` of a conversation's turns one after the other, ordered by (turn, role, text),
    is the formatted conversation; no exchange takes place."""
    rows = turns.select("conv_id", "turn", text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    head = F.concat(F.lit(template.opening), escape(F.col("role"), template), F.lit(template.middle))
    segments = F.array(
        F.struct(head.alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(F.col("text"), template).alias("text"), F.col("role").isin(*template.loss_roles).alias("loss")),
        F.struct(F.lit(template.closing).alias("text"), F.lit(False).alias("loss")),
    )
    return rows.withColumn("segments", segments).withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def _with_verdict(chats: DataFrame, verdicts: DataFrame) -> DataFrame:
    held = verdicts.select(F.col("conv_id").alias("__conv"), "valid")
    return chats.join(held, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, valid, segments array<struct<text,loss>>, formatted`` per conversation, each
    gathered into one row; ``format_turns`` and ``judge`` give the same without gathering."""
    one = F.struct("turn", "role", "text", "segments", "formatted")
    chats = format_turns(turns, template).groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("__turns"))
    return _with_verdict(chats, judge(turns, template)).select(
        "conv_id", "valid", F.flatten(F.transform("__turns", lambda t: t["segments"])).alias("segments"),
        F.array_join(F.transform("__turns", lambda t: t["formatted"]), "").alias("formatted"))


def digests(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid`` per
    conversation, read back from the formatted turns; only the digests need it as one value."""
    back = format_turns(turns, template).select(
        "conv_id", "turn", F.length("formatted").cast("long").alias("chars"), learned_text(F.col("segments")).alias("learned"),
        F.explode(read_turns(F.col("formatted"), template)).alias("back"))
    one = F.struct("turn", F.col("back.role").alias("role"), F.col("back.text").alias("text"), "learned")
    chats = back.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.sum(F.length("learned").cast("long")).alias("loss_chars"),
        F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list(one)).alias("__turns"))
    spoken = F.array_join(F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("__turns", lambda t: t["learned"]), "")
    return _with_verdict(chats.select(
        "conv_id", "n_turns", F.sha2(spoken, 256).alias("turns_sha256"), "loss_chars",
        F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars"), judge(turns, template))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns ``array<struct<role,text>>`` back from a formatted conversation."""
    pieces = F.split(formatted, _quoted(template.closing), -1)
    whole = F.slice(pieces, 1, F.size(pieces) - 1)  # nothing follows the last closing mark

    def turn(piece: Column) -> Column:
        sides = F.split(F.substring(piece, len(template.opening) + 1, 2_147_483_647), _quoted(template.middle), 2)
        return F.struct(unescape(sides[0]).alias("role"), unescape(sides[1]).alias("text"))

    return F.transform(whole, turn)


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
