"""Chat formatting in budgeted windows. Built-in functions only.

A conversation's turns are cut into windows of whole turns. Prefix sums of the
turns' tokens choose the spans: a window takes turns while their sum stays within
what the budget leaves after the system turn and the repeated history. Every
window begins with the system turn; all but the first repeat the last turns
before it, up to a token limit. Only assistant turns that a window has for the
first time are targets, so each is a target once.

Template of a turn: ``<|role|>``, a line break, the text, ``<|end|>``, a line
break. Inside texts and roles control strings are broken by escapes that start
with ``~``, which can be undone without loss.

Defined results: a null text or role is empty; turns are ordered by turn, role
and text, null turns first, and all rows are kept, repeated ones too; a null
conv_id is a conversation of its own; a turn larger than the budget is a window
of its own, whole; only the first turn can be the system turn; an empty table
gives an empty result. Columns of the input other than the named ones play no
role. A conversation is one row, as its template is one text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import let

#: Control strings of this and of other common templates start with these characters before these texts.
CONTROL = {"<": r"\||/?s>|</?SYS>>", "[": r"/?INST\]"}
#: What stands for a character inside texts; the last two occur in roles only.
ESCAPES = {"~": "~0", "<": "~1", "[": "~2", "|": "~3", "\n": "~4"}
HEAD, HEAD_END, END = "<|", "|>\n", "<|end|>\n"
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
#: Tokens of a turn's marks.
MARKS = 4
#: Values that are taken together where an array grows.
BLOCK = 256


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, and of the history that it may repeat."""

    window: int = 512
    history: int = 128


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("~"), F.lit(ESCAPES["~"]))
    for first, rest in CONTROL.items():
        text = F.regexp_replace(text, rf"\Q{first}\E(?={rest})", ESCAPES[first])
    return text


def escaped_role(role: Column) -> Column:
    role = escaped(role)
    for found in ("|", "\n"):
        role = F.replace(role, F.lit(found), F.lit(ESCAPES[found]))
    return role


def unescaped(text: Column) -> Column:
    for found, shown in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(shown), F.lit(found))
    return text


def _turns(rows: Column) -> Column:
    """Turns as (head, body, target, tokens)."""

    def one(t: Column) -> Column:
        head = F.concat(F.lit(HEAD), escaped_role(t["role"]), F.lit(HEAD_END))
        tokens = F.regexp_count(t["text"], F.lit(TOKEN)) + MARKS
        return F.struct(head.alias("head"), escaped(t["text"]).alias("body"), (t["role"] == "assistant").alias("target"), tokens.alias("tokens"))

    return F.transform(rows, one)


def running(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The states after each value: ``step(state, value)`` from ``start`` on.

    An array that grows by one is copied each time, so values are taken in
    blocks: the time rises with the number of values times ``BLOCK``.
    """

    def of_block(state: Column, block: Column) -> Column:
        first = F.slice(F.array(state), 1, 0)
        return F.aggregate(block, first, lambda done, v: F.array_append(done, step(F.coalesce(F.get(done, F.size(done) - 1), state), v)))

    n_blocks = F.ceil(F.size(values) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(1), F.greatest(n_blocks, F.lit(1))), lambda b: F.slice(values, (b - 1) * BLOCK + 1, BLOCK))

    def more(done: Column, block: Column) -> Column:
        state = F.coalesce(F.get(F.get(done, F.size(done) - 1), F.size(F.get(done, F.size(done) - 1)) - 1), start)
        return F.array_append(done, let(state, lambda s: of_block(s, block)))

    return F.flatten(F.aggregate(blocks, F.slice(F.array(F.array(start)), 1, 0), more))


def _sums(turns: Column) -> Column:
    """Prefix sums: tokens before each turn, and at the end the total."""
    zero = F.lit(0).cast("long")
    return F.concat(F.array(zero), running(F.transform(turns, lambda t: t["tokens"].cast("long")), zero, lambda total, n: total + n))


def _starts(sums: Column, first: Column, room: Column) -> Column:
    """The turns at which windows start: where the sum since the last start passes the room."""
    places = F.sequence(F.lit(0), F.size(sums) - 2)
    start_of = running(places, first, lambda start, i: F.when((i > first) & (sums[i + 1] - sums[start] > room), i).otherwise(start))
    return let(start_of, lambda of: F.filter(places, lambda i: (i >= first) & (of[i] == i)))


def _window(turns: Column, sums: Column, system: Column, start: Column, end: Column, history: int) -> Column:
    """One window: its text, loss spans (code points) and how many leading turns were seen before."""
    # every turn has its marks at least, so only so many fit into the history
    near = F.filter(F.sequence(F.greatest(start - (history // MARKS + 1), system), start), lambda i: sums[start] - sums[i] <= history)
    later = start > system

    def shown(back: Column) -> Column:
        at = F.when(later, start).otherwise(F.lit(0))  # the system turn is the first window's own
        kept = F.slice(turns, back + 1, end - back)
        own = F.transform(kept, lambda t, j: F.struct(t.alias("t"), (t["target"] & (j + back >= at)).alias("loss")))
        led = F.transform(F.slice(turns, 1, F.when(later, system).otherwise(F.lit(0))), lambda t: F.struct(t.alias("t"), F.lit(False).alias("loss")))
        return F.concat(led, own)

    def place(s: Column, seen: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("length"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["length"] + F.length(x["t"]["head"])
            length = F.length(x["t"]["body"]).cast("long")
            span = F.struct(begin.alias("start"), length.alias("length"))
            spans = F.when(x["loss"], F.array_append(acc["spans"], span)).otherwise(acc["spans"])
            return F.struct((begin + length + len(END)).alias("length"), spans.alias("spans"))

        text = F.concat_ws("", F.transform(s, lambda x: F.concat(x["t"]["head"], x["t"]["body"], F.lit(END))))
        return F.struct(text.alias("formatted"), F.aggregate(s, zero, step)["spans"].alias("loss"), seen.alias("n_seen"))

    back = F.when(later, near[0]).otherwise(F.lit(0))
    return let(back, lambda b: let(shown(b), lambda s: place(s, F.when(later, system + start - b).otherwise(F.lit(0)))))


def _windows(turns: Column, system: Column, budget: Budget) -> Column:
    """The windows of one conversation's turns. Each array is computed once and named by a lambda, however often it is looked at."""

    def cut(t: Column, sums: Column, sys: Column) -> Column:
        room = F.greatest(F.lit(budget.window) - sums[sys] - budget.history, F.lit(1))
        first = F.least(sys, F.size(t) - 1)

        def spans(starts: Column) -> Column:
            end = lambda k: F.coalesce(F.get(starts, k + 1), F.size(t))
            return F.transform(starts, lambda start, k: _window(t, sums, sys, start, end(k), budget.history))

        return let(let(room, lambda r: let(first, lambda f: _starts(sums, f, r))), spans)

    return let(turns, lambda t: let(system, lambda sys: let(_sums(t), lambda sums: cut(t, sums, sys))))


def formatted(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """(conv_id, windows): per conversation its windows in order, each (formatted, loss, n_seen).

    ``loss`` lists (start, length) in code points of ``formatted``; ``n_seen``
    leading turns repeat earlier windows.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    grouped = rows.groupBy("conv_id").agg(F.collect_list("t").alias("rows"))
    system = lambda found: F.when(found[0]["role"] == "system", 1).otherwise(0)
    windows = let(F.array_sort("rows"), lambda found: _windows(_turns(found), system(found), budget))
    return grouped.select("conv_id", windows.alias("windows"))


def window_rows(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """(conv_id, window, formatted, loss, n_seen): one row per window."""
    return formatted(conversations, budget).select("conv_id", F.posexplode("windows").alias("window", "w")).select("conv_id", "window", "w.*")


def read_turns(text: Column) -> Column:
    """The turns (role, text) of a formatted window."""
    chunks = F.filter(F.split(text, r"<\|end\|>\n"), lambda c: c != "")

    def one(chunk: Column) -> Column:
        role = F.substring_index(chunk, HEAD_END, 1)
        body = F.substr(chunk, F.length(role) + 1 + len(HEAD_END))
        return F.struct(unescaped(F.substr(role, F.lit(1 + len(HEAD)))).alias("role"), unescaped(body).alias("text"))

    return F.transform(chunks, one)


def read_loss(text: Column, spans: Column) -> Column:
    """All text under the loss mask, without escapes."""
    return F.concat_ws("", F.transform(spans, lambda s: unescaped(F.substr(text, (s["start"] + 1).cast("int"), s["length"].cast("int")))))


def read_back(windows: DataFrame) -> DataFrame:
    """What ``formatted`` output says: turns seen for the first time, their digest, and the text under the loss mask."""
    parts = F.flatten(F.transform("windows", lambda w: let(read_turns(w["formatted"]), lambda t: F.filter(t, lambda _, i: i >= w["n_seen"]))))
    loss = F.concat_ws("", F.transform("windows", lambda w: read_loss(w["formatted"], w["loss"])))
    said = windows.select("conv_id", "windows", parts.alias("parts"), loss.alias("loss"))
    whole = F.concat_ws("", F.transform("parts", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return said.select(
        "conv_id",
        F.size("parts").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.aggregate("windows", F.lit(0).cast("long"), lambda n, w: n + F.length(w["formatted"])).alias("formatted_chars"),
        F.size("windows").cast("long").alias("n_windows"),
    )
