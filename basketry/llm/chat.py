"""Chat formatting in windows of a token budget.

Prefix sums of the turns' tokens place every turn on its conversation's token line.  The
line is cut into cells of the tokens a window has for new turns; turns that lie within one
cell are one window's new turns, and a turn that crosses a border is the new turn of a
window of its own.  So no window's new turns pass the cell, no turn is cut, and a turn's
window follows from its own prefix sum: nothing is decided one turn after the other.

A window begins with the conversation's system turn and with as many of the turns before
its first new turn as fit the history budget.  Both are repeats: the loss mask covers only
the new assistant texts, so each is trained on once.

A long conversation is cut into blocks of turn numbers.  Only block sums meet per
conversation; rows are ordered within their block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|start|>", "<|sep|>", "<|end|>"
BLOCK = 256
_OUT = ["conv_id", "window", "n_context", "n_turns", "tokens", "formatted", "loss_spans"]


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, and how many of them repeated history may take."""

    tokens: int = 1024
    history: int = 256
    per_turn: int = 4


def escape(text: Column) -> Column:
    """``text`` in which no control string can occur: each of them begins ``<|``."""
    return F.replace(text, F.lit("<"), F.lit("<\\"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<\\"), F.lit("<"))


def estimated_tokens(text: Column) -> Column:
    """A token for every four bytes, rounded up."""
    return F.floor((F.octet_length(text) + 3) / 4).cast("long")


def _placed(turns: DataFrame, budget: Budget) -> DataFrame:
    """Each turn with its place ``seq`` and tokens ``before`` it, and its conversation's rows."""
    order = ["turn", "role", "text"]
    blocks = turns.groupBy("conv_id", "block").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("tokens").alias("sum"),
        F.min(F.struct("turn", "role", "text")).alias("first"),
    )
    by = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first())
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)
    head = F.first("first").over(by)
    blocks = blocks.select(
        F.col("conv_id").alias("_conv"),
        F.col("block").alias("_block"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("sum_before"),
        F.sum("rows").over(Window.partitionBy("conv_id")).alias("conv_rows"),
        F.when(
            head["role"] == "system", estimated_tokens(head["text"]) + budget.per_turn
        ).otherwise(F.lit(0)).alias("system_tokens"),
    )
    within = Window.partitionBy("conv_id", "block").orderBy(*order)
    running = within.rowsBetween(Window.unboundedPreceding, -1)
    return (
        turns.withColumn("at", F.row_number().over(within) - 1)
        .withColumn("sum_at", F.coalesce(F.sum("tokens").over(running), F.lit(0)))
        .join(
            blocks,
            F.col("conv_id").eqNullSafe(F.col("_conv"))
            & F.col("block").eqNullSafe(F.col("_block")),
        )
        .withColumn("seq", F.col("rows_before") + F.col("at"))
        .withColumn("start", F.col("sum_before") + F.col("sum_at") - F.col("system_tokens"))
        .drop("_conv", "_block", "at", "sum_at", "rows_before", "sum_before", "block")
    )


def _formatted(windows: DataFrame) -> DataFrame:
    """Text and loss spans of windows with sorted ``parts`` of role, text and ``fresh``."""
    piece = lambda p: F.concat(
        F.lit(START), escape(p["role"]), F.lit(SEP), escape(p["text"]), F.lit(END)
    )
    lead = lambda p: F.length(escape(p["role"])) + len(START) + len(SEP)
    size = lambda p: F.length(escape(p["text"]))
    empty = F.array().cast("array<struct<start:int,length:int>>")

    def add(done: Column, p: Column) -> Column:
        span = F.struct(
            (done["at"] + lead(p)).alias("start"), size(p).alias("length")
        )
        learn = p["fresh"] & (p["role"] == "assistant")
        return F.struct(
            (done["at"] + lead(p) + size(p) + len(END)).alias("at"),
            F.when(learn, F.concat(done["spans"], F.array(span)))
            .otherwise(done["spans"])
            .alias("spans"),
        )

    spans = F.aggregate(
        "parts", F.struct(F.lit(0).alias("at"), empty.alias("spans")), add, lambda x: x["spans"]
    )
    return windows.withColumns(
        {
            "formatted": F.array_join(F.transform("parts", piece), ""),
            "loss_spans": spans,
            "n_turns": F.size("parts"),
            "n_context": F.size(F.filter("parts", lambda p: ~p["fresh"])),
        }
    )


def budgeted_windows(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """Windows of formatted turns, a row for each: ``conv_id``, ``window`` (in order),
    ``n_context`` (leading turns that are repeats), ``n_turns``, ``tokens``, ``formatted`` and
    ``loss_spans`` (``start`` from 0 and ``length``, in code points of ``formatted``).

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are left out.
    Turns go by ``turn`` (null first), ties by role and text; repeated rows are turns of their
    own.  A null role or text is an empty one, rows with a null ``conv_id`` are one conversation.
    The system turn is the first turn, if its role is ``system``.  A turn that is longer than the
    budget is not cut but makes a window that passes it, without history.  An empty table has
    no windows.
    """
    if budget.history >= budget.tokens:
        raise ValueError("the history budget must be smaller than the window")
    blank = F.lit("")
    turns = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
    ).withColumns(
        {
            "tokens": estimated_tokens(F.col("text")) + budget.per_turn,
            "block": F.floor(F.col("turn") / BLOCK),
        }
    )
    placed = _placed(turns, budget)
    pinned = (F.col("seq") == 0) & (F.col("role") == "system")
    # What a long system turn leaves is never less than one token a cell.
    cell = F.greatest(F.lit(1), F.lit(budget.tokens - budget.history) - F.col("system_tokens"))
    ends = F.col("start") + F.col("tokens")
    placed = placed.withColumns({"pinned": pinned, "cell": cell, "end": ends})
    opened = F.floor(F.col("start") / F.col("cell"))
    closed = F.floor((F.col("end") - 1) / F.col("cell"))
    new = placed.filter(~F.col("pinned")).withColumn(
        "window", (2 * opened + (opened != closed).cast("int")).cast("long")
    )
    windows = new.groupBy("conv_id", "window").agg(
        F.min("start").alias("w_start"),
        F.sum("tokens").alias("w_tokens"),
    )
    # A turn is history of the windows that start from its end to where the budget reaches;
    # they begin in one of these cells.
    first = F.floor(F.col("end") / F.col("cell"))
    last = F.floor((F.col("start") + budget.history) / F.col("cell"))
    reach = new.filter(F.col("tokens") <= budget.history).withColumn(
        "h_window", F.explode(F.sequence(2 * first, 2 * last + 1))
    )
    w = windows.select(
        F.col("conv_id").alias("w_conv"), F.col("window").alias("w_window"), "w_start", "w_tokens"
    )
    history = reach.join(
        w,
        F.col("conv_id").eqNullSafe(F.col("w_conv"))
        & (F.col("h_window") == F.col("w_window"))
        & (F.col("w_start") >= F.col("end"))
        & (F.col("w_start") <= F.col("start") + budget.history)
        & (F.col("w_tokens") <= F.col("cell")),
    )
    part = lambda fresh: F.struct(
        "seq", "role", "text", F.lit(fresh).alias("fresh")
    ).alias("part")
    members = new.select("conv_id", "window", "start", "tokens", part(True)).unionByName(
        history.select(
            "conv_id",
            F.col("w_window").alias("window"),
            F.col("w_start").alias("start"),
            "tokens",
            part(False),
        )
    )
    grouped = members.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list("part")).alias("parts"),
        F.sum("tokens").alias("tokens"),
        F.min("start").alias("start"),
    )
    system = placed.filter("pinned").select(
        F.col("conv_id").alias("s_conv"),
        F.col("tokens").alias("s_tokens"),
        F.struct("seq", "role", "text").alias("s_turn"),
        "conv_rows",
    )
    turn = lambda fresh: F.array(
        F.struct(
            F.col("s_turn.seq").alias("seq"),
            F.col("s_turn.role").alias("role"),
            F.col("s_turn.text").alias("text"),
            fresh.alias("fresh"),
        )
    )
    with_system = grouped.join(
        system, F.col("conv_id").eqNullSafe(F.col("s_conv")), "left"
    ).select(
        "conv_id",
        "window",
        (F.col("tokens") + F.coalesce("s_tokens", F.lit(0))).alias("tokens"),
        F.when(
            F.col("s_turn").isNotNull(),
            F.concat(turn(F.col("start") == 0), F.col("parts")),
        )
        .otherwise(F.col("parts"))
        .alias("parts"),
    )
    alone = system.filter("conv_rows = 1").select(
        F.col("s_conv").alias("conv_id"),
        F.lit(0).cast("long").alias("window"),
        F.col("s_tokens").alias("tokens"),
        turn(F.lit(True)).alias("parts"),
    )
    return _formatted(with_system.unionByName(alone)).select(*_OUT)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted window, as an array of structs of role and text."""
    pieces = F.split(formatted, r"<\|end\|>")
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            unescape(F.substring_index(F.replace(p, F.lit(START), F.lit("")), SEP, 1)).alias("role"),
            unescape(F.substring_index(p, SEP, -1)).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, one after the other."""
    return F.array_join(
        F.transform(
            spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))
        ),
        "",
    )
