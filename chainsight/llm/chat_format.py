"""Chat formatting in budgeted windows, in DataFrame functions only.

A turn is written ``<|role|>\\n``, its text, ``<|end|>\\n``.  Inside roles and texts a
backslash is put before every backslash and into every control string, and taken out
again on reading.

Windows are runs of whole turns.  Prefix sums of the turns' tokens choose them: a
window takes turns as long as their tokens, by the difference of two prefix sums, fit
what the budget leaves beside the system turn and the repeated history; a turn that
alone is larger is a window of its own, whole.  Every window begins with the system
turn (the conversation's first turn, if its role is ``system``) and with as many of the
turns just before it as ``history`` tokens allow.  The loss mask covers the texts of
the assistant turns that a window holds for the first time, so that each is a target
once; repeated turns are masked.

A conversation is worked on in blocks of ``BLOCK`` turn numbers, in which windows
start anew, so that one of any length spreads over tasks; the last ``CARRIED`` turn
numbers of a block go along as history of the next, and the system turn to all.  The
texts are shuffled once.  Rows that share a conversation and a turn number are in one
block, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUDGET = 1024           # tokens of a window
HISTORY = 256           # of them for repeated turns
BLOCK = 256             # turn numbers worked on together
CARRIED = 8             # turn numbers that a block hands on as history
MARKS = 4               # tokens that the marks of a turn count as
TOKEN = r"\p{L}+|\p{N}|[^\p{L}\p{N}\s]"
TURN_END = r"<\|end\|>\n"

#: What mustn't stand in a text: marks of this template and of others (fixed patterns; the
#: backslash goes after the first character).
CONTROL = (r"<(?=\||/?s>)", r"\|(?=>)", r"\[(?=/?INST\])")


def escape(text: Column) -> Column:
    out = F.regexp_replace(text, r"\\", r"\\\\")
    for pattern in CONTROL:
        out = F.regexp_replace(out, f"({pattern})", r"$1\\")
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN)) + MARKS


def add_up(values: Column, of) -> Column:
    """Prefix sums: what comes before each element, and after the last."""
    return F.aggregate(values, F.array(F.lit(0).cast("long")),
                       lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + of(x))))


def blocks_of(rows: DataFrame) -> DataFrame:
    """(conv, block, turns): sorted turns of each block; ``part`` 0 is the system turn of the
    conversation's first block, 1 the history of the block before, 2 the block's own."""
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK))

    def packed(df: DataFrame, block: Column, part: int) -> DataFrame:
        return df.select("conv", block.alias("block"), F.struct(
            F.lit(part).alias("part"), "turn", "role", "text").alias("turn"))

    # blocks after a conversation's first get its system turn; nearly always there are none
    seen = rows.where("turn IS NOT NULL").groupBy("conv", "block").agg(F.min("turn").alias("low"))
    first = seen.groupBy("conv").agg(F.min("low").alias("turn"))
    later = seen.select("conv", "block").join(first, "conv").where(F.col("block") > F.floor(F.col("turn") / BLOCK))
    system = rows.where("role = 'system'").drop("block").join(later, ["conv", "turn"])
    edge = rows.where(F.pmod("turn", F.lit(BLOCK)) >= BLOCK - CARRIED)
    every = packed(rows, F.col("block"), 2).union(packed(edge, F.col("block") + 1, 1)).union(
        packed(system, F.col("block"), 0))
    return every.groupBy("conv", "block").agg(F.sort_array(F.collect_list("turn")).alias("turns")) \
        .where(F.element_at("turns", -1)["part"] == 2)


def written(turn: Column) -> Column:
    head = F.concat(F.lit("<|"), escape(turn["role"]), F.lit("|>\n"))
    text = escape(turn["text"])
    return F.struct(F.concat(head, text, F.lit("<|end|>\n")).alias("whole"), F.length(head).alias("head"),
                    F.length(text).alias("size"), tokens(turn["text"]).cast("long").alias("tokens"),
                    turn["role"].alias("role"), turn["part"].alias("part"))


def format_chats(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY, id_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a window: ``id_col``, block, window (from 0 in a block), formatted, loss (array of
    start and end in code points of ``formatted``), repeated (turns at its beginning that an
    earlier window holds), turns (all), tokens.

    Rows are taken by turn, then role and text; rows without a turn number come first, in a
    block of their own (null).  A null role or text is an empty one.  Repeated rows are turns
    of their own.  Rows without an id are one conversation (without a system turn in later
    blocks).  An empty table gives no rows.  Other columns are not read."""
    given = rows.select(F.col(f"`{id_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    each = blocks_of(given).select("conv", "block", F.transform("turns", written).alias("turns"))
    # the system turn of an earlier block, else the block's first own turn if it is one
    carried = F.slice(F.filter("turns", lambda t: t["part"] == 0), 1, 1)
    each = each.select("conv", "block", carried.alias("carried"),
                       F.filter("turns", lambda t: t["part"] > 0).alias("turns"))
    each = each.withColumn("own", F.size(F.filter("turns", lambda t: t["part"] == 1)))
    here = F.when((F.size("carried") == 0) & (F.get("turns", F.col("own"))["role"] == "system"), 1).otherwise(0)
    each = each.select("conv", "block", "carried", "turns", "own", here.alias("here"))
    system = F.when(F.col("here") == 1, F.slice("turns", F.col("own") + 1, 1)).otherwise(F.col("carried"))
    each = each.select("*", system.alias("system"), add_up(F.col("turns"), lambda t: t["tokens"]).alias("sums"))
    each = each.withColumn("system_tokens", F.coalesce(F.get("system", F.lit(0))["tokens"], F.lit(0)))
    room = F.greatest(F.lit(1), budget - history - F.col("system_tokens"))
    each = each.withColumn("room", room)

    def sum_at(place: Column) -> Column:
        return F.element_at(F.col("sums"), (place + 1).cast("int"))

    def next_start(starts: Column, i: Column) -> Column:
        """A turn opens a window if the open one has no room for it."""
        last = F.element_at(starts, -1)
        return F.when((i > last) & (sum_at(i + 1) - sum_at(last) > F.col("room")), F.concat(starts, F.array(i))).otherwise(starts)

    each = each.withColumn("starts", F.aggregate(
        F.sequence(F.col("own"), F.size("turns") - 1), F.array(F.col("own")), next_start))
    # history: the earliest turn from which on the turns before the window have at most that many tokens
    lowest = F.when(F.col("here") == 1, F.col("own") + 1).otherwise(F.lit(0))
    ranges = F.transform("starts", lambda s, k: F.struct(
        s.alias("start"), F.coalesce(F.get("starts", k + 1), F.size("turns")).alias("stop"),
        F.coalesce(F.get(F.filter(F.sequence(F.least(lowest, s), s), lambda j: (j >= lowest) & (sum_at(s) - sum_at(j) <= history)), F.lit(0)),
                   s).alias("back"),
        ((k > 0) | (F.col("here") == 0)).alias("again")))
    windows = each.select("conv", "block", "turns", "system", F.posexplode(ranges).alias("window", "r"))
    empty = F.slice("turns", 1, 0)
    before = F.concat(F.when(F.col("r.again"), F.col("system")).otherwise(empty),
                      F.slice("turns", F.col("r.back") + 1, F.col("r.start") - F.col("r.back")))
    windows = windows.select("conv", "block", "window", before.alias("before"),
                             F.slice("turns", F.col("r.start") + 1, F.col("r.stop") - F.col("r.start")).alias("fresh"))
    windows = windows.withColumn("places", F.aggregate(
        "fresh", F.array(F.aggregate("before", F.lit(0), lambda s, t: s + F.length(t["whole"]))),
        lambda s, t: F.concat(s, F.array(F.element_at(s, -1) + F.length(t["whole"])))))
    spans = F.filter(F.transform("fresh", lambda t, i: F.struct(
        (F.get("places", i) + t["head"]).alias("start"), (F.get("places", i) + t["head"] + t["size"]).alias("end"),
        t["role"].alias("role"))), lambda s: s["role"] == "assistant")
    every = F.concat("before", "fresh")
    return windows.select(
        F.col("conv").alias(id_col), "block", "window",
        F.array_join(F.transform(every, lambda t: t["whole"]), "").alias("formatted"),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss"),
        F.size("before").alias("repeated"), F.size(every).alias("turns"),
        F.aggregate(every, F.lit(0).cast("long"), lambda s, t: s + t["tokens"]).alias("tokens"))


def read_turns(formatted: Column) -> Column:
    """array<struct(role, text)> of the turns in a formatted window."""
    pieces = F.split(formatted, TURN_END, -1)

    def read(piece: Column) -> Column:
        mark = F.locate("|>\n", piece) if isinstance(piece, str) else F.instr(piece, F.lit("|>\n"))
        return F.struct(unescape(F.substring(piece, F.lit(3), mark - 3)).alias("role"),
                        unescape(F.substring(piece, mark + 3, F.length(piece))).alias("text"))
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), read)


def read_targets(formatted: Column, loss: Column) -> Column:
    """array<string> of the texts under the loss mask."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"])))
