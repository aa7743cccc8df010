"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation's rows must be edited until the initials of its roles spell
``(s?(ua)+)?``; the cheapest edits are a shortest path through four states (nothing
yet, after s, after u, after a).

1. Rows are counted by conversation, turn, role and text digest, sorted by a range
   exchange and cut into chunks of ``CHUNK`` rows, so that a conversation of any length
   spreads over tasks.  A chunk holds row codes, not texts.
2. Every chunk runs Viterbi backwards from a speculative cost vector (the one of the
   end of a conversation).  Fix-up passes rerun the chunks whose vector to start from,
   the one that the next chunk has found, differs from what they used by more than a
   constant; they end when there is none.  Costs to go are then right in every chunk up
   to a constant, which changes no decision.
3. Tracing takes at each row the first letter, in ASCII order, that lies on a cheapest
   path.  A chunk's trace depends on the state it is entered in: every chunk of a
   conversation of several says which state it leaves in for each of the four, and these
   maps are put together along the conversation.
4. The edits of each chunk are then written out, and texts joined to the rows kept.

What is collected for one conversation is its chunks' vectors and maps, a few numbers
for ``CHUNK`` rows each.  If a chunk's rows must all go, its vector passes through it
unchanged, so a run of such chunks takes as many passes as it has chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

CHUNK = 4096                    # rows of a chunk
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
START, AFTER_S, AFTER_U, AFTER_A = range(4)
WANTED = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)   # state after the role that a state waits for
ROLES = ("user", "user", "assistant", "user")   # and that role
INITIALS = "sua"                                # codes 0 to 2; 3 is any other
KEEPS = {(START, 0): AFTER_S, (START, 1): AFTER_U, (AFTER_S, 1): AFTER_U, (AFTER_U, 2): AFTER_A, (AFTER_A, 1): AFTER_U}
LEGAL = {(0, 1), (1, 2), (2, 1)}
FINE, BLANK, DUPLICATE, CUT = range(4)
END = [0, 2 * INSERT, INSERT, 0]                # costs to go after the last row
BLANKS = r"[^\x20\x09-\x0D]"                    # what a blank text lacks
NONE = float("inf")


def back(costs: list[int], code: int) -> list[int]:
    """Costs to go before a row (code: initial + 4 * fault), from those after it."""
    initial, fault = code % 4, code // 4
    if fault in (BLANK, DUPLICATE):
        new = [c + DELETE for c in costs]
    else:
        extra = TRUNCATED if fault == CUT else 0
        new = [min(costs[s] + DELETE, costs[WANTED[s]] + REROLE + extra,
                   costs[KEEPS[s, initial]] + extra if (s, initial) in KEEPS else NONE) for s in range(4)]
    for _ in range(2):
        new = [min(new[s], new[WANTED[s]] + INSERT) for s in range(4)]
    return new


def backward(codes: bytes, end: list[int]) -> list[list[int]]:
    """Costs to go before each row and after the last."""
    costs = [end]
    for code in reversed(codes):
        costs.append(back(costs[-1], code))
    return costs[::-1]


def trace(codes: bytes, costs: list[list[int]], state: int, last: bool) -> tuple[list[tuple[int, str, int]], int]:
    """Edits (row, letter, state before) from a state on, least in ASCII order among the
    cheapest, and the state at the end.  Inserts after the last row are left to the next
    chunk, if there is one."""
    edits, at, n = [], 0, len(codes)
    while at < n or (last and costs[n][state]):
        here = costs[at][state]
        letter = after = None
        if at < n:
            initial, fault = codes[at] % 4, codes[at] // 4
            must_go = fault in (BLANK, DUPLICATE)
            extra = TRUNCATED if fault == CUT else 0
            if costs[at + 1][state] + DELETE == here:
                letter, after = "D", state
        if letter is None and costs[at][WANTED[state]] + INSERT == here:
            letter, after = "I", WANTED[state]
        if letter is None and not must_go and (state, initial) in KEEPS \
                and costs[at + 1][KEEPS[state, initial]] + extra == here:
            letter, after = "K", KEEPS[state, initial]
        if letter is None:
            letter, after = "R", WANTED[state]
        edits.append((at, letter, state))
        at += letter != "I"
        state = after
    return edits, state


# --------------------------------------------------------------------------
# Rows and chunks

def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def row_keys(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, ck, turn, role, key, text): ``ck`` is the id as text, also where it is null."""
    def col(name):
        return F.col(f"`{name}`")
    return rows.select(
        col(id_col).alias("conv"), F.when(col(id_col).isNull(), "").otherwise(F.concat(F.lit("="), col(id_col).cast("string"))).alias("ck"),
        col(turn_col).cast("long").alias("turn"), F.coalesce(col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(col(text_col), F.lit(" ")).alias("text")).withColumn("key", digest(F.col("text")))


def counted(rows: DataFrame) -> DataFrame:
    """Distinct rows in number (``many``) with the code of the first; the others are copies."""
    lowest = F.lit(-2**63).cast("long")
    signs = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    each = rows.select(
        "conv", "ck", "turn", "role", "key", (~F.rlike("text", F.lit(BLANKS))).alias("blank"),
        (~F.substring(signs, -1, 1).isin(".", "!", "?")).alias("cut")) \
        .groupBy("conv", "ck", "turn", "role", "key", "blank", "cut").agg(F.count("*").alias("many"))
    first = each.groupBy("ck", "role", "key").agg(F.min(F.coalesce("turn", lowest)).alias("first"))
    fault = F.when(F.col("blank"), BLANK).when(F.coalesce("turn", lowest) > F.col("first"), DUPLICATE) \
        .when(F.col("cut"), CUT).otherwise(FINE)
    initial = F.coalesce(F.element_at(
        F.create_map(*[x for i, c in enumerate(INITIALS) for x in (F.lit(c), F.lit(i))]), F.substring("role", 1, 1)), F.lit(3))
    return each.join(first, ["ck", "role", "key"]).select(
        "conv", "ck", "turn", "role", "key", "many", (initial + 4 * fault).alias("code"))


ROW = "struct<turn:bigint,role:string,key:string,many:bigint>"


def chunks_of(rows: DataFrame, chunk: int) -> DataFrame:
    """(conv, ck, part, seq, codes, rows) of every chunk; (part, seq) orders those of a conversation."""
    ordered = rows.repartitionByRange("ck", "turn", "role", "key").sortWithinPartitions("ck", "turn", "role", "key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, []
        names, kinds = None, None

        def hand_on():
            nonlocal seq, held
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
            codes = bytes(table.column(names.index("code")).to_pylist())
            inner = pa.StructArray.from_arrays([table.column(names.index(c)) for c in ("turn", "role", "key", "many")],
                                               names=["turn", "role", "key", "many"])
            seq += 1
            return pa.RecordBatch.from_arrays(
                [table.column(names.index("conv")).slice(0, 1), table.column(names.index("ck")).slice(0, 1),
                 pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([codes], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(inner)], pa.int32()), inner)],
                names=["conv", "ck", "part", "seq", "codes", "rows"])

        current, size = None, 0
        for batch in batches:
            names = batch.schema.names
            keys = batch.column(names.index("ck")).to_pylist()
            at = 0
            for i in range(len(keys) + 1):
                if i == len(keys) or keys[i] != current or size + i - at >= chunk:
                    if i > at:
                        held.append(batch.slice(at, i - at))
                        size += i - at
                    if i < len(keys) and held:
                        yield hand_on()
                        size = 0
                    at = i
                    if i < len(keys):
                        current = keys[i]
        if held:
            yield hand_on()

    conv = rows.schema["conv"].dataType.simpleString()
    return ordered.mapInArrow(cut, f"conv {conv}, ck string, part int, seq long, codes binary, rows array<{ROW}>")


# --------------------------------------------------------------------------
# Cost vectors

KEYS = ["ck", "part", "seq"]
STATE = "ck string, part int, seq long, used array<long>, start array<long>"


def run_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ck, part, seq, codes, used) -> the vector at the start of each chunk from ``used`` at its end."""
    for batch in batches:
        start = []
        for codes, used in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            costs = used
            for code in reversed(codes):
                costs = back(costs, code)
            start.append([c - min(costs) for c in costs])
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in (0, 1, 2, 4)], pa.array(start, pa.list_(pa.int64()))],
                                         names=["ck", "part", "seq", "used", "start"])


def settle(chunks: DataFrame) -> DataFrame:
    """(ck, part, seq, used, several): the vector that each chunk ends with, right up to a
    constant, and whether its conversation has several chunks."""
    end = F.array(*[F.lit(c).cast("long") for c in END])
    state = chunks.select(*KEYS, "codes", end.alias("used")).mapInArrow(run_back, STATE)
    order = Window.partitionBy("ck").orderBy("part", "seq")

    def shape(v: str) -> Column:
        return F.transform(v, lambda c: c - F.element_at(v, 1))

    while True:
        state = materialize(state.withColumn("next", F.lead("start").over(order)).withColumn(
            "several", F.col("next").isNotNull() | F.lag("seq").over(order).isNotNull()).withColumn(
            "rerun", F.col("next").isNotNull() & (shape("next") != shape("used"))))
        if state.where("rerun").isEmpty():
            return state.select(*KEYS, "used", "several", F.col("next").isNull().alias("last"))
        again = chunks.select(*KEYS, "codes").join(
            state.where("rerun").select(*KEYS, F.col("next").alias("used")), KEYS).mapInArrow(run_back, STATE)
        state = state.where("NOT rerun").select(*KEYS, "used", "start").union(again)


def entered(chunks: DataFrame, state: DataFrame) -> DataFrame:
    """(ck, part, seq, entry): the state in which each chunk of a conversation of several is entered."""
    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for codes, used, last in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5))):
                costs = backward(codes, used)
                out.append([trace(codes, costs, s, last)[1] for s in range(4)])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(3)] + [pa.array(out, pa.list_(pa.int32()))],
                                             names=[*KEYS, "leaves"])

    maps = chunks.select(*KEYS, "codes").join(state.where("several").drop("several"), KEYS) \
        .select(*KEYS, "codes", "used", "last").mapInArrow(leave, "ck string, part int, seq long, leaves array<int>")
    every = maps.groupBy("ck").agg(F.sort_array(F.collect_list(F.struct("part", "seq", "leaves"))).alias("all"))
    states = F.aggregate("all", F.array(F.lit(START)), lambda s, m: F.concat(
        s, F.array(F.element_at(m["leaves"], F.element_at(s, -1) + 1))))
    return every.select("ck", F.explode(F.arrays_zip("all", states.alias("entry"))).alias("x")) \
        .where("x.all IS NOT NULL").select("ck", "x.all.part", "x.all.seq", "x.entry")


KEPT = "struct<place:int,edit:string,role:string,turn:bigint,was:string,key:string>"
SOLVED = ("conv {conv}, ck string, part int, seq long, first int, last int, audit string, cost long, blank long, "
          f"duplicate long, truncated long, illegal long, kept array<{KEPT}>")


def write_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, ck, part, seq, codes, rows, used, last, entry) -> edits and counts of each chunk."""
    kept_type = pa.list_(pa.struct([("place", pa.int32()), ("edit", pa.string()), ("role", pa.string()),
                                    ("turn", pa.int64()), ("was", pa.string()), ("key", pa.string())]))
    for batch in batches:
        out: list[tuple] = []
        for codes, rows, used, last, entry in zip(*(batch.column(i).to_pylist() for i in range(4, 9))):
            costs = backward(codes, used)
            edits, state = trace(codes, costs, entry, last)
            copies = [r["many"] - 1 for r in rows]
            audit, kept, cost = [], [], DELETE * sum(copies)
            for at, letter, before in edits:
                if letter == "I":
                    cost += INSERT
                    kept.append({"place": len(kept), "edit": "I", "role": ROLES[before], "turn": None, "was": None, "key": None})
                    audit.append("I")
                    continue
                row = rows[at]
                if letter == "D":
                    cost += DELETE
                else:
                    cost += (letter == "R") * REROLE + (codes[at] // 4 == CUT) * TRUNCATED
                    kept.append({"place": len(kept), "edit": letter, "role": row["role"] if letter == "K" else ROLES[before],
                                 "turn": row["turn"], "was": row["role"], "key": row["key"]})
                audit.append(letter + "D" * copies[at])
            faults = [c // 4 for c in codes]
            blank = sum(n + 1 for n, f in zip(copies, faults) if f == BLANK)
            duplicate = sum(n + (f == DUPLICATE) for n, f in zip(copies, faults) if f != BLANK)
            illegal = sum(copies) + sum((a % 4, b % 4) not in LEGAL for a, b in zip(codes, codes[1:]))
            out.append((codes[0] % 4, codes[-1] % 4, "".join(audit), cost, blank, duplicate, faults.count(CUT), illegal, kept))
        kinds = [pa.int32(), pa.int32(), pa.string()] + [pa.int64()] * 5 + [kept_type]
        names = ["conv", *KEYS, "first", "last", "audit", "cost", "blank", "duplicate", "truncated", "illegal", "kept"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in range(4)] + [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=names)


# --------------------------------------------------------------------------
# Operator

@dataclass
class Repair:
    """``reports``: one row a conversation (``id_col``, gaps, blank, duplicate, truncated, illegal,
    cost, audit).  ``turns``: the repaired rows (``id_col``, part, seq, place, edit, role, text), in a
    conversation ordered by part, seq and place."""

    reports: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", chunk: int = CHUNK) -> Repair:
    """Cheapest edits that give every conversation the roles ``(s?(ua)+)?``.

    Rows are taken by turn (none first), then role and text digest.  A row's first fault
    counts: blank, duplicate (role and text seen earlier), truncated (its last character but
    white space is none of ``.!?``).  Keep costs 0, Rerole 1, Delete 2 (the only edit of blank
    and duplicate rows), Insert of an empty turn 5; truncated rows that stay cost 5 more.
    ``audit`` holds the edits' initials, the least in ASCII order of the cheapest.

    Null ids are one conversation; a null role or text counts as one space.  Repeated rows
    are duplicates.  An empty table gives no rows.  Other columns are not read."""
    given = row_keys(rows, id_col, turn_col, role_col, text_col)
    chunks = materialize(chunks_of(counted(given), chunk))
    state = settle(chunks)
    entry = entered(chunks, state)
    conv = chunks.schema["conv"].dataType.simpleString()
    solved = materialize(
        chunks.join(state, KEYS).join(entry, KEYS, "left")
        .select("conv", *KEYS, "codes", "rows", "used", "last", F.coalesce("entry", F.lit(START)).alias("entry"))
        .mapInArrow(write_out, SOLVED.format(conv=conv)))

    order = Window.partitionBy("ck").orderBy("part", "seq")
    legal = F.concat(F.col("last"), F.lit(":"), F.lead("first").over(order))
    between = F.when(legal.isNotNull() & ~legal.isin(*[f"{a}:{b}" for a, b in LEGAL]), 1).otherwise(0)
    sums = solved.withColumn("illegal", F.col("illegal") + between).groupBy("ck").agg(
        F.first("conv").alias(id_col),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "seq", "audit"))),
                                 lambda x: x["audit"]), "").alias("audit"))
    turns = given.select("ck", "turn").distinct().groupBy("ck").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    reports = sums.join(turns, "ck").select(f"`{id_col}`", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    texts = given.groupBy("ck", "turn", "role", "key").agg(F.first("text").alias("text"))
    kept = solved.select("conv", *KEYS, F.explode("kept").alias("x")).select("conv", *KEYS, "x.*")
    found = kept.alias("k").where("key IS NOT NULL").join(
        texts.alias("t"), F.expr("k.ck = t.ck AND k.turn <=> t.turn AND k.was = t.role AND k.key = t.key")) \
        .select("k.conv", "k.part", "k.seq", "k.place", "k.edit", "k.role", "t.text")
    added = kept.where("key IS NULL").select("conv", "part", "seq", "place", "edit", "role", F.lit("").alias("text"))
    return Repair(reports, found.union(added).withColumnRenamed("conv", id_col))
