"""Sharding by histogram sort: shards of near-equal bytes, one exchange.

Rows are ordered by a 128-bit key, (hash of the text, hash of the id and row), so copies
of a text are neighbours.  The splitters between the shards are found without
sorting: each round counts, in one pass over the keys, the exact bytes between
probe keys (partial sums per task, a few numbers to the driver), keeps for
every splitter the interval that holds its target, and lays new probes into
it.  A splitter is done when the bytes below it meet the tolerance, or when its
interval holds a single key.  Then rows are exchanged once, range-partitioned
by (shard, key), and written; places within a shard come from the places in
the written partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import beside, materialize

TOLERANCE = 0.001   # of a shard's share of the bytes
PROBES = 15         # for each open splitter and round
HALF, WHOLE = 2**63, 2**128


def below(a: Column, b: Column, probe: int) -> Column:
    """Whether the key (a, b) of signed halves is smaller than a probe."""
    if probe >= WHOLE:  # an empty last shard begins there
        return F.lit(True)
    x, y = (F.lit(v - HALF).cast("long") for v in divmod(probe, 2**64))
    return (a < x) | ((a == x) & (b < y))


def as_number(a: int, b: int) -> int:
    """A key of signed halves as a number from 0 to 2 ** 128 - 1, in the same order."""
    return (a + HALF) * 2**64 + b + HALF


def span_of(cell, low: int, high: int) -> tuple[int, int]:
    """The first key that a cell from ``low`` to ``high`` may hold, and the one after its last."""
    first, last = (cell["b0"], cell["b1"]) if cell["a0"] == cell["a1"] else (-HALF, HALF - 1)
    return max(low, as_number(cell["a0"], first)), min(high, as_number(cell["a1"], last) + 1)


def cell_of(a: Column, b: Column, probes: list[int]) -> Column:
    """Number of probes (sorted) that are not above the key, by binary decisions."""
    def part(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(below(a, b, probes[middle]), part(low, middle)).otherwise(part(middle + 1, high))
    return part(0, len(probes))


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE, probes: int = PROBES) -> list[int]:
    """Keys at which shards 1 to ``shards - 1`` begin, for rows (a, b, size)."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    targets = [total * i / shards for i in range(1, shards)]
    # for each splitter, the interval of keys it lies in, and the exact bytes below either end
    spans = {i: (0, 0, WHOLE, total) for i in range(len(targets))}
    found: dict[int, int] = {}
    while spans:
        laid = sorted({low + (high - low) * n // (probes + 1)
                       for low, _, high, _ in spans.values() for n in range(1, probes + 1)} - {0})
        cells = (keys.withColumn("cell", cell_of(F.col("a"), F.col("b"), laid))
                 .groupBy("cell").agg(F.sum("size").alias("size"), *[f(c).alias(f"{c}{n}") for c in "ab" for n, f in enumerate((F.min, F.max))]))
        cells = {r["cell"]: r for r in cells.collect()}  # at most one row a probe, and one
        known, under = [(0, 0)], 0
        for n in range(len(laid) + 1):
            if n in cells:  # no key lies between a probe and a cell's first, or after its last
                first, after = span_of(cells[n], laid[n - 1] if n else 0, laid[n] if n < len(laid) else WHOLE)
                known.append((first, under))
                under += cells[n]["size"]
                known.append((after, under))
            if n < len(laid):
                known.append((laid[n], under))
        # this round's probes needn't include the ends that earlier rounds found
        known += [end for low, under, high, over in spans.values() for end in ((low, under), (high, over))]
        for i in list(spans):
            low, under = max((k for k in known if k[1] <= targets[i]))
            high, over = min((k for k in known if k[1] >= targets[i]))
            gaps = targets[i] - under, over - targets[i]
            if min(gaps) <= tolerance * total / shards or high - low <= 1:
                found[i] = low if gaps[0] <= gaps[1] else high
                del spans[i]
            else:
                spans[i] = low, under, high, over
    return [found[i] for i in sorted(found)]


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                   tolerance: float = TOLERANCE) -> DataFrame:
    """``docs``, written to the shared folder in shard order, with ``shard`` (0 to
    ``shards - 1``), ``slot`` (place in the shard, gapless from 0) and ``size`` (UTF-8
    bytes of the text plus 1).

    The shards' bytes are equal up to ``tolerance``, or to the nearest row where
    rows are too large for that.  Copies of a text stay together unless a boundary
    must fall among them.  A null text has size 1; null ids and repeated rows are
    rows like any other.  An empty table gives no rows.  Columns of the input that bear one of
    the new names give way."""
    text, name = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    work = beside(docs, "shard", "slot", "size")
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot", "size")]
    # the row's number only parts copies that have the same id
    a, b = F.xxhash64(text), F.xxhash64(name, F.monotonically_increasing_id())
    keys = materialize(docs.select(a.alias("a"), b.alias("b"), size.alias("size")))
    at = splitters(keys, shards, tolerance)
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in ("shard", "slot", "size")]
    rows = docs.select(*own, size.alias("size"), F.struct(a.alias("a"), b.alias("b")).alias(work))
    rows = rows.withColumn("shard", cell_of(F.col(f"{work}.a"), F.col(f"{work}.b"), at) if at else F.lit(0))
    key = ["shard", f"{work}.a", f"{work}.b"]
    rows = materialize(rows.repartitionByRange(*key).sortWithinPartitions(*key)
                       .select(*kept, "size", "shard", F.monotonically_increasing_id().alias(work)))
    part = F.shiftright(work, 33)
    runs = rows.groupBy("shard", part.alias("part")).agg(F.count("*").alias("n"), F.min(work).alias("first"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each shard in each written partition
    runs = runs.select(F.struct("shard", "part").alias(work + "run"),
                       (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias(work + "shift"))
    return rows.join(runs, F.struct(F.col("shard").alias("shard"), part.alias("part")) == F.col(work + "run")) \
        .select(*kept, "size", "shard", (F.col(work) + F.col(work + "shift")).alias("slot"))
