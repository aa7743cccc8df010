"""SimHash near-duplicates with a Gray-order hierarchical index.

A document's 64-bit fingerprint is the bitwise majority over the XXH64 values
of its word shingles.  Two documents are linked when their fingerprints differ
in at most ``max_bits`` bits; a component is a set of documents connected by
links.

How links are found:

1. Fingerprints are made distinct (partial aggregation, so a fingerprint that
   a third of all documents share is one row per task).
2. The upper nodes of the index are masked bit patterns: the 64 bits are cut
   into ``max_bits + 1`` blocks, and two fingerprints within the distance
   agree on at least one block, so all links lie inside the nodes
   (block, value of the block).  Rows are exchanged once, range-partitioned
   and sorted by (block, value, Gray rank); a node of any size is dealt over
   as many tasks as its rows need.
3. Inside a task each node's rows, at most ``CHUNK`` at a time, are factored
   further: runs of Gray-adjacent rows become inner nodes holding the bits
   that all their members share and no ancestor holds.  A search adds up the
   differences of those bits on the way down and drops a whole group once they
   exceed the distance, or once the group already belongs to the searcher's
   component.
4. A node cut into several chunks is finished by pairs of chunks, dropped
   where the bits common to the chunks already differ too much.
5. Chunks report a spanning forest, never all pairs.  Components of the forest
   come from alternating large-star and small-star rounds.

Fingerprints, links and components stay in distributed tables throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

SEED = 42
CHUNK = 4096          # rows of one node that are searched at once
FAN = 8               # children of an inner node of the index
SLICE = 1024          # searches that run down the index together


# --------------------------------------------------------------------------
# Fingerprints

def fingerprint(text: str | None, words: int) -> int:
    """Majority bits of the XXH64 values of all ``words``-word shingles.

    A-Z is lower-cased, words are runs without ASCII white space, shingles
    join them by one space.  Fewer words than ``words`` are one shingle; no
    words (or a null text) give 0."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    n = max(1, len(tokens) - words + 1)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], spaces + 1))[:n].tolist()
    ends = np.concatenate((spaces, [len(joined)]))[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):  # bounded memory for a very long text
        hashes = np.array([digest(joined[s:e], SEED)
                           for s, e in zip(starts[at:at + 65536], ends[at:at + 65536])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, words: int = 3) -> Column:
    """Fingerprint of a text column as a (signed) long."""
    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [fingerprint(t.as_py(), words) for t in texts]
            yield pa.array(np.array(found, np.uint64).view(np.int64))
    return run(text)


# --------------------------------------------------------------------------
# Index

def gray_rank(code: Column) -> Column:
    """Position of a 64-bit code word in the Gray sequence, in an order that
    signed longs keep."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-2**63).cast("long"))


def block_bounds(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of ``max_bits + 1`` blocks that cover 64 bits evenly."""
    edges = [round(i * 64 / (max_bits + 1)) for i in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def shared_bits(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the bits that each run of ``codes`` shares, and their values."""
    every = np.bitwise_and.reduceat(codes, starts)
    some = np.bitwise_or.reduceat(codes, starts)
    mask = every | ~some
    return mask, every & mask


class Index:
    """Hierarchy over codes in Gray order; ``group`` numbers the upper nodes."""

    def __init__(self, codes: np.ndarray, group: np.ndarray, label: np.ndarray):
        self.codes = codes
        starts = np.arange(len(codes))
        top = group
        self.levels = []  # from the leaves upwards: (child starts, mask, pattern, last row, low label, high label)
        mask, pattern = np.full(len(codes), ~np.uint64(0)), codes
        bounds = [(starts, mask, pattern)]
        while len(top) != len(np.unique(top)):
            new = np.concatenate(([True], top[1:] != top[:-1]))
            first = np.maximum.accumulate(np.where(new, np.arange(len(top)), 0))
            cut = np.flatnonzero((np.arange(len(top)) - first) % FAN == 0)
            starts = starts[cut]
            bounds.append((starts, *shared_bits(codes, starts)))
            self.levels.append(cut)
            top = top[cut]
        self.root_of = np.searchsorted(starts, np.arange(len(codes)), side="right") - 1
        self.nodes = []
        for depth, (rows, mask, pattern) in enumerate(bounds):
            if depth + 1 < len(bounds):  # bits that the parent holds count there
                parent = np.searchsorted(bounds[depth + 1][0], rows, side="right") - 1
                own = mask & ~bounds[depth + 1][1][parent]
            else:
                own = mask
            ends = np.concatenate((rows[1:], [len(codes)]))
            self.nodes.append((own, pattern, ends, np.minimum.reduceat(label, rows),
                               np.maximum.reduceat(label, rows)))

    def search(self, codes: np.ndarray, roots: np.ndarray, max_bits: int,
               label: np.ndarray, after: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query number, row) within ``max_bits``, less those whose row
        already has the query's label; ``after``: only rows beyond this one."""
        query, node = np.arange(len(codes)), roots
        spent = np.zeros(len(codes), np.uint8)
        for depth in range(len(self.nodes) - 1, -1, -1):
            own, pattern, ends, low, high = self.nodes[depth]
            spent = spent + np.bitwise_count((codes[query] ^ pattern[node]) & own[node])
            keep = spent <= max_bits
            keep &= ~((low[node] == high[node]) & (low[node] == label[query]))
            if after is not None:
                keep &= ends[node] - 1 > after[query]
            query, node, spent = query[keep], node[keep], spent[keep]
            if depth:
                cut = self.levels[depth - 1]
                below = np.concatenate((cut, [len(self.nodes[depth - 1][0])]))
                many = below[node + 1] - below[node]
                offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                query, spent = np.repeat(query, many), np.repeat(spent, many)
                node = np.repeat(below[node], many) + offset
        return query, node


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (row -> smallest row of its set) after joining rows a and b."""
    while len(a):
        la, lb = label[a], label[b]
        if (la == lb).all():
            break
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while not np.array_equal(label[label], label):
            label = label[label]
    return label


def link_rows(codes: np.ndarray, group: np.ndarray, max_bits: int) -> np.ndarray:
    """Component labels of rows that are linked inside their group."""
    label = np.arange(len(codes))
    for step in (1, 2, 3):  # most copies are Gray neighbours: join those first
        near = np.flatnonzero((group[step:] == group[:-step])
                              & (np.bitwise_count(codes[step:] ^ codes[:-step]) <= max_bits))
        label = merge_labels(label, near, near + step)
    index = Index(codes, group, label)
    for at in range(0, len(codes), SLICE):
        rows = np.arange(at, min(at + SLICE, len(codes)))
        query, row = index.search(codes[rows], index.root_of[rows], max_bits, label[rows], rows)
        label = merge_labels(label, rows[query], row)
    return label


LINK_SCHEMA = ("block int, node long, chunk long, a long, b long, mask long, pattern long, "
               "members binary, labels binary")


def forest_tasks(max_bits: int):
    """mapInArrow function: rows sorted by (block, value, Gray rank) -> edges of
    each chunk's spanning forest (a, b), and chunks that are only part of a node."""
    def edges(a, b):
        n = len(a)
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int32()), none, none, pa.array(a, pa.int64()), pa.array(b, pa.int64()),
             none, none, pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names=names)

    def parts(rows):
        cols = list(zip(*rows))
        none = pa.nulls(len(rows), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
             none, none, pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()),
             pa.array(cols[5], pa.binary()), pa.array(cols[6], pa.binary())], names=names)

    names = [c.split()[0] for c in LINK_SCHEMA.split(", ")]

    def run(batches):
        task = TaskContext.get().partitionId() << 32
        seen = 0
        held = None         # rows of the last node so far
        is_open = True      # the held node began in another task or chunk

        def work(block, node, code, first_open, last_open):
            """Whole nodes, except that the first and last may be parts."""
            nonlocal seen
            key = np.concatenate(([True], (node[1:] != node[:-1]) | (block[1:] != block[:-1])))
            group = np.cumsum(key) - 1
            label = link_rows(code, group, max_bits)
            own = np.flatnonzero(label != np.arange(len(code)))
            if len(own):
                yield edges(code[own].view(np.int64), code[label[own]].view(np.int64))
            last = group[-1]
            partial = {g for g, is_part in ((0, first_open), (last, last_open)) if is_part}
            out = []
            for g in sorted(partial):
                at = np.flatnonzero(group == g)
                mask, pattern = shared_bits(code[at], np.array([0]))
                out.append((int(block[at[0]]), int(node[at[0]]), task + seen,
                            int(mask.view(np.int64)[0]), int(pattern.view(np.int64)[0]),
                            code[at].tobytes(), code[label[at]].tobytes()))
                seen += 1
            if out:
                yield parts(out)

        for batch in batches:
            block = batch.column(0).to_numpy(zero_copy_only=False)
            node = batch.column(1).to_numpy(zero_copy_only=False)
            code = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(block):
                continue
            if held is not None:
                block, node, code = (np.concatenate(x) for x in zip(held, (block, node, code)))
            new = np.flatnonzero((node[1:] != node[:-1]) | (block[1:] != block[:-1])) + 1
            cut = int(new[-1]) if len(new) else 0
            at = 0
            while at < cut:  # whole nodes, about CHUNK rows at a time
                if cut - at > CHUNK:
                    fits = new[(new > at) & (new <= at + CHUNK)]
                    end = int(fits[-1]) if len(fits) else int(new[new > at][0])
                else:
                    end = cut
                if end - at > CHUNK:  # one large node: chunk by chunk
                    while end - at > CHUNK:
                        yield from work(block[at:at + CHUNK], node[at:at + CHUNK], code[at:at + CHUNK], True, True)
                        at += CHUNK
                    is_open = True
                yield from work(block[at:end], node[at:end], code[at:end], is_open, False)
                is_open, at = False, end
            while len(code) - at > CHUNK:  # the last node is large already
                yield from work(block[at:at + CHUNK], node[at:at + CHUNK], code[at:at + CHUNK], True, True)
                at += CHUNK
                is_open = True
            held = block[at:], node[at:], code[at:]
        if held is not None and len(held[0]):
            yield from work(*held, is_open, True)
    return run


def bridge_tasks(max_bits: int):
    """mapInArrow function: pairs of chunks of one node -> edges that join their forests."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                code = [np.frombuffer(row[c], np.uint64) for c in ("left_members", "members")]
                root = [np.frombuffer(row[c], np.uint64) for c in ("left_labels", "labels")]
                both = np.concatenate(code)
                name, label = np.unique(np.concatenate(root), return_inverse=True)
                joined = np.arange(len(name))
                n, found = len(code[0]), []
                index = Index(code[1], np.zeros(len(code[1]), np.int64), label[n:])
                for at in range(0, n, SLICE):
                    rows = np.arange(at, min(at + SLICE, n))
                    mine = joined[label[rows]]
                    query, other = index.search(both[rows], index.root_of[:1].repeat(len(rows)), max_bits, mine, None)
                    a, b = label[rows[query]], label[n + other]
                    new = joined[a] != joined[b]
                    if new.any():
                        pair = np.unique(np.stack((a[new], b[new])), axis=1)
                        joined = merge_labels(joined, pair[0], pair[1])
                tied = np.flatnonzero(joined != np.arange(len(name)))
                if len(tied):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(name[tied].view(np.int64)), pa.array(name[joined[tied]].view(np.int64))],
                        names=["a", "b"])
    return run


def forest(codes: DataFrame, max_bits: int) -> DataFrame:
    """Edges (a, b) between distinct longs in column ``code`` whose transitive
    closure is that of all links within ``max_bits``."""
    blocks = F.array(*[
        F.shiftrightunsigned("code", shift).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1).cast("long"))
        for shift, width in block_bounds(max_bits)])
    nodes = (codes.select("code", F.posexplode(blocks).alias("block", "node"))
             .select("block", "node", "code", gray_rank(F.col("code")).alias("rank")))
    rows = (nodes.repartitionByRange("block", "node", "rank")
            .sortWithinPartitions("block", "node", "rank").drop("rank"))
    links = materialize(rows.mapInArrow(forest_tasks(max_bits), LINK_SCHEMA))
    inside = links.where("a IS NOT NULL").select("a", "b")
    chunks = links.where("chunk IS NOT NULL").drop("a", "b")
    # chunks of one node are paired without their members, which only the pairs left fetch
    shapes = chunks.select("block", "node", "chunk", "mask", "pattern")
    left = shapes.select("block", "node", *[F.col(c).alias(f"left_{c}") for c in ("chunk", "mask", "pattern")])
    common = F.col("left_mask").bitwiseAND(F.col("mask"))
    pairs = left.join(shapes, ["block", "node"]).where(
        (F.col("left_chunk") < F.col("chunk"))
        & (F.bit_count(F.col("left_pattern").bitwiseXOR(F.col("pattern")).bitwiseAND(common)) <= max_bits)) \
        .select("left_chunk", "chunk")
    members = chunks.select("chunk", "members", "labels")
    bridges = (pairs.join(members.select(*[F.col(c).alias(f"left_{c}") for c in members.columns]), "left_chunk")
               .join(members, "chunk").select("left_members", "left_labels", "members", "labels")
               .mapInArrow(bridge_tasks(max_bits), "a long, b long"))
    return inside.union(bridges)


# --------------------------------------------------------------------------
# Components

def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that isn't its own root;
    the root is the smallest node of the component.

    Alternates large-star and small-star; per-node minima are their own table,
    so that both sides of each join are plain exchanges whose hot keys Spark
    splits.  Stops when a round changes nothing."""
    edges = materialize(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    def sign(e):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    before = sign(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m"))
                            .select("u", F.least("u", "m").alias("m")))
        star = materialize(both.join(least, "u").where("v > u")
                           .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = materialize(star.groupBy("u").agg(F.min("v").alias("m")))
        edges = materialize(
            star.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).distinct())
        now = sign(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


# --------------------------------------------------------------------------
# Operator

def label_components(rows: DataFrame, max_bits: int) -> DataFrame:
    """(fingerprint, component, head) for each fingerprint of ``rows`` (id, row,
    fingerprint): the smallest id of the component and the row that stands for it."""
    # nulls last: a null id leads only where a component has no other
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    codes = materialize(rows.groupBy(F.col("fingerprint").alias("code")).agg(first))
    roots = components(forest(codes.select("code"), max_bits))
    owned = materialize(codes.join(roots, codes["code"] == roots["node"], "left")
                        .select("code", "first", F.coalesce("root", "code").alias("root")))
    heads = materialize(owned.groupBy("root").agg(F.min("first").alias("head")))
    return materialize(owned.join(heads, "root").select(
        F.col("code").alias("fingerprint"), F.col("head.id").alias("component"),
        F.col("head.row").alias("head")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per document: its id (``id_col``), ``fingerprint`` (long) and
    ``component`` (smallest id of its component).

    Null ids take part; a component that holds only null ids has a null
    ``component``.  Null and empty texts have fingerprint 0 and link like any
    other.  Repeated rows are rows of their own.  An empty table gives an empty
    one.  Other columns are not read, whatever their names."""
    rows = materialize(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"),
        fingerprint_column(F.col(f"`{text_col}`"), words).alias("fingerprint")))
    found = label_components(rows, max_bits)
    return rows.join(found, "fingerprint").select(
        F.col("id").alias(id_col), "fingerprint", "component")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with exactly one row of each component of ``near_duplicates``: a
    row with the smallest id (of several such rows, the first read).

    Nulls, empty texts and empty tables as there; all columns are kept, and
    names starting with ``_simhash_`` are taken for the work."""
    rows = materialize(
        docs.withColumn("_simhash_code", fingerprint_column(F.col(f"`{text_col}`"), words))
        .withColumn("_simhash_row", F.monotonically_increasing_id()))
    skinny = rows.select(F.col(f"`{id_col}`").alias("id"), F.col("_simhash_row").alias("row"),
                         F.col("_simhash_code").alias("fingerprint"))
    heads = label_components(skinny, max_bits).select("fingerprint", "head")
    copies = materialize(skinny.join(heads, "fingerprint").where("row <> head")
                         .select(F.col("row").alias("_simhash_row")))
    # a merge join at every size, rather than a broadcast while there are few copies
    return rows.join(copies.hint("merge"), "_simhash_row", "left_anti").drop("_simhash_code", "_simhash_row")
