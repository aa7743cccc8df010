"""Ranked lexical search by NRA (no random access).

1. Items reach the tasks in blocks of about ``BLOCK_WORDS`` distinct (item, term)
   pairs.  One pass over the texts keeps, for each document, its number of terms and
   the occurrences of the block's terms: a narrow table of postings.
2. Spark adds up the corpus statistics from it: documents and terms in all, documents
   that hold each term.  They give every posting its impact.
3. Documents are dealt into shards of at most ``SHARD`` documents, each within one
   task.  A shard's postings are sorted by term and falling impact.  For every item the
   lists of its terms are read from the top, in steps that double.  What has been read
   of a document is the lower end of its score interval; the upper end adds, for every
   list in which it hasn't been seen, the impact at which that list stands.  A document
   whose upper end lies under the k-th lower end is out.  Reading goes on, in the lists
   that still matter, until no unseen document can enter and every document that may be
   among the k has a closed interval, so that scores and ties are exact.
4. Spark merges the shards' best.

Only statistics of a block's terms reach the driver; no texts are shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialize

K = 50
BLOCK_WORDS = 1_000_000     # distinct (item, term) pairs of a block of items
SHARD = 20_000              # documents of a shard
SHARD_POSTINGS = 4_000_000  # and postings
FIRST = 64                  # postings of the first step in each list

#: ASCII letters and digits, and everything beyond ASCII (fixed pattern).
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text: str | None) -> list[str]:
    """Terms of a text in order; only A to Z are lower-cased."""
    return TERM.findall((text or "").encode().lower().decode())


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(tf: np.ndarray, length: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What one posting adds to a score, before its term's weight."""
    m = 100 - 50 + (50 * length * documents) // total
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Shard:
    """Impact-sorted lists of a shard's postings."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, documents: int):
        order = np.lexsort((doc, -impact, term))
        self.term, self.doc, self.impact, self.documents = term[order], doc[order], impact[order], documents

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of the ``k`` best of an item, best first, ties to the smaller
        document number."""
        at = np.searchsorted(self.term, terms)
        end = np.searchsorted(self.term, terms, side="right")
        use = (end > at) & (weights > 0)
        at, end, weights = at[use].copy(), end[use], weights[use]
        low = np.zeros(self.documents, np.int64)
        seen = np.zeros((self.documents, len(at)), bool)
        stands = weights * self.impact[at] if len(at) else np.zeros(0, np.int64)
        active, step = np.arange(len(at)), FIRST
        while True:
            for t in active:
                stop = min(end[t], at[t] + step)
                docs = self.doc[at[t]:stop]
                low[docs] += weights[t] * self.impact[at[t]:stop]
                seen[docs, t] = True
                at[t] = stop
                stands[t] = weights[t] * self.impact[stop] if stop < end[t] else 0
            step *= 2
            found = np.flatnonzero(low)
            enough = len(found) >= k
            worst = int(np.partition(low[found], -k)[-k]) if enough else 0
            unseen = int(stands.sum())
            if unseen and (not enough or unseen >= worst):  # a document not seen yet may enter or tie
                active = np.flatnonzero(stands)
                continue
            rest = unseen - seen[found] @ stands
            alive = low[found] + rest >= worst
            found, rest = found[alive], rest[alive]
            open_ = found[rest > 0]
            active = np.flatnonzero((stands > 0) & ~seen[open_].all(axis=0))
            if not len(open_):
                order = np.lexsort((found, -low[found]))[:k]
                return found[order], low[found][order]


def read_postings(rows: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(id, n, terms, tfs) of every row (id, text): number of terms, and the occurrences of
    those in the vocabulary."""
    given = rows.sparkSession.sparkContext.broadcast(vocabulary)
    kind = to_arrow_type(rows.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = given.value
        for batch in batches:
            size, terms, tfs = [], [], []
            for value in batch.column(1):
                words = terms_of(value.as_py())
                many = Counter(words)
                held = [w for w in many if w in known]
                size.append(len(words))
                terms.append([known[w] for w in held])
                tfs.append([many[w] for w in held])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(kind), pa.array(size, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int32()))], names=["id", "n", "terms", "tfs"])

    out = f"id {rows.schema['id'].dataType.simpleString()}, n long, terms array<int>, tfs array<int>"
    return rows.mapInArrow(run, out)


def search_task(items: list, terms: list[np.ndarray], weights: np.ndarray, documents: int, total: int, k: int,
                shard: int, kind: pa.DataType, item_kind: pa.DataType):
    """mapInArrow function: postings -> each shard's best documents of every item."""
    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        table = table.take(pc.sort_indices(table, [("id", "ascending")])).combine_chunks()  # ties: nulls last
        held = table.column("terms").combine_chunks()
        many = np.diff(held.offsets.to_numpy())
        doc = np.repeat(np.arange(len(table)), many)
        tf = pc.list_flatten(table.column("tfs")).to_numpy().astype(np.int64)
        impact = impacts(tf, table.column("n").to_numpy()[doc], documents, total)
        lists = Shard(held.flatten().to_numpy(), doc, impact, len(table))
        item, place, score = [], [], []
        for i, own in enumerate(terms):
            docs, scores = lists.best(own, weights[own], k)
            item += [i] * len(docs)
            place.append(docs)
            score.append(scores)
        place, score = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (place, score))
        ids = table.column("id").combine_chunks().take(pa.array(place, pa.int64())).cast(kind)
        return pa.RecordBatch.from_arrays(
            [pa.array(items, item_kind).take(pa.array(item, pa.int64())), ids, pa.array(score, pa.int64())],
            names=["item", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, held = [], 0, 0
        for batch in batches:
            for at in range(0, len(batch), shard):
                part = batch.slice(at, shard)
                more = len(pc.list_flatten(part.column(2)))
                if parts and (rows + len(part) > shard or held + more > SHARD_POSTINGS):
                    yield solve(parts)
                    parts, rows, held = [], 0, 0
                parts.append(part)
                rows, held = rows + len(part), held + more
        if parts:
            yield solve(parts)
    return run


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS,
           shard: int = SHARD) -> DataFrame:
    """(``item_col``, rank, ``id_col``, score): for each item the ``k`` documents of highest
    score above 0, highest first, ties to the smaller id (no id comes last); all, if fewer.

    Every row of ``docs`` is a document, whether its id is given once, several times or
    not at all; a null text has no terms.  Rows of one item id are one item; an item
    without an id or without terms gives no rows, as does an empty table.  A term counts
    once in an item.  Other columns are not read, whatever their names."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").alias("text")) \
        .where("item IS NOT NULL")
    item_type, id_type = asked.schema["item"].dataType, rows.schema["id"].dataType

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t.as_py()))) for t in batch.column(1)]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array([w for f in found for w in f], pa.string())], names=["item", "term"])

    pairs = materialize(asked.mapInArrow(split, f"item {item_type.simpleString()}, term string").distinct())
    blocks = max(1, math.ceil(pairs.count() / block_words))
    found = None
    for block in range(blocks):
        # about ``block_words`` pairs (more only where one item alone has more)
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow().combine_chunks()
        if not len(own):
            continue
        names, place = np.unique(own.column("term").to_numpy(zero_copy_only=False), return_inverse=True)
        ids = own.column("item").combine_chunks()
        groups = ids.dictionary_encode()
        at = groups.indices.to_numpy()
        order = np.argsort(at, kind="stable")
        terms = np.split(place[order].astype(np.int32), np.cumsum(np.bincount(at, minlength=len(groups.dictionary)))[:-1])
        postings = materialize(read_postings(rows, {w: i for i, w in enumerate(names)}))
        count = postings.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("total")).head()
        if not count["total"]:
            continue
        holding = np.zeros(len(names), np.int64)
        for r in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            holding[r["term"]] = r["count"]
        weights = np.array([weight(count["documents"], int(h)) if h else 0 for h in holding], np.int64)
        task = search_task(groups.dictionary.to_pylist(), terms, weights, count["documents"], count["total"], k, shard,
                           to_arrow_type(id_type), to_arrow_type(item_type))
        best = postings.where(F.size("terms") > 0).mapInArrow(
            task, f"item {item_type.simpleString()}, id {id_type.simpleString()}, score long")
        found = best if found is None else found.union(best)
    if found is None:
        found = rows.select(F.lit(None).cast(item_type).alias("item"), "id", F.lit(0).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
