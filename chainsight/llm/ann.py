"""Nearest neighbours by a block matrix join over int8 tiles.

Queries go to the tasks in blocks of at most ``BLOCK_BYTES``; every task
multiplies them with tiles of its candidates.  A tile holds int8 roundings of
the vectors, so its product is exact integer arithmetic (in float32, which
BLAS multiplies fast and which holds such sums exactly for ``SEGMENT``
dimensions at a time).  With q = q' + dq and v = v' + dv, rounded vectors primed,

    |q.v - q'.v'|  <=  |q| |dv| + |dq| |v'|

bounds what rounding can change.  For this the vectors are scaled by powers of two,
so that no norm overflows or vanishes; pairs whose products may overflow are always
recomputed.  A candidate whose upper bound lies under the
lower bounds of ``k`` others can't be among the k nearest; all others are
recomputed in double precision from the original vectors and merged into one
heap of k for each query and task.  Spark merges the heaps.  The result is
exact: the quantisation only decides what needs no recomputation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

K = 20
TILE = 2048                     # candidates of a tile
QUERIES = 512                   # queries multiplied with a tile at once
BLOCK_BYTES = 16 * 2**20        # vectors of a block of queries
SEGMENT = 1024                  # 127 * 127 * 1024 < 2 ** 24: exact in float32


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors of a list column without nulls as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", rows, rows)) * (1 + 1e-12)


class Rounded:
    """int8 rounding of vectors, held in float32, with what the error bound needs."""

    def __init__(self, rows: np.ndarray):
        # of each row the power of two that brings its largest component under 1
        self.power = np.frexp(np.abs(rows).max(axis=1))[1].astype(np.int64)
        rows = np.ldexp(rows, -self.power[:, None])
        self.scale = np.abs(rows).max(axis=1) / 127
        whole = np.rint(rows / self.scale[:, None])
        self.whole = whole.astype(np.float32)
        back = whole * self.scale[:, None]
        self.norm, self.near, self.error = norms(rows), norms(back), norms(rows - back)


def tile_bounds(q: Rounded, v: Rounded) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of q's rows and v's rows."""
    dot = sum(q.whole[:, s:s + SEGMENT].astype(np.float32) @ v.whole[:, s:s + SEGMENT].T
              for s in range(0, q.whole.shape[1], SEGMENT))
    about = dot.astype(np.float64) * q.scale[:, None] * v.scale[None, :]
    slack = q.norm[:, None] * v.error + q.error[:, None] * v.near
    slack += 1e-12 * q.norm[:, None] * v.norm  # rounding of the doubles themselves
    power = q.power[:, None] + v.power
    least = 2 * q.whole.shape[1] * np.finfo(np.float64).smallest_subnormal  # products that vanish
    with np.errstate(over="ignore", under="ignore"):
        low, high = (np.ldexp(x, np.clip(power, -4000, 4000).astype(np.int32)) for x in (about - slack, about + slack))
    large = power > 960
    return np.where(large, -np.inf, low - least), np.where(large, np.inf, high + least)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, added up in the order of the components."""
    total = np.zeros(len(a))
    with np.errstate(all="ignore"):
        for j in range(a.shape[1]):
            total += a[:, j] * b[:, j]
    return total


class Heaps:
    """The k best (score, id) of each query: largest score, ties to the smaller id.  Sums of
    opposite infinities, which are no numbers, count as the largest, as Spark orders them."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.full = np.zeros((queries, k), bool)
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def worst(self, rows: slice) -> np.ndarray:
        """Score from which on a candidate may enter: of the last of ``k``, if there are so many."""
        score = self.score[rows, -1]
        return np.where(self.full[rows, -1], np.where(np.isnan(score), np.inf, score), -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched, query = np.unique(query, return_inverse=True)
        all_q = np.concatenate((np.repeat(np.arange(len(touched)), self.k), query))
        all_s = np.concatenate((self.score[touched].ravel(), score))
        all_i = np.concatenate((self.id[touched].ravel(), ids))
        full = np.concatenate((self.full[touched].ravel(), np.ones(len(ids), bool)))
        order = np.lexsort((all_i, -all_s, ~np.isnan(all_s), ~full, all_q))
        all_q, all_s, all_i, full = all_q[order], all_s[order], all_i[order], full[order]
        first = np.searchsorted(all_q, np.arange(len(touched)))
        best = first[:, None] + np.arange(self.k)
        self.score[touched], self.id[touched], self.full[touched] = all_s[best], all_i[best], full[best]


def search_task(ids: np.ndarray, vectors: np.ndarray, k: int):
    """mapInArrow function: candidates (id, vector) -> the task's k best of each query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounded = [Rounded(vectors[at:at + QUERIES]) for at in range(0, len(ids), QUERIES)]
        heaps = Heaps(len(ids), k)
        for batch in batches:
            every, rows = batch.column(0).to_numpy(), matrix(batch.column(1), vectors.shape[1])
            for at in range(0, len(every), TILE):
                own, tile = every[at:at + TILE], rows[at:at + TILE]
                small = Rounded(tile)
                for n, q in enumerate(rounded):
                    block = slice(n * QUERIES, min((n + 1) * QUERIES, len(ids)))
                    low, high = tile_bounds(q, small)
                    self_pair = ids[block, None] == own[None, :]
                    low[self_pair] = -np.inf
                    need = heaps.worst(block)
                    if len(own) >= k:
                        need = np.maximum(need, np.partition(low, len(own) - k, axis=1)[:, len(own) - k])
                    query, cand = np.nonzero((high >= need[:, None]) & ~self_pair)
                    if len(query):
                        heaps.add(block.start + query, inner(vectors[block][query], tile[cand]), own[cand])
        query, place = np.nonzero(heaps.full)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[query]), pa.array(heaps.id[query, place]), pa.array(heaps.score[query, place])],
            names=["query_id", "vec_id", "score"])
    return run


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, ``id_col``, score): for each query the ``k`` rows of largest inner
    product, nearest first, ties to the smaller id; all candidates, if fewer.

    ``is_query`` says which rows are queries; candidates are all rows but those with
    the query's own id.  Vectors that are null, empty, zero or hold a null or
    non-finite component take no part, nor do rows without an id.  A query id given
    several times is one query (the smallest of its vectors); a candidate id given
    several times is as many candidates.  Vectors of another length than the
    query's are no candidates of it.  Scores that overflow are infinite.  An empty table gives no rows.  Other columns
    are not read."""
    spark = vectors.sparkSession
    rows = vectors.where(is_query.isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
        is_query.alias("q")).where(F.col("id").isNotNull() & usable(F.col("v")))
    queries = materialize(rows.where("q").groupBy("id").agg(F.min("v").alias("v"))
                          .withColumn("size", F.size("v")).withColumn("part", F.xxhash64("id")))
    found = None
    for size, many in sorted(map(tuple, queries.groupBy("size").count().collect())):
        blocks = max(1, math.ceil(many * size * 8 / block_bytes))
        for block in range(blocks):
            some = queries.where((F.col("size") == size) & (F.pmod("part", F.lit(blocks)) == block)) \
                .select("id", "v").toArrow().combine_chunks()
            ids = some.column(0).to_numpy()
            if not len(ids):
                continue
            own = matrix(some.column(1).chunk(0), size)
            best = rows.where(F.size("v") == size).select("id", "v").mapInArrow(
                search_task(ids, own, k), f"query_id long, vec_id long, score double")
            best = best if blocks == 1 else materialize(best)
            found = best if found is None else found.union(best)
    if found is None:
        found = spark.createDataFrame([], "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
