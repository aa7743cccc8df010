import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainsight.llm import ann, queries
from tests.conftest import SF001


def plain_nearest(rows, k):
    """rows: (id, vector or None); all pairs in double precision."""
    good = [(i, v) for i, v in rows if i is not None and v and all(
        x is not None and math.isfinite(x) for x in v) and any(v)]
    out = set()
    mine = {}
    for i, v in good:
        if i % 20 == 0:
            mine[i] = min(mine.get(i, v), v)
    for q, a in mine.items():
        scored = []
        for i, v in good:
            if i != q and len(v) == len(a):
                s = 0.0
                for x, y in zip(a, v):
                    s += x * y
                scored.append((-s, i))
        for rank, (s, i) in enumerate(sorted(scored)[:k], 1):
            out.add((q, rank, i, -s))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")


def test_query_against_all_pairs(spark):
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = {tuple(r) for r in queries.op3_nearest_neighbours(spark, SF001).collect()}
    assert got == plain_nearest(rows, 20)


@pytest.mark.parametrize("block_bytes", [64, 2**24])
def test_ties_nulls_and_odd_vectors(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(ann, "TILE", 16)
    rng = random.Random(3)
    some = [[float(np.float32(rng.gauss(0, 1))) for _ in range(5)] for _ in range(12)]
    rows = [(i, some[i % 12]) for i in range(130)]                     # many ties
    rows += [(None, some[0]), (200, None), (220, []), (240, [0.0] * 5), (260, [1.0, None, 1.0, 1.0, 1.0]),
             (280, [math.nan] * 5), (300, [math.inf, 1.0, 1.0, 1.0, 1.0]), (320, [1.0, 2.0]), (321, [1.0, 2.0]),
             (40, some[5]), (41, some[3]), (41, some[3])]               # repeated ids
    rows += [(1000 + i, [1e-30 * x for x in some[i]]) for i in range(12)]
    got = [tuple(r) for r in ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, k=7,
                                         block_bytes=block_bytes).collect()]
    want = plain_nearest([(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 7)
    assert set(got) == want


@pytest.mark.parametrize("seed", [0, 1])
def test_very_large_and_very_small_vectors(spark, monkeypatch, seed):
    monkeypatch.setattr(ann, "TILE", 16)
    rng = random.Random(seed)
    rows = []
    for i in range(160):
        size = rng.choice([1e-320, 1e-200, 1e-160, 1.0, 1e100, 1e160, 1e200, 1e307])
        rows.append((i, [size * rng.choice([rng.gauss(0, 1), 0.0, 1.0]) for _ in range(4)]))
    rows += [(200, [1e160, 0.0, 0.0, 0.0]), (220, [1e200, -1e200, 0.0, 0.0])] + [(300 + i, [float(i + 1), 0.0, 0.0, 0.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, ann.nearest(df, F.col("vec_id") % 20 == 0, k=7).collect()))

    def plain():
        good = [(i, v) for i, v in rows if any(v)]
        for q, a in good:
            if q % 20 == 0:
                scored = []
                for i, v in good:
                    s = 0.0
                    for x, y in zip(a, v):
                        s += x * y
                    if i != q:
                        scored.append(((0, 0.0, i) if math.isnan(s) else (1, -s, i), s))
                for rank, ((_, _, i), s) in enumerate(sorted(scored)[:7], 1):
                    yield q, rank, i, s

    assert list(map(repr, got)) == list(map(repr, sorted(plain())))


def test_fewer_candidates_than_k_and_empty(spark):
    got = ann.nearest(frame(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0])]), F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 4.0)]
    assert ann.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for scale in (1e-3, 1.0, 1e4):
        a, b = rng.normal(0, scale, (40, 1500)), rng.standard_t(2, (60, 1500))
        low, high = ann.tile_bounds(ann.Rounded(a), ann.Rounded(b))
        exact = a @ b.T
        assert (low <= exact).all() and (exact <= high).all()
        assert (high - low).mean() < 0.2 * np.abs(np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)).mean()
