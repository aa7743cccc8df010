import random
import zlib
from collections import Counter

import pytest

from chainsight.llm import queries, sharding
from tests.conftest import SF001, SF01
from .messy import ROWS, empty, messy


def check_shards(rows, shards, tolerance=0.001):
    """Slots are gapless, and each boundary lies as near its target as rows allow."""
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    total, largest, under = sum(r.size for r in rows), max((r.size for r in rows), default=0), 0
    for s in range(shards - 1):
        under += sum(r.size for r in by.get(s, []))
        assert abs(under - total * (s + 1) / shards) <= max(tolerance * total / shards, largest / 2)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op5_byte_sharding(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        data = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
    check_shards([type("R", (), {"shard": r.shard, "slot": r.slot, "size": r["size"]}) for r in rows], 16)


def plain_splitters(keys, shards):
    """The bytes below each boundary, taken from sorted rows."""
    keys = sorted(keys)
    total, out, under, n = sum(s for _, s in keys), [], 0, 0
    sums = [0]
    for _, s in keys:
        sums.append(sums[-1] + s)
    for i in range(1, shards):
        target = total * i / shards
        out.append(min(abs(x - target) for x in sums))
    return out


@pytest.mark.parametrize("kind", ["spread", "one hot key", "all equal halves"])
def test_splitters_reach_the_nearest_row(spark, kind):
    rng = random.Random(4)
    rows = [(rng.getrandbits(64) - 2**63, rng.getrandbits(64) - 2**63, rng.randint(1, 50)) for _ in range(800)]
    if kind == "one hot key":
        rows = [(77 if i % 2 else a, b, s) for i, (a, b, s) in enumerate(rows)]
    if kind == "all equal halves":
        rows = [(5, b, s) for _, b, s in rows]
    frame = spark.createDataFrame(rows, "a long, b long, size long")
    at = sharding.splitters(frame, 8, tolerance=0.0)
    keys = [((a + 2**63) * 2**64 + b + 2**63, s) for a, b, s in rows]
    total = sum(s for _, s in keys)
    gaps = [abs(sum(s for k, s in keys if k < p) - total * (i + 1) / 8) for i, p in enumerate(at)]
    assert gaps == pytest.approx(plain_splitters(keys, 8))


def test_copies_stay_together_unless_they_must_part(spark):
    rows = [(i, f"text {i % 40} " + "x" * (i % 40), None) for i in range(400)] + [(1000, "hot " * 50, None)] * 200
    got = sharding.shard_by_bytes(messy(spark, rows), 4, tolerance=0.2).select("text", "shard", "slot", "size").collect()
    check_shards([type("R", (), {"shard": r.shard, "slot": r.slot, "size": r["size"]}) for r in got], 4, 0.2)
    homes = Counter(t for t, _ in {(r.text, r.shard) for r in got})
    assert sum(n > 1 for n in homes.values()) <= 3


def test_messy_rows(spark):
    docs = messy(spark)
    got = sharding.shard_by_bytes(docs, 3)
    assert sorted(got.columns) == sorted(docs.columns)      # the inputs' own size, shard and slot gave way
    assert got.schema["slot"].dataType.simpleString() == "bigint"
    rows = got.collect()
    assert len(rows) == len(ROWS)
    check_shards([type("R", (), {"shard": r.shard, "slot": r.slot, "size": r["size"]}) for r in rows], 3)
    assert sharding.shard_by_bytes(empty(spark), 3).count() == 0
    assert {r.shard for r in sharding.shard_by_bytes(docs, 1).collect()} == {0}
