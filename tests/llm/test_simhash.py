import random

import pytest
import xxhash

from chainsight.llm import queries, simhash
from tests.conftest import SF001
from .messy import ROWS, empty, messy


def plain_fingerprint(text, words):
    """The definition, bit by bit."""
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    own, word = [], ""
    for c in text + " ":
        if c in "\t\n\x0b\x0c\r ":
            if word:
                own.append(word)
            word = ""
        else:
            word += c
    if not own:
        return 0
    shingles = [" ".join(own[i:i + words]) for i in range(max(1, len(own) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items, max_bits):
    """items: (id or None, fingerprint); the component's smallest id, or None, of each."""
    parent = list(range(len(items)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(items):
        if name is not None:
            least[find(i)] = min(least.get(find(i), name), name)
    return [least.get(find(i)) for i in range(len(items))]


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    items = [(r.doc_id, plain_fingerprint(r.text, 3)) for r in docs]
    want = {n: (f"{fp:016x}", c) for (n, fp), c in zip(items, plain_components(items, 3))}
    got = queries.op7_simhash_near_dedup(spark, SF001).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want
    assert len(got) == len(docs)


@pytest.mark.parametrize("max_bits", [0, 1, 3, 6])
def test_forest_joins_what_all_pairs_join(spark, monkeypatch, max_bits):
    """Random fingerprints and dense families of close ones, in nodes that are cut into chunks."""
    monkeypatch.setattr(simhash, "CHUNK", 16)
    rng = random.Random(max_bits)
    codes = {rng.getrandbits(64) for _ in range(150)}
    for _ in range(4):
        at = rng.getrandbits(64)
        for _ in range(90):
            codes.add(at)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
    center = rng.getrandbits(64)
    codes |= {center ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)}
    signed = [c - (c >> 63 << 64) for c in codes]
    frame = spark.createDataFrame([(c,) for c in signed], "code long").repartition(5)
    roots = {r.node: r.root for r in simhash.components(simhash.forest(frame, max_bits)).collect()}
    want = plain_components([(c, c & 2**64 - 1) for c in signed], max_bits)
    assert [roots.get(c, c) for c in signed] == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7), (5, 6), (6, 5)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(101, 161)} | {i: 1000 for i in range(1001, 1200)} | {6: 5}
    assert got == want
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_messy_rows(spark):
    got = sorted(tuple(map(str, r)) for r in simhash.near_duplicates(messy(spark)).collect())
    items = [(i, plain_fingerprint(t, 3)) for i, t, _ in ROWS]
    want = sorted((str(i), str(fp - (fp >> 63 << 64)), str(c))
                  for (i, fp), c in zip(items, plain_components(items, 3)))
    assert got == want
    kept = simhash.drop_near_duplicates(messy(spark))
    assert kept.columns == messy(spark).columns
    assert len(kept.collect()) == len({fp for _, fp, _ in want})  # no two of these fingerprints are linked
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


def test_one_component_of_null_ids(spark):
    rows = [(None, "a b c d e", None), (None, "a b c d e", None), (3, "x y z", None)]
    got = simhash.near_duplicates(messy(spark, rows)).select("doc_id", "component").collect()
    assert sorted(map(str, got)) == sorted(map(str, [(None, None), (None, None), (3, 3)])) or \
        sorted((r.doc_id or 0, r.component or 0) for r in got) == [(0, 0), (0, 0), (3, 3)]
    assert simhash.drop_near_duplicates(messy(spark, rows)).count() == 2
