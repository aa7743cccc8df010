import math
import re
from collections import Counter

import numpy as np
import pytest

from chainsight.llm import lexical, queries
from .messy import empty, messy

SF = "/root/testdata/sf0.001"


def plain(docs, items, k=50):
    """Scores of all documents, written out; docs and items: (id, text)."""
    def terms(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall("(?:[0-9A-Za-z]|[^\x00-\x7f])+", low)

    held = [(i, Counter(terms(t))) for i, t in docs]
    N = sum(1 for _, c in held if c)
    L = sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, words in asked.items():
        scored = []
        for i, c in held:
            n, score = sum(c.values()), 0
            for t in words:
                if c[t]:
                    m = 100 - 50 + (50 * n * N) // L
                    score += math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) \
                        * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,shard,block_words", [(0, 20_000, 1_000_000), (1, 3, 1_000_000), (2, 7, 5)])
def test_equals_scoring_all_documents(spark, seed, shard, block_words, monkeypatch):
    rng = np.random.default_rng(seed)
    words = ["the", "of", "Ünï", "zeta", "a1", "b", "c", "d", "e", "f", "日本", "x_y", "Q"]
    weights = 1 / np.arange(1, len(words) + 1)
    weights /= weights.sum()
    monkeypatch.setattr(lexical, "FIRST", 2)

    def text(most):
        return " ".join(rng.choice(words, rng.integers(0, most), p=weights))

    docs = [(i, text(30)) for i in range(200)]
    docs += [(500 + i, docs[i % 7][1]) for i in range(90)] + [(3, docs[3][1]), (None, docs[3][1]), (901, None), (902, "")]
    items = [(i, text(9)) for i in range(12)] + [(12, "no such"), (13, None), (14, "!?"), (None, "the"), (15, "zeta ZETA zeta")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string")
    assert rows(lexical.search(d, q, k=10, shard=shard, block_words=block_words)) == plain(docs, items, 10)


def test_shard_reads_no_more_than_needed():
    """One long list of falling impacts: the top is settled without reading it all."""
    n = 10_000
    shard = lexical.Shard(np.zeros(n, np.int32), np.arange(n), np.arange(2 * n, n, -1), n)
    read = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                read.append(key.stop - key.start)
            return super().__getitem__(key)

    shard.impact = shard.impact.view(Counting)
    docs, scores = shard.best(np.array([0]), np.array([3]), 50)
    assert docs.tolist() == list(range(50)) and scores.tolist() == [3 * (2 * n - i) for i in range(50)]
    assert sum(read) < 500


def test_query_against_all_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows(queries.op12_lexical_search(spark, SF)) == plain(docs, items)


def test_messy_rows(spark):
    items = spark.createDataFrame([(1, "the quick fox"), (1, "dog"), (2, None), (None, "the"), (3, "word end")],
                                  "item_id long, text string")
    docs = messy(spark)
    got = rows(lexical.search(docs, items))
    assert got == plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert lexical.search(empty(spark), items).count() == 0
    assert lexical.search(docs, items.where("false")).count() == 0
    assert lexical.search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]
