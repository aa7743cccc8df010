import re
from collections import Counter

import pytest

from chainsight.llm import decontaminate, queries
from tests.conftest import SF001
from .messy import empty, messy


def plain_leaks(docs, items):
    """Every window of every item's size, compared exactly."""
    def words_of(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    def shingles(words, k):
        return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]
    out = {}
    known = [(name, words_of(text)) for name, text in items]
    for doc, text in docs:
        words = words_of(text)
        for name, item in known:
            if not item or not words:
                continue
            k = min(5, len(item))
            want = Counter(shingles(item, k))
            if not set(want) & set(shingles(words, k)):
                continue
            n = min(len(item), len(words))
            best = None
            for at in range(len(words) - n + 1):
                own = Counter(shingles(words[at:at + n], k))
                every = sum((own | want).values())
                score = sum((own & want).values()) / every if every else 0.0
                if score >= 0.8 and (best is None or score > best[0]):
                    best = (score, at, n)
            if best:
                out[doc, name] = best
    return out


def found(frame):
    return {(r[0], r[1]): (r.similarity, r.start_word, r.n_words) for r in frame.collect()}


def test_query_against_all_windows(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = found(queries.op1_decontamination(spark, SF001))
    assert got and got == plain_leaks(docs, items)


def test_changed_windows(spark):
    item = " ".join(f"w{i}" for i in range(50))
    words = item.split()
    docs = [(1, "before " + item + " after"), (2, item.upper().replace(" ", ", ")),
            (3, " ".join(words[:25] + ["other"] + words[26:])),              # one word in the middle: 41 of 51
            (4, " ".join(words[:10] + ["x"] + words[11:40] + ["y"] + words[41:])),
            (5, " ".join(words[3:])), (6, " ".join(words[:20])), (7, " ".join(words[::-1])),
            (8, " ".join(["filler"] * 3000 + words + ["filler"] * 3000 + words[:48])),
            (9, " ".join(words[:20] + ["new"] + words[20:]))]
    items = [(10, item), (11, "w1 w2 w3"), (12, "solo"), (13, ""), (14, None), (15, "a a a a a a a a a"), (16, item)]
    docs += [(20, "w1 w2 w3"), (21, "w3 solo w1"), (22, "a a a a a a a a a a b"), (23, "a a a a a a a"), (24, "w1 w2")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = plain_leaks(docs, items)
    assert {(1, 10), (2, 10), (3, 10), (20, 11), (22, 15), (1, 16)} <= set(want)
    assert found(decontaminate.find_leaks(d, b)) == want
    assert {r.doc_id for r in decontaminate.drop_leaks(d, b).collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_benchmark_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"x one{i} two{i} three{i} four{i} five{i} six{i} y") for i in range(9)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(i, f"one{i} two{i} three{i} four{i} five{i} six{i}") for i in range(0, 9, 2)],
                                  "item_id long, text string")
    monkeypatch.setattr(decontaminate.item_blocks, "__defaults__", (7,))
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}
    assert got == {(i, i) for i in range(0, 9, 2)}
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()) == [1, 3, 5, 7]


def test_repeated_shingles(spark):
    """Long repeats on one side or on both turn the shingle vectors far apart."""
    def run(name, n):
        return " ".join(f"{name}{i}" for i in range(n))
    items = [(1, run("w", 899) + " pad" * 109), (2, run("v", 1008)), (3, run("u", 400) + " pad" * 60)]
    docs = [(1, run("w", 899) + " " + run("other", 109)), (2, run("v", 899) + " pad" * 109),
            (3, "before " + run("u", 400) + " pad" * 60 + " after"), (4, " ".join(["pad"] * 3000)),
            (5, run("v", 500) + " pad" * 508), (6, run("w", 899) + " fill" * 109)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = plain_leaks(docs, items)
    assert {(1, 1), (2, 2), (3, 3), (6, 1)} == set(want)
    assert found(decontaminate.find_leaks(d, b)) == want


def test_messy_rows(spark):
    items = spark.createDataFrame([("fox", "The quick brown fox jumps over the lazy dog"), ("none", None), (None, "one")],
                                  "item_id string, text string")
    got = sorted((r.doc_id or 0, r.item_id or "") for r in decontaminate.find_leaks(messy(spark), items).collect())
    assert got == [(0, "fox"), (1, "fox"), (1, "fox"), (8, "")]
    left = decontaminate.drop_leaks(messy(spark), items)
    assert left.columns == messy(spark).columns and left.count() == messy(spark).count() - 4
    assert decontaminate.find_leaks(empty(spark), items).count() == 0
    assert decontaminate.find_leaks(messy(spark), items.where("false")).count() == 0
    assert decontaminate.drop_leaks(messy(spark), items.where("false")).count() == messy(spark).count()
