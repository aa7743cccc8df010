import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from chainsight.llm import packing, queries
from tests.conftest import SF001
from .messy import ROWS, empty, messy


def tokenizer():
    return Tokenizer.from_str(packing.tokenizer_text())


def check_places(rows, capacity):
    """rows: (sequence, offset, length); every sequence is gapless and within capacity."""
    by = {}
    for s, o, n in rows:
        by.setdefault(s, []).append((o, n))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def test_query_against_tokenizer(spark):
    t = tokenizer()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = queries.op8_best_fit_packing(spark, SF001).collect()
    want = {}
    for name, text in docs.items():
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            want[name, n] = (at, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    used = check_places([(r.sequence_id, r.offset, r.length) for r in rows], 4096)
    lengths = [n for _, n, _ in want.values()]
    assert used <= packing.lower_bound(Counter(lengths), 4096) + 1


def test_encoder_equals_tokenizer():
    t, e = tokenizer(), packing.Encoder(packing.tokenizer_text())
    rng = random.Random(1)
    parts = ["the", "The", "THE,", "end.", "it's", "I'LL", "don't", "Été", "ΣΑΣ", "ς", "İ", "é", "́", "ﬁ", "😀",
             "a1b2", "3.14", "x-y", "<|endoftext|>", "<|startoftext|>x", "...", ",", "\x1c", "a\x1fb", " ", " ",
             "\x85", "​", "word.\n", "日本語", "a,b", "Mr.", "'s", "﻿", "\x00"]
    for _ in range(400):
        text = "".join(rng.choice(parts) + rng.choice(["", " ", "  ", "\n", "\t"]) for _ in range(rng.randint(0, 12)))
        assert e.encode(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_encoder_on_letters_whose_lower_case_is_longer():
    t, e = tokenizer(), packing.Encoder(packing.tokenizer_text())
    rng = random.Random(2)
    odd = [chr(c) for c in range(0x80, 0x3000) if chr(c).isalpha() and chr(c).lower() != chr(c)]
    odd = [c for c in odd if len(c.lower()) > 1 or not c.lower().isalpha()] + rng.sample(odd, 60) + list("İẞǅΣaZ")
    for text in ["İ,", "Aİ.", "TÜRKİ, ve", *("".join(rng.choices(odd + [",", ".", " "], k=rng.randint(1, 8))) for _ in range(4000))]:
        assert e.encode(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def fewest(lengths, capacity):
    """Exact optimum by trying all assignments."""
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for b in sorted(set(range(len(bins))), key=lambda b: bins[b]):
            if bins[b] + lengths[i] <= capacity:
                go(i + 1, bins[:b] + [bins[b] + lengths[i]] + bins[b + 1:])
        go(i + 1, bins + [lengths[i]])
    go(0, [])
    return best


def test_bound_and_best_fit_on_small_cases():
    rng = random.Random(5)
    for _ in range(150):
        capacity = rng.choice([10, 12, 30])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        place, offset, fill = packing.best_fit_decreasing(np.array(lengths), capacity)
        assert check_places(zip(place.tolist(), offset.tolist(), lengths), capacity) == len(fill)
        optimum = fewest(sorted(lengths, reverse=True), capacity)
        assert packing.lower_bound(Counter(lengths), capacity) <= optimum <= len(fill)
    assert packing.lower_bound({}, 10) == 0
    assert packing.lower_bound({6: 5}, 10) == 5          # more than half each
    assert packing.lower_bound({4: 6}, 10) == 3          # two fit


@pytest.mark.parametrize("kind", ["even", "large", "thirds"])
def test_pack_over_many_tasks(spark, kind):
    rng = random.Random(2)
    size = {"even": lambda: rng.randint(1, 1000), "large": lambda: rng.randint(400, 1000),
            "thirds": lambda: rng.choice([330, 340, 500, 501])}[kind]
    rows = [(i, size()) for i in range(3000)]
    frame = spark.createDataFrame(rows, "key long, length long")
    got = {r.key: (r.sequence, r.offset) for r in packing.pack(frame, 1000, per_task=300).collect()}
    assert len(got) == len(rows)
    used = check_places([(*got[k], n) for k, n in rows], 1000)
    bound = packing.lower_bound(Counter(n for _, n in rows), 1000)
    apart = sum(len(packing.best_fit_decreasing(np.array([n for k, n in rows[i::10]]), 1000)[2]) for i in range(10))
    assert used <= apart
    assert used <= 1.02 * bound
    alone = {r.key: r.sequence for r in packing.pack(frame, 1000).collect()}
    assert len(set(alone.values())) == len(packing.best_fit_decreasing(np.array([n for _, n in rows]), 1000)[2])


def test_rounds_go_on_while_they_save(spark, monkeypatch):
    """A packer that joins one pair a round: twelve halves' pairs need as many rounds."""
    def one_pair(capacity, turn):
        def run(batches):
            import pyarrow as pa
            keys = [k for b in batches for k in b.column(0).to_pylist()]
            if not keys:
                return
            n = len(keys)
            place = [max(0, i - 1) for i in range(n)]
            none = pa.nulls(n, pa.int64())
            names = ["key", "length", "sequence", "offset", "released", "bins", "released_bins", "bound"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([5] * n, pa.int64()),
                 pa.array([(turn << 48) + p for p in place], pa.int64()),
                 pa.array([5 if i == 1 else 0 for i in range(n)], pa.int64()),
                 pa.array([p > 0 for p in place]), none, none, none], names=names)
            none = pa.nulls(1, pa.int64())
            one = [pa.array([x], pa.int64()) for x in (n - 1, n - 2, n // 2)]
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array([False]), *one], names=names)
        return run
    monkeypatch.setattr(packing, "pack_task", one_pair)
    frame = spark.createDataFrame([(i, 5) for i in range(24)], "key long, length long")
    got = packing.pack(frame, 10).collect()
    assert sorted(r.key for r in got) == list(range(24))
    assert check_places([(r.sequence, r.offset, 5) for r in got], 10) == 12


def test_messy_rows(spark):
    docs = messy(spark)
    rows = packing.pack_documents(docs, capacity=64, with_ids=True)
    got = rows.collect()
    check_places([(r.sequence_id, r.offset, r.length) for r in got], 64)
    assert sum(r.length for r in got if r.doc_id in (2, 3, 4)) == 3          # the end id alone
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    t = tokenizer()
    total = sum(len(t.encode(text or "", add_special_tokens=False).ids) + 1 for _, text, _ in ROWS)
    assert sum(r.length for r in got) == total
    joined = {r.sequence_id: r.ids for r in packing.sequences(rows).collect()}
    assert all(joined[r.sequence_id][r.offset:r.offset + r.length] == r.ids for r in got)
    assert packing.pack_documents(empty(spark)).count() == 0


def test_round_trip(spark):
    """Pieces put together again are the documents' ids."""
    rows = packing.pack_documents(messy(spark).where("doc_id >= 5"), capacity=50, with_ids=True).collect()
    t = tokenizer()
    for name, text, _ in ROWS:
        if name is not None and name >= 5:
            parts = sorted((r.piece, r.ids) for r in rows if r.doc_id == name)
            assert list(itertools.chain(*(p for _, p in parts))) == t.encode(text, add_special_tokens=False).ids + [1]
