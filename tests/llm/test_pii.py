import hashlib
import re

import pytest
from pyspark.sql import functions as F

from chainsight.llm import pii, queries
from tests.conftest import SF001
from .messy import ROWS, empty, messy


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def plain_base(text):
    """The four base kinds as stated."""
    text = text or ""
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            found = m.group()
            digits = re.sub("[^0-9]", "", found)
            if kind == "ip" and any(int(p) > 255 for p in found.split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


TEXTS = [
    "mail a.b+c@mail-x.example.co.uk, x@y, @z.com, a@b..c a@b.c%d@e.f 😀 é@e.org",
    "ip 1.2.3.4 999.1.1.1 255.255.255.255.255 01.002.0003.4 1.2.3 10.0.0.1.2.3.4.5 0.0.0.256 v1.2.3.4x",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 378282246310005 4111  1111 12 0000000000000",
    "+1 (017) 555-7713 +49.30.1234567- +1 +12 34 +123456789012345678 ++44 20 7946 0958 +1 555 (",
    "SSN 123-45-6789 iban DE89370400440532013000 GB82WEST12345698765433 (555) 123-4567 555.123.4567",
    "bob [at] example [dot] com Dr. Ada Lovelace", "@" * 500, "a" * 60_000 + " 1" * 30_000 + "@b.c",
    "1" * 50_000, "a@" + "b." * 20_000 + "c", "+" + "1 " * 3000, None, "", " ", "+1" + " " * 5000 + "x",
    "4111111111111111@host.com +14111111111111111 1.1.1.1@a.b",
]


def test_query_against_stated_patterns(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = queries.op4_personal_data(spark, SF001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_base(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in base) for n in pii.BASE]
        assert r.base_sha256 == digest(base)
        assert [s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE] == [f"{k}:{s}:{e}" for k, s, e in base]


def test_base_spans_of_odd_texts(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_personal_data(frame).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        assert [(s.kind, s.start, s.end) for s in got[i] if s.kind in pii.BASE] == plain_base(text), text and text[:60]
        order = [(pii.KINDS.index(s.kind), s.start) for s in got[i]]
        assert order == sorted(order)


def test_no_python_in_the_plan(spark):
    plan = pii.find_personal_data(messy(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_checksums(spark):
    rows = [("DE89370400440532013000", "4111111111111111"), ("DE89370400440532013001", "4111111111111112"),
            ("GB82WEST12345698765432", "378282246310005")]
    got = spark.createDataFrame(rows, "i string, c string").select(pii.mod97(F.col("i")), pii.luhn(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, False), (True, True)]


def test_label_model_learns_reliabilities():
    """Two good labelers and a useless one: the posterior follows the good ones."""
    def code(shape, gaz, check, cue, edge):
        return sum(v * 3 ** i for i, v in enumerate((shape, gaz, check, cue, edge)))
    counts = {}
    for shape, gaz, n in ((1, 1, 400), (2, 2, 400), (1, 2, 10), (2, 1, 10)):
        for cue in (1, 2):
            counts["ssn", code(shape, gaz, 0, cue, 1)] = n
    truth = pii.posteriors(counts)
    for cue in (1, 2):
        assert truth["ssn", code(1, 1, 0, cue, 1)] > 0.9
        assert truth["ssn", code(2, 2, 0, cue, 1)] < 0.1
    weights = pii.classifier(counts, truth)
    assert weights["shape", 1] > 0 > weights["shape", 2] and abs(weights["cue", 1] - weights["cue", 2]) < 0.5
    assert pii.posteriors({}) == {} and pii.classifier({}, {}) == {}


def test_classifier_keeps_and_drops_added_spans(spark):
    good = [(i, f"my social security number is {200 + i}-45-6789 ok") for i in range(40)]
    bad = [(100 + i, f"order version 000-00-{1000 + i} 666-00-0000") for i in range(40)]
    frame = spark.createDataFrame(good + bad, "doc_id long, text string")
    got = {r.doc_id: [s.kind for s in r.spans] for r in pii.find_personal_data(frame).collect()}
    assert all(got[i] == ["ssn"] for i, _ in good) and all("ssn" not in got[i] for i, _ in bad)


def test_messy_rows(spark):
    got = pii.find_personal_data(messy(spark))
    assert got.count() == len(ROWS)
    assert pii.find_personal_data(empty(spark)).count() == 0
