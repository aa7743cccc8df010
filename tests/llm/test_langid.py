from collections import Counter

import pytest

from chainsight.llm import langid, queries
from tests.conftest import SF001, SF01
from .messy import ROWS, empty, messy


def plain_ngrams(text):
    words, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            words.append(word)
            word = ""
    if not words:
        return Counter()
    padded = "\x01" + "\x01".join(words) + "\x01"
    return Counter(padded[i:i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1) if padded[i:i + n] != "\x01")


def code(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def plain_rank(counts, size):
    return [code(g) for g in sorted(counts, key=lambda g: (-counts[g], code(g)))][:size]


def plain_predict(text, profiles, size):
    own = plain_rank(plain_ngrams(text), size)
    if not own:
        return "und", 0.0
    apart = {lang: sum(abs(ranks[g] - i) if g in ranks else size for i, g in enumerate(own))
             for lang, ranks in profiles.items()}
    best = min(sorted(apart), key=apart.get)
    return best, 1 - apart[best] / (size * len(own))


def test_query_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    import zlib
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in docs}
    counts = {}
    for r in docs:
        if not held[r.doc_id] and r.lang is not None:
            counts.setdefault(r.lang, Counter()).update(plain_ngrams(r.text))
    profiles = {lang: {g: i for i, g in enumerate(plain_rank(c, langid.SIZE))} for lang, c in counts.items()}
    got = {r.doc_id: r for r in queries.op2_language_id(spark, SF001).collect()}
    assert len(got) == len(docs)
    for r in docs:
        lang, score = plain_predict(r.text, profiles, langid.SIZE)
        g = got[r.doc_id]
        assert (g.lang_pred, g.held_out) == (lang, held[r.doc_id]) and g.score == pytest.approx(score, abs=1e-12)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    got = queries.op2_language_id(spark, SF01).where("held_out").join(docs, "doc_id")
    assert got.where("lang = lang_pred").count() / got.count() > 0.97


def test_counts_reported_in_parts(spark, monkeypatch):
    whole = langid.profiles(messy(spark))
    monkeypatch.setattr(langid, "HELD", 3)
    assert langid.profiles(messy(spark)) == whole


def test_messy_rows(spark):
    docs = messy(spark)
    model = langid.profiles(docs)
    assert set(model) == {"en", "de"}  # the others' texts are null, empty or hold no letter
    got = langid.identify(docs, model)
    assert sorted(got.columns) == sorted(docs.columns)
    rows = got.collect()
    assert len(rows) == len(ROWS)
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 7)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows)
    assert langid.identify(empty(spark), model).count() == 0
    none = langid.profiles(empty(spark))
    assert none == {} and {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError):
        langid.profiles(messy(spark))


def test_strange_languages_go_and_others_stay(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = langid.profiles(docs)
    stay = {"one": 1, "Qx": 2, "Привет мир": 3, "Le 12 mai": 4, "A1 " * 50 + "token": 5}
    go = {"Привет мир это обычный русский текст о погоде и городе": 6, "这是一个中文文本，" * 8: 7,
          "zxqj wvkp qqzx jjkw xvzq pkqz wwjx qzvk jxqp zkvw xxqj kzpw": 8, "12 34 !": 9, "": 10}
    rows = [(n, text, None) for text, n in {**stay, **go}.items()] + [(None, None, None), (1, "one", None)]
    made = messy(spark, rows)
    kept = langid.drop_unknown(made, model)
    assert kept.columns == made.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1, 2, 3, 4, 5]
    assert langid.drop_unknown(empty(spark), model).count() == 0 == langid.drop_unknown(made, {}).count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("run(text") == 1  # classified once


def test_every_labelled_document_stays(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("text RLIKE '\\\\p{L}'")
    assert langid.drop_unknown(docs, langid.profiles(docs)).count() == docs.count()
