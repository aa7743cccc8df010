"""Each stage of the pipeline against a plain version, on its predecessor's rows."""

import re
from collections import Counter

import corpus_pipeline as pipeline
from chainsight.llm import langid, packing, secret_scan
from chainsight.llm.common import materialize
from tests.conftest import SF001
from .messy import messy
from .test_decontaminate import plain_leaks
from .test_langid import plain_ngrams, plain_predict, plain_rank
from .test_packing import check_places
from .test_simhash import plain_components, plain_fingerprint


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    columns = docs.columns
    strange = docs.limit(1).withColumns({"doc_id": pipeline.F.lit(-1).cast("long"), "lang": pipeline.F.lit(None).cast("string"),
                                         "text": pipeline.F.lit("Привет мир это обычный русский текст о погоде и городе")})
    docs = docs.union(strange)
    rows = [r.asDict() for r in docs.collect()]
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF001))
        got = [r.asDict() for r in docs.collect()]
        if name == "language_id":
            counts = {}
            for r in rows:
                if r["lang"] is not None:
                    counts.setdefault(r["lang"], Counter()).update(plain_ngrams(r["text"]))
            profiles = {k: {g: i for i, g in enumerate(plain_rank(c, langid.SIZE))} for k, c in counts.items()}
            score = [plain_predict(r["text"], profiles, langid.SIZE)[1] for r in rows]
            letters = [sum(c.isalpha() for c in r["text"] or "") for r in rows]
            rows = [r for r, s, n in zip(rows, score, letters) if n and (s >= langid.LEAST or n < langid.LETTERS)]
            assert not any("Привет" in r["text"] for r in rows)
        elif name == "simhash_near_dedup":
            marks = [(r["doc_id"], plain_fingerprint(r["text"], 3)) for r in rows]
            rows = [r for r, c in zip(rows, plain_components(marks, 3)) if r["doc_id"] == c]
        elif name == "benchmark_decontamination":
            leaked = {d for d, _ in plain_leaks([(r["doc_id"], r["text"]) for r in rows], items)}
            assert leaked
            rows = [r for r in rows if r["doc_id"] not in leaked]
        elif name == "secret_scan":
            for r in rows:
                spans = secret_scan.find_secrets(r["text"])
                if spans:
                    out, at = "", 0
                    for kind, start, end in spans:
                        if start >= at:
                            out += r["text"][at:start] + f"[{kind}]"
                        at = max(at, end)
                    r["text"] = out + r["text"][at:]
                    r["n_chars"] = len(r["text"])
            assert not any(secret_scan.HEX.search(r["text"] or "") for r in rows)
        else:
            check_places([(r["sequence_id"], r["offset"], r["length"]) for r in got], packing.CAPACITY)
            assert {r["doc_id"] for r in got} == {r["doc_id"] for r in rows}
            continue
        assert docs.columns == columns
        key = lambda r: (r["doc_id"], r["text"])
        assert sorted(got, key=key) == sorted(rows, key=key)
    assert len(pipeline.STAGES) == 5 and re.fullmatch("[a-z_]+", pipeline.STAGES[0][0])


def test_run_is_the_stages(spark):
    got = pipeline.run(spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF001))
    want = pipeline.STAGES[-1][1](spark, docs, SF001)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(names).collect())) == sorted(map(tuple, want.select(names).collect()))


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("false")
    for _, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF001))
        assert docs.count() == 0


def test_stages_take_messy_rows(spark):
    """Nulls, repeated rows, long texts and columns that are named like work columns."""
    docs = messy(spark).withColumn("n_chars", pipeline.F.lit(1).cast("long"))
    secret = docs.where("doc_id = 8").withColumn("text", pipeline.F.lit("token = abcdefgh1234 end"))
    docs = docs.union(secret).union(secret.withColumn("doc_id", pipeline.F.lit(None).cast("long")))
    columns = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        before = docs.count()
        docs = materialize(stage(spark, docs, SF001))
        assert docs.columns == columns
        rows = docs.collect()
        if name == "language_id":  # null, empty and letterless texts go
            assert len(rows) == before - 5
        elif name == "simhash_near_dedup":
            assert len(rows) == len({r.text for r in rows})
        elif name == "secret_scan":
            assert len(rows) == before and [r.n_chars for r in rows if r.text == "[assign] end"] == [12]
            assert all(r.n_chars == 1 for r in rows if "[assign]" not in r.text)
    packed = pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    assert sum(r.piece == 0 for r in packed) == docs.count()
