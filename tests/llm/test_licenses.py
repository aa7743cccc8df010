import math
import re
import textwrap

import numpy as np

from chainsight.llm import licenses, queries
from tests.conftest import SF001, SF01
from .messy import ROWS, empty, messy

#: How the test documents write the families.
LINES = {"MIT": "MIT License", "Apache-2.0": "Apache License, Version 2.0", "CC-BY-NC-4.0": "CC BY-NC 4.0",
         "GPL-3.0": "GNU General Public License, version 3", "proprietary": "All rights reserved."}


def test_query_finds_the_written_licences(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = queries.op6_license_scan(spark, SF01).collect()
    assert len(rows) == len(docs)
    seen = 0
    for r in rows:
        text = docs[r.doc_id] or ""
        want = sorted(f for f, phrase in LINES.items() if re.search(re.escape(phrase), text, re.I))
        if re.search("[*%$&#!|]{2}| \\| ", text):
            continue  # junk signs between the words of a line
        assert r.families.split(",") == (want or [""])
        seen += len(want)
    assert seen > 10


def test_variants_and_strangers():
    scanner = licenses.Scanner([f"some plain text number {i} of the corpus in the house".split() for i in range(200)])

    def family(line):
        got = scanner.line(licenses.words_of(line))
        return got and got[0]
    assert family("released under the mit license") == "MIT"
    assert family("This code is licensed under the Apache License, Version 2.0!") == "Apache-2.0"
    assert family("You can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation, either version 3 of the License") == "GPL-3.0"
    assert family("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License") \
        == "CC-BY-NC-4.0"
    for line in ("of the", "in the house", "", "the terms of the deal", "I was granted a free license to drive"):
        assert family(line) is None


def test_places(spark):
    text = "😀 first\nReleased under the MIT License.\n\nlast"
    scanner = licenses.Scanner([["some", "text"]])
    (found,) = scanner.scan(text)
    assert text[found["start"]:found["end"]] == "Released under the MIT License." and found["paragraph"] == 1
    assert scanner.scan(None) == scanner.scan("") == []


def test_messy_rows(spark):
    docs = messy(spark)
    scanner = licenses.train(docs)
    assert licenses.scan_licences(docs, scanner).count() == len(ROWS)
    assert licenses.scan_licences(empty(spark), licenses.train(empty(spark))).count() == 0


def test_query_finds_all_rights_reserved(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = queries.op6_license_scan(spark, SF01).collect()
    want = {d for d, text in docs.items() if "All rights reserved." in text.split("\n")}
    assert want and {r.doc_id for r in rows if "proprietary" in r.families.split(",")} == want


def test_all_rights_reserved_whatever_the_corpus():
    for others in (["text"], ["the"], [f"word{i}" for i in range(50)], "all of the rights of the house".split()):
        scanner = licenses.Scanner([[*others, "in", "the", f"number{i}"] for i in range(200)])
        found = scanner.line(licenses.words_of("All rights reserved."))
        assert found and found[0] == "proprietary" and found[1] > 0.9
        assert scanner.line(licenses.words_of("In. The.")) is None


def test_wrapped_notices_are_one_paragraph():
    scanner = licenses.Scanner([f"some plain text number {i} of the corpus in the house".split() for i in range(200)])
    before, after = "The first line of a file in the house.\n\n", "\n\nThe text of the program goes on here.\nLast line."
    for family, texts in licenses.TEMPLATES.items():
        for notice in texts:
            for width, lead in ((30, "# "), (50, " * "), (72, "")):
                wrapped = "\n".join(lead + x for x in textwrap.wrap(notice, width, break_long_words=False))
                text = before + wrapped + after
                (found,) = scanner.scan(text)
                assert text[found["start"]:found["end"]] == wrapped and found["family"] == family, wrapped
                assert found["paragraph"] == 2


def test_notices_on_lines_of_their_own_stay_apart():
    scanner = licenses.Scanner([["some", "text"]])
    text = "Released under the MIT License.\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.\n" \
           "All rights reserved.\nand so on"
    assert [(x["paragraph"], x["family"]) for x in scanner.scan(text)] == \
        [(0, "MIT"), (1, "MIT"), (2, "CC-BY-NC-4.0"), (3, "proprietary")]


def plain_line(scanner, text):
    """Features, softmax and template comparison written out, with the fitted weights."""
    words = re.findall(r"[^\W_]+", text.lower())
    templates = [(f, re.findall(r"[^\W_]+", t.lower())) for f, texts in licenses.TEMPLATES.items() for t in texts]
    pairs = [(f, {(a, b) for a, b in zip(w, w[1:])}) for f, w in templates]
    families = {}
    for f, own in pairs:
        for p in own:
            families.setdefault(p, set()).add(f)
    mine = {(a, b) for a, b in zip(words, words[1:])}
    if not mine & set(families):
        return None
    known = {w for _, ws in templates for w in ws}
    scores = []
    for k in range(len(licenses.FAMILIES)):
        score = scanner.weights[-1][k] + 4 * sum(w not in known for w in words) / len(words) * scanner.weights[-2][k]
        for f in (set(words) & known) | (mine & set(families)):
            score += scanner.weights[scanner.numbers[f]][k]
        scores.append(score / scanner.temperature)
    top = max(scores)
    shares = [math.exp(s - top) for s in scores]
    best = max(range(len(scores)), key=lambda k: scores[k])
    family, probability = licenses.FAMILIES[best], shares[best] / sum(shares)
    if family == licenses.UNKNOWN or probability < licenses.PROBABILITY:
        return None

    def worth(p):
        return 1 / len(families[p]) if p in families else 1.0
    like = max(sum(map(worth, mine & own)) / min(sum(map(worth, mine)), sum(map(worth, own)))
               for f, own in pairs if f == family)
    return (family, probability, like) if like >= licenses.SIMILARITY else None


def test_lines_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    scanner = licenses.train(docs)
    lines = {line for r in docs.collect() for line in (r.text or "").split("\n") if len(line) < 2000}
    for texts in licenses.TEMPLATES.values():
        for t in texts:
            lines |= {t, t[: len(t) // 2], t + " and some more words of the house", t.replace("the", "a"), "see: " + t.upper()}
    found = 0
    for line in sorted(lines):
        got, want = scanner.line(licenses.words_of(line)), plain_line(scanner, line)
        assert (got is None) == (want is None), line
        if got:
            assert got[0] == want[0] and abs(got[1] - want[1]) < 1e-9 and abs(got[2] - want[2]) < 1e-9, line
            found += 1
    assert found > 60


def test_softmax_fit_is_stationary():
    """The gradient of the class-weighted, penalised loss vanishes at the fitted weights."""
    rng = np.random.default_rng(0)
    x, y = (rng.random((300, 12)) < 0.4).astype(float), rng.integers(0, len(licenses.FAMILIES), 300)
    weights = licenses.Scanner.fit(x, y, rounds=3000, decay=1e-2)
    z = x @ weights
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    share = 1 / np.bincount(y, minlength=len(licenses.FAMILIES))[y] / len(licenses.FAMILIES)
    assert np.abs(x.T @ ((p - np.eye(len(licenses.FAMILIES))[y]) * share[:, None]) + 1e-2 * weights).max() < 1e-4


def test_last_line_that_repeats_words_belongs_to_the_notice():
    """The pairs of "the Software" stand earlier in this notice; its last word is alone on a line."""
    scanner = licenses.Scanner([f"some plain text number {i} of the corpus in the house".split() for i in range(200)])
    notice = next(t for t in licenses.TEMPLATES["MIT"] if t.startswith("Permission"))
    head, last = notice.rsplit(" ", 1)
    for wrapped in (textwrap.fill(head, 78) + "\n" + last, textwrap.fill(head, 40) + "\n# " + last.upper()):
        text = f"A text.\n\n{wrapped}\n\nsoftware and other words"
        (found,) = scanner.scan(text)
        assert text[found["start"]:found["end"]] == wrapped and found["family"] == "MIT"
