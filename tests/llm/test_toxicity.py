import zlib

import numpy as np

from chainsight.llm import queries, toxicity
from .messy import ROWS, empty, messy

SF1 = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    values, place = np.unique(np.asarray(score)[order], return_inverse=True)
    first = np.searchsorted(place, np.arange(len(values)))
    last = np.searchsorted(place, np.arange(len(values)), side="right")
    ranks[order] = ((first + last + 1) / 2)[place]
    label = np.asarray(label)
    pos = label.sum()
    return (ranks[label == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(label) - pos))


def test_held_out_quality(spark):
    rows = queries.op10_toxicity(spark, SF1).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF1}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF1}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert auc(*zip(*held)) > 0.98
    right = [int(s >= 0.5) == y for s, y in held]
    assert sum(right) / len(right) > 0.985
    assert np.mean([s >= 0.5 for s, y in held if y]) > 0.9 and np.mean([s < 0.5 for s, y in held if not y]) > 0.99


def test_one_insult_decides_and_long_clean_texts_stay(spark):
    docs = spark.read.parquet(f"{SF1}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SF1}/labels.parquet")
    model = toxicity.train(docs, labels)
    words = "idiot stupid moron worthless pathetic loser trash scum disgusting clown".split()
    texts = [t for w in words for t in (f"You are such a {w} and you know it.", f"in the {w} of the day")]
    texts += ["shut up, moron", "you are scum and I hate you"]
    got = toxicity.score(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    assert [r.text for r in got if r.score < 0.5] == []
    toxic = labels.groupBy("doc_id").agg({"toxic": "max"})
    clean = docs.join(toxic.where("`max(toxic)` = 0"), "doc_id")
    rows = toxicity.score(clean.where("length(text) > 5000"), model).collect()
    for lang in ("en", "de", "fr", "es"):
        scores = [r.score for r in rows if r.lang == lang]
        assert len(scores) > 10 and np.mean([s < 0.5 for s in scores]) > 0.95, lang


def plain_entries(words):
    """What a set of words is known by, as stated."""
    many = {}
    for w in words:
        for e in {"=" + w} | {"^" + w[:n] for n in range(3, 9) if n < len(w)} | {"$" + w[-n:] for n in range(3, 7) if n < len(w)}:
            many[e] = many.get(e, 0) + 1
    return set(many) | {"2" + e for e, n in many.items() if n > 1 and e.startswith("^")}


def test_lexicon_votes_and_score_against_plain_version(spark):
    rng = np.random.default_rng(5)
    syllables = ["ba", "no", "ti", "ker", "lum", "esh", "ga"]

    def text(toxic):
        words = ["".join(rng.choice(syllables, 3)) for _ in range(rng.integers(3, 30))]
        if toxic:
            words[0] = ["zorgan", "zorgig", "zorgul", "idiot"][rng.integers(4)]
        return " ".join(words)

    rows = [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 2 == 0], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    # lexicon: likelihood ratio and log-odds ratio of every entry over the labelled rows
    sample = [(plain_entries(t.split()), y) for i, t, y in rows if i % 2 == 0]
    n, total = len(sample), sum(y for _, y in sample)
    want = {}
    for e in set().union(*[s for s, _ in sample]):
        a, b = sum(y for s, y in sample if e in s), sum(1 - y for s, y in sample if e in s)
        cells = [(a, (a + b) * total / n), (b, (a + b) * (n - total) / n), (total - a, (n - a - b) * total / n),
                 (n - total - b, (n - a - b) * (n - total) / n)]
        strength = 2 * sum(x * np.log(x / m) for x, m in cells if x > 0 and m > 0)
        ratio = np.log((a + .5) / (total - a + .5)) - np.log((b + .5) / (n - total - b + .5))
        if a >= toxicity.SEEN and strength > toxicity.SURE and ratio > toxicity.RATIO:
            want[e] = ratio
    assert set(model.lexicon.names) == set(want) and "^zorg" in want and "=idiot" in want
    # votes and score of every text
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    weights, kept = model.weights.astype(float) / toxicity.SCALE, [model.lexicon.names[j] for j in model.kept]
    for i, t, _ in rows:
        held = plain_entries(t.split())
        fire = {"wit"} if "idiot" in t.split() else set()
        for p, e in enumerate(model.lexicon.names):
            if e in held and want[e] > toxicity.VOTING:
                fire.add({"=": ("words_a", "words_b")[p % 2], "^": "beginnings", "$": "endings", "2": "repeated"}[e[0]])
        x = [want[e] * (e in held) for e in kept]
        x += [odds[sum(1 << k for k, j in enumerate(c) if toxicity.VOTERS[j] in fire)] for c, odds in model.joint]
        strong = {e.lstrip("2") for e in want if want[e] > toxicity.VOTING}
        many = sum(bool(plain_entries([w]) & strong) for w in set(t.split()))
        n, (high, low) = len(set(t.split())), model.rates
        x += [np.log1p(n), min(10, max(-10, many * np.log(high / low) - (high - low) * n))]
        odds = float(np.dot(x, weights)) + model.bias
        assert abs(got[i] - 1 / (1 + np.exp(-odds))) < 1e-5
    assert np.mean([(got[i] >= 0.5) == (y == 1) for i, _, y in rows if i % 2]) > 0.97


def test_expectation_step():
    """Posteriors of two voters by Bayes' rule, written out."""
    votes, label = np.array([[0, 0], [0, 1], [1, 0], [1, 1]]), np.array([0, 1, 2, 0])
    model = toxicity.LabelModel(votes, label, np.array([40., 10., 8., 6.]))
    model.cliques, model.prior = [[0], [1]], 0.25
    model.tables = [[np.array([0.9, 0.1]), np.array([0.3, 0.7])], [np.array([0.8, 0.2]), np.array([0.4, 0.6])]]
    odds = [1 / 3 * (3 / 9) * (4 / 8), 1 / 3 * (3 / 9) * 3 * (3 / 97), 1 / 3 * 7 * (4 / 8) * (97 / 3), 1 / 3 * 7 * 3]
    assert np.allclose(model.infer(votes, label), [o / (1 + o) for o in odds])


def test_one_reading_gives_what_training_and_scoring_give(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    once = toxicity.train_and_score(docs, labels, queries.F.col("doc_id") % 3 != 0)
    apart = toxicity.score(docs, toxicity.train(docs.where("doc_id % 3 != 0"), labels))
    key = lambda r: (r.doc_id, r.score)
    assert sorted(map(key, once.collect())) == sorted(map(key, apart.collect()))


def test_label_model_recovers_voters():
    """Independent voters of known accuracy, two of them copies of one another."""
    rng = np.random.default_rng(0)
    n = 40_000
    y = rng.random(n) < 0.2
    fire = [(0.8, 0.05), (0.6, 0.02), (0.7, 0.1), (0.5, 0.01)]
    votes = np.stack([rng.random(n) < np.where(y, a, b) for a, b in fire], axis=1).astype(int)
    votes = np.concatenate((votes, votes[:, 2:3]), axis=1)  # the fifth repeats the third
    label = np.where(rng.random(n) < 0.1, np.where(y, 2, 1), 0)
    code = votes @ (1 << np.arange(5)) * 3 + label
    every, first, counts = np.unique(code, return_index=True, return_counts=True)
    model = toxicity.LabelModel(votes[first], label[first], counts)
    assert [2, 4] in model.cliques and sum(len(c) > 1 for c in model.cliques) == 1
    assert abs(model.prior - 0.2) < 0.02
    for clique, (clean, toxic) in zip(model.cliques, model.tables):
        if len(clique) == 1:
            a, b = fire[clique[0]]
            assert abs(toxic[1] - a) < 0.04 and abs(clean[1] - b) < 0.02
    guess = model.infer(votes, np.zeros(n, int)) > 0.5
    assert (guess == y).mean() > 0.92


def test_logistic_finds_the_features():
    rng = np.random.default_rng(1)
    x = (rng.random((3000, 6)) < 0.3).astype(np.float32)
    weights, bias = toxicity.logistic(x, 1 / (1 + np.exp(-(x @ np.array([4, -3, 0, 0, 2, 0]) - 1))))
    assert np.allclose(weights, [4, -3, 0, 0, 2, 0], atol=0.3) and abs(bias + 1) < 0.15


def test_messy_rows(spark):
    docs = messy(spark)
    labels = spark.createDataFrame([(1, 0), (1, 1), (5, 0), (7, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model)
    assert sorted(got.columns) == sorted(docs.columns)
    rows = got.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    assert toxicity.score(empty(spark), model).count() == 0
    none = toxicity.train(empty(spark), labels.where("false"))
    assert len({r.score for r in toxicity.score(docs, none).collect()}) == 1
