"""Toxicity by weak supervision.

1. A bounded sample of labelled rows (``LABELLED`` of them, in hash order) yields
   the lexicon: words, beginnings and endings of words, and beginnings that two or
   more words of a text share, which go with the label (a likelihood-ratio test over
   counts that Spark adds up).
2. Every text is read once: the lexicon's entries that it holds, and the votes of
   fixed lexicons, learned lexicons and patterns.  Each voter fires or doesn't.
3. A generative label model over the counts of vote patterns (all documents;
   the label of a sampled row is one more voter) estimates by
   expectation-maximisation how often each voter is right.  Unlabelled documents
   weigh together as their share of labelled ones, so that they can't carry the
   classes away from the labels.  Voters whose votes remain dependent given the
   class form cliques, whose joint votes are one table, so that correlated voters
   don't count twice.
4. A linear classifier (logistic regression) over lexicon entries, the cliques' joint
   votes and numbers of words is trained on the model's posteriors over the sample.  A held-back quarter of it chooses the penalty and sets slope
   and bias, so that a score of 0.5 means even odds.

Texts aren't shuffled.  What reaches the driver is the lexicon (``FEATURES`` entries),
the sample's entries, and the counts of at most ``3 * 2 ** len(VOTERS)`` vote patterns.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

LABELLED = 12_000       # labelled rows that lexicon and classifier are fitted on
FEATURES = 1_000        # entries of the lexicon at most, the strongest by the test
BEGINNINGS = range(3, 9)
ENDINGS = range(3, 7)
SEEN, SURE, RATIO = 4, 20.0, 1.5  # of an entry: toxic documents, likelihood ratio, log-odds ratio
VOTING = 2.5            # log-odds ratio of the entries that vote
KNOWN = 300_000         # words whose entries a task remembers
TALLY = 300_000         # counts that a task holds before it hands them on
LABEL_ACCURACY = 0.97   # of a given label, as a voter
ITERATIONS = 30
DEPENDENT = 0.01        # nats of mutual information given the class, to be in one clique
PRIOR_COUNT = 20.0      # documents that all unlabelled ones count as when dependence is judged
CLIQUE = 4              # voters of a clique at most
PENALTIES = (0.03, 0.3, 3.0)
SCALE = 4.0             # of the classifier's inputs
FOLDS = 4               # one of them is held back

#: Common English insults by what they target (fixed values).
LEXICONS = {
    "wit": "idiot idiots idiotic stupid moron moronic dumb dumbass imbecile cretin fool brainless halfwit dimwit",
    "worth": "worthless useless pathetic loser losers trash garbage scum failure nobody vermin",
    "disgust": "disgusting vile filthy filth gross repulsive revolting nasty creep pig",
    "contempt": "clown clowns joke coward liar hypocrite freak weirdo bastard jerk hate shut",
}
VOTERS = (*LEXICONS, "words_a", "words_b", "beginnings", "endings", "repeated", "shouting", "address")

WORD = re.compile(r"[^\W\d_]+")
ADDRESS = re.compile(r"\b(?:you|your|you're|u)\W+(?:\w+\W+){0,3}(?:%s)\b"
                     % "|".join(w for group in LEXICONS.values() for w in group.split()))
SETS = [frozenset(group.split()) for group in LEXICONS.values()]


def entries(word: str) -> tuple[str, ...]:
    """What a word may be known by: itself (``=``), its beginnings (``^``) and endings (``$``)."""
    return ("=" + word, *["^" + word[:n] for n in BEGINNINGS if n < len(word)],
            *["$" + word[-n:] for n in ENDINGS if n < len(word)])


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def repeated(many: Counter) -> list[str]:
    """Beginnings that two or more words share, marked ``2``."""
    return ["2" + e for e, n in many.items() if n > 1 and e[0] == "^"]


# --------------------------------------------------------------------------
# Learning

class LabelModel:
    """Class-conditional tables of voter cliques, fitted by expectation-maximisation.

    ``votes``: one row per pattern, 0 or 1 for each voter; ``label``: 0 none, 1 clean,
    2 toxic; ``counts``: documents of each pattern."""

    def __init__(self, votes: np.ndarray, label: np.ndarray, counts: np.ndarray):
        labelled = counts[label > 0].sum()
        counts = np.where(label > 0, counts, counts * (labelled + 1) / (counts.sum() + 1))
        self.cliques = [[j] for j in range(votes.shape[1])]
        self.prior = 0.1
        start = np.where(label == 2, 0.95, np.where(label == 1, 0.03, np.where(votes.sum(axis=1) > 1, 0.8, 0.05)))
        self.posterior = start
        for step in range(2):
            for _ in range(ITERATIONS):
                self.fit(votes, counts)
                self.posterior = self.infer(votes, label)
            if not step:
                self.cliques = self.dependent(votes, label, counts)

    @staticmethod
    def code(votes: np.ndarray, clique: list[int]) -> np.ndarray:
        return votes[:, clique] @ (1 << np.arange(len(clique)))

    def fit(self, votes, counts) -> None:
        toxic, clean = counts * self.posterior, counts * (1 - self.posterior)
        self.prior = (toxic.sum() + 1) / (counts.sum() + 10)
        self.tables = []
        for clique in self.cliques:
            code, size = self.code(votes, clique), 1 << len(clique)
            self.tables.append([(np.bincount(code, w, size) + 0.1) / (w.sum() + 0.1 * size) for w in (clean, toxic)])

    def infer(self, votes, label) -> np.ndarray:
        odds = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for clique, (clean, toxic) in zip(self.cliques, self.tables):
            code = self.code(votes, clique)
            odds += np.log(toxic[code] / clean[code])
        sure = np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
        odds += np.where(label == 2, sure, np.where(label == 1, -sure, 0.0))
        return 1 / (1 + np.exp(-odds))

    def dependent(self, votes, label, counts) -> list[list[int]]:
        """Voters joined greedily by their mutual information given the class.

        A given label counts as the class, as far as it is right.  The other documents,
        for which the posterior stands, count together as ``PRIOR_COUNT`` more: voters
        that repeat one another pull the posterior after them, and look independent
        given that."""
        known = counts * (label > 0)
        other = counts - known
        counts = known + other * (PRIOR_COUNT / max(1e-9, other.sum()))
        share = np.where(label == 2, LABEL_ACCURACY, np.where(label == 1, 1 - LABEL_ACCURACY, self.posterior))
        toxic, clean = counts * share, counts * (1 - share)
        both = max(1e-9, toxic.sum() + clean.sum())
        pairs = []
        for i in range(votes.shape[1]):
            for j in range(i):
                total = 0.0
                for w in (toxic, clean):
                    joint = np.bincount(votes[:, i] * 2 + votes[:, j], w, 4).reshape(2, 2) + 1e-9
                    joint /= joint.sum()
                    apart = joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True)
                    total += w.sum() / both * float((joint * np.log(joint / apart)).sum())
                pairs.append((total, j, i))
        home = {j: [j] for j in range(votes.shape[1])}
        for strength, i, j in sorted(pairs, reverse=True):
            if strength < DEPENDENT:
                break
            a, b = home[i], home[j]
            if a is not b and len(a) + len(b) <= CLIQUE:
                merged = sorted(a + b)
                for v in merged:
                    home[v] = merged
        return [list(c) for c in sorted({tuple(c) for c in home.values()})]


def logistic(x: np.ndarray, target: np.ndarray, rounds: int = 500, decay: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge-penalised logistic regression on soft targets, by
    accelerated gradient descent (``x``: one row per document)."""
    n = max(1, len(target))
    weights, bias = np.zeros(x.shape[1], np.float32), float(np.log((target.sum() + 1) / (n - target.sum() + 1)))
    # the curvature is at most a quarter of the mean squared norm of a row
    step = 1.0 / (0.25 * (float((x * x).sum()) / n + 1) + decay / n)
    v, vb = weights.copy(), bias
    for t in range(rounds):
        error = (1 / (1 + np.exp(-(x @ v + vb))) - target).astype(np.float32)
        new, nb = v - step * (x.T @ error / n + decay / n * v), vb - step * float(error.sum()) / n
        m = t / (t + 3)
        v, vb = new + m * (new - weights), nb + m * (nb - bias)
        weights, bias = new.astype(np.float32), nb
    return weights, bias


def loss(odds: np.ndarray, target: np.ndarray) -> float:
    return float((np.logaddexp(0, odds) - target * odds).sum())


def calibrate(odds: np.ndarray, target: np.ndarray, hold: float = 5.0) -> tuple[float, float]:
    """Slope and shift of the odds that fit the target, held near 1 and 0 by a penalty
    (Newton's method, a step being halved until it helps)."""
    at, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    x = np.stack([odds, np.ones(len(odds))], axis=1)

    def cost(at):
        return loss(x @ at, target) + hold / 2 * float(((at - start) ** 2).sum())

    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -60, 60)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold * np.eye(2),
                               x.T @ (p - target) + hold * (at - start))
        while np.abs(step).max() > 1e-9 and not cost(at - step) <= cost(at):
            step = step / 2
        at = at - step
    return float(at[0]), float(at[1])


# --------------------------------------------------------------------------
# Reading texts

class Lexicon:
    """Learned entries with their log-odds ratios; reads texts into evidence."""

    def __init__(self, learned: list[tuple[str, float]]):
        learned = sorted(learned)
        self.names = [e for e, _ in learned]
        self.place = {e: i for i, e in enumerate(self.names)}
        self.tracked = {e.lstrip("2") for e in self.names}
        self.strong = {e.lstrip("2") for e, ratio in learned if ratio > VOTING}
        self.ratios = np.array([ratio for _, ratio in learned], np.float32)
        self.flags = np.zeros(len(learned), np.int64)
        for i, (e, ratio) in enumerate(learned):
            if ratio > VOTING:
                voter = {"=": ("words_a", "words_b")[i % 2], "^": "beginnings", "$": "endings", "2": "repeated"}[e[0]]
                self.flags[i] = 1 << VOTERS.index(voter)

    def read(self, text: str | None, known: dict[str, tuple[str, ...]]) -> tuple[int, list[int], int, int]:
        """Votes (one bit a voter), places of the entries held, number of distinct words,
        and of those that hold an entry which votes."""
        text = text or ""
        low = text.lower()
        words = set(WORD.findall(low))
        if len(known) > KNOWN:
            known.clear()
        for w in words.difference(known):
            known[w] = tuple(e for e in entries(w) if e in self.tracked)
        many = Counter(chain.from_iterable(map(known.__getitem__, words)))
        found = [p for e in chain(many, repeated(many)) if (p := self.place.get(e)) is not None]
        votes = sum(1 << i for i, s in enumerate(SETS) if not s.isdisjoint(words))
        if votes and ADDRESS.search(low):
            votes |= 1 << VOTERS.index("address")
        if words and text.upper() == text:
            votes |= 1 << VOTERS.index("shouting")
        for p in found:
            votes |= int(self.flags[p])
        strong = sum(not self.strong.isdisjoint(e) for e in map(known.__getitem__, words) if e)
        return votes, sorted(found), len(words), strong


EVIDENCE = "struct<votes:int,found:array<int>,words:int,strong:int>"
EVIDENCE_ARROW = pa.struct([("votes", pa.int32()), ("found", pa.list_(pa.int32())), ("words", pa.int32()),
                            ("strong", pa.int32())])


def evidence_column(text: Column, lexicon: Lexicon) -> Column:
    """Votes, lexicon entries and number of words of a text."""
    @F.arrow_udf(EVIDENCE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, tuple[str, ...]] = {}
        for texts in batches:
            rows = [lexicon.read(t.as_py(), known) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(EVIDENCE_ARROW)], fields=list(EVIDENCE_ARROW))
    return run(text)


def sample_labels(labels: DataFrame, id_col: str, label_col: str, labelled: int) -> DataFrame:
    return materialize(
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("toxic"))
        .where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.avg("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id").limit(labelled))


def learn_lexicon(rows: DataFrame, sample: DataFrame) -> Lexicon:
    """Entries that speak for the label, from ``rows`` (id, text) that ``sample`` labels."""
    def tally(batches):
        known: dict[str, tuple[str, ...]] = {}
        seen, toxic = Counter(), Counter()

        def hand_on():
            names = list(seen)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[e] for e in names], pa.int64()),
                 pa.array([float(toxic[e]) for e in names], pa.float64())], names=["entry", "seen", "toxic"])

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                words = words_of(text.as_py())
                if len(known) > KNOWN:
                    known.clear()
                for w in words.difference(known):
                    known[w] = entries(w)
                many = Counter(chain.from_iterable(map(known.__getitem__, words)))
                held = [*many, *repeated(many), ""]  # the empty entry counts the documents
                seen.update(held)
                if label:
                    for e in held:
                        toxic[e] += label
            if len(seen) > TALLY:
                yield hand_on()
                seen, toxic = Counter(), Counter()
        if seen:
            yield hand_on()

    # at most ``labelled`` ids: a bounded sample may be sent whole
    counts = materialize(
        rows.join(F.broadcast(sample), "id").select("text", "toxic")
        .mapInArrow(tally, "entry string, seen long, toxic double")
        .groupBy("entry").agg(F.sum("seen").cast("double").alias("n"), F.sum("toxic").alias("t"))
        .where((F.col("t") >= SEEN) | (F.col("entry") == "")))
    total = counts.where("entry = ''").head()
    if total is None:
        return Lexicon([])
    n, t = F.col("n"), F.col("t")
    every, toxic = F.lit(float(total["n"])), F.lit(float(total["t"]))

    def part(cell: Column, expected: Column) -> Column:
        return F.when((cell > 0) & (expected > 0), cell * F.log(cell / expected)).otherwise(0.0)

    strength = 2 * (part(t, n * toxic / every) + part(n - t, n * (every - toxic) / every)
                    + part(toxic - t, (every - n) * toxic / every)
                    + part(every - toxic - n + t, (every - n) * (every - toxic) / every))
    ratio = F.log((t + 0.5) / (toxic - t + 0.5)) - F.log((n - t + 0.5) / (every - toxic - n + t + 0.5))
    best = counts.where("entry <> ''").select("entry", strength.alias("strength"), ratio.alias("ratio")) \
        .where((F.col("strength") > SURE) & (F.col("ratio") > RATIO)) \
        .orderBy(F.desc("strength"), F.desc(F.length("entry")), "entry").limit(FEATURES).collect()
    return Lexicon([(r["entry"], r["ratio"]) for r in best])


# --------------------------------------------------------------------------
# Operator

class Model:
    """Lexicon, label model and classifier.

    The classifier's inputs are the lexicon entries (each with its log-odds ratio as its
    value, so that a penalty shrinks strong entries less), the log-odds that the label
    model gives to the joint votes of each clique, the number of words, and the log-odds
    of the number of words that hold an entry which votes, at the rates that toxic and
    clean texts of the sample have (in a long text a few do by chance)."""

    def __init__(self, lexicon: Lexicon, labels: LabelModel):
        self.lexicon, self.prior = lexicon, labels.prior
        self.cliques = [[VOTERS[j] for j in c] for c in labels.cliques]
        # of each clique the voters' places and the log-odds of their votes over those of none
        self.joint = [(c, np.log(toxic / clean) - np.log(toxic[0] / clean[0]))
                      for c, (clean, toxic) in zip(labels.cliques, labels.tables)]
        self.kept, self.rates = np.arange(len(lexicon.names)), (0.01, 0.01)  # toxic, clean
        self.weights, self.bias = np.zeros(0, np.float32), float(np.log(self.prior / (1 - self.prior)))

    def by_votes(self) -> np.ndarray:
        """For every vote pattern (row) the log-odds of each clique's votes."""
        bits = (np.arange(1 << len(VOTERS))[:, None] >> np.arange(len(VOTERS))) & 1
        return np.stack([odds[LabelModel.code(bits, c)] for c, odds in self.joint], axis=1).astype(np.float32)

    def surprise(self, words: np.ndarray, strong: np.ndarray) -> np.ndarray:
        toxic, clean = self.rates
        return np.clip(strong * np.log(toxic / clean) - (toxic - clean) * words, -10, 10)

    def design(self, votes: np.ndarray, found: list, words: np.ndarray, strong: np.ndarray) -> np.ndarray:
        """Inputs of the classifier, one row per document."""
        place = np.full(len(self.lexicon.names), -1)
        place[self.kept] = np.arange(len(self.kept))
        held = np.zeros((len(votes), len(self.kept)), np.float32)
        for i, f in enumerate(found):
            at = place[f]
            held[i, at[at >= 0]] = 1
        return np.concatenate([held * self.lexicon.ratios[self.kept], self.by_votes()[votes],
                               np.log1p(words)[:, None], self.surprise(words, strong)[:, None]], axis=1).astype(np.float32) / SCALE

    def fit(self, votes, found, words, strong, posterior, label, fold) -> None:
        every = np.zeros((len(votes), len(self.lexicon.names)), bool)
        for i, f in enumerate(found):
            every[i, f] = True
        # of entries that the same documents hold, the longest stays
        longest: dict[bytes, int] = {}
        for j in sorted(self.kept, key=lambda j: (-len(self.lexicon.names[j]), j)):
            longest.setdefault(np.packbits(every[:, j]).tobytes(), j)
        self.kept = np.sort(np.fromiter(longest.values(), np.int64, len(longest)))
        toxic, clean = ((p @ strong + 0.5) / (p @ words + 100) for p in (posterior, 1 - posterior))
        self.rates = float(max(toxic, clean)), float(clean)
        x = self.design(votes, found, words, strong)
        if not len(x):
            self.weights = np.zeros(x.shape[1], np.float32)
            return
        inside, outside = fold > 0, fold == 0

        def trial(decay):
            weights, bias = logistic(x[inside], posterior[inside], 300, decay)
            odds = x[outside] @ weights + bias
            return loss(odds, label[outside]), decay, odds

        _, decay, odds = min((trial(d) for d in PENALTIES), key=lambda found: found[0])
        slope, shift = calibrate(odds.astype(float), label[outside])
        slope = max(slope, 0.1)
        weights, bias = logistic(x, posterior, 300, decay)
        self.weights, self.bias = (weights * slope).astype(np.float32), bias * slope + shift

    def score(self, votes: np.ndarray, found: pa.Array, words: np.ndarray, strong: np.ndarray) -> np.ndarray:
        a, b = len(self.kept), len(self.weights) - 2
        entry = np.zeros(len(self.lexicon.names) + 1)
        entry[self.kept] = self.weights[:a] * self.lexicon.ratios[self.kept] / SCALE
        sums = np.concatenate(([0.0], np.cumsum(entry[found.values.to_numpy()]) if len(found.values) else []))
        offsets = found.offsets.to_numpy()
        odds = sums[offsets[1:]] - sums[offsets[:-1]] + (self.by_votes() @ self.weights[a:b] / SCALE)[votes] \
            + (self.weights[b] * np.log1p(words) + self.weights[b + 1] * self.surprise(words, strong)) / SCALE + self.bias
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def fit(evidence: DataFrame, sample: DataFrame, lexicon: Lexicon) -> Model:
    """Label model and classifier from ``evidence`` (id, evidence) of all documents."""
    label = F.when(F.col("toxic") >= 0.5, 2).when(F.col("toxic").isNotNull(), 1).otherwise(0)
    patterns = evidence.select("id", F.col("evidence.votes").alias("votes")) \
        .join(F.broadcast(sample), "id", "left").groupBy("votes", label.alias("label")).count().collect()
    table = np.array([[r["votes"], r["label"], r["count"]] for r in patterns], np.int64).reshape(-1, 3)

    def spread(votes: np.ndarray) -> np.ndarray:
        return (votes[:, None] >> np.arange(len(VOTERS))) & 1

    labels = LabelModel(spread(table[:, 0]), table[:, 1], table[:, 2].astype(float))
    got = evidence.join(F.broadcast(sample), "id") \
        .select("evidence.*", "toxic", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FOLDS)).alias("fold")).toArrow().combine_chunks()
    target, votes = got.column("toxic").to_numpy(), got.column("votes").to_numpy().astype(np.int64)
    found = [np.asarray(x.values.to_numpy(), np.int64) for x in got.column("found")]
    posterior = labels.infer(spread(votes), np.where(target >= 0.5, 2, 1))
    model = Model(lexicon, labels)
    model.fit(votes, found, got.column("words").to_numpy(), got.column("strong").to_numpy(), posterior, target, got.column("fold").to_numpy())
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", labelled: int = LABELLED) -> Model:
    """Fit on ``docs``, of which ``labels`` labels some.

    At most ``labelled`` labelled ids, the first in hash order, are used; of several
    labels of one id the mean counts.  Null ids, null labels and labels of no
    document are none; without any label every score is the prior."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    sample = sample_labels(labels, id_col, label_col, labelled)
    lexicon = learn_lexicon(rows, sample)
    return fit(materialize(rows.select("id", evidence_column(F.col("text"), lexicon).alias("evidence"))), sample, lexicon)


def score_column(evidence: Column, model: Model) -> Column:
    """Probability (0 to 1) that a text is toxic, from its evidence."""
    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            votes, found, words, strong = batch.flatten()
            yield pa.array(model.score(votes.to_numpy(False).astype(np.int64), found, words.to_numpy(False), strong.to_numpy(False)))
    return run(evidence)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if the score is 0.5 or more).

    Null and empty texts get the score of no evidence; repeated rows and null ids
    stay; an empty table stays empty.  Columns of the input that bear one of the new
    names give way; all others stay, whatever their names."""
    return _scored(docs, score_column(evidence_column(F.col(f"`{text_col}`"), model.lexicon), model))


def _scored(docs: DataFrame, value: Column) -> DataFrame:
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]
    return docs.select(*kept, value.alias("score")) \
        .select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def train_and_score(docs: DataFrame, labels: DataFrame, training: Column, label_col: str = "toxic",
                    labelled: int = LABELLED) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of all ``docs`` (doc_id, text) by a model
    that is trained on those where ``training`` (a condition on doc_id) holds.

    As ``score(docs, train(docs.where(training), labels))``, but every text is read
    once for training and scoring: their evidence is kept."""
    rows = docs.select(F.col("doc_id").alias("id"), "text", training.alias("training"))
    sample = sample_labels(labels, "doc_id", label_col, labelled)
    lexicon = learn_lexicon(rows.where("training").select("id", "text"), sample)
    seen = materialize(rows.select("id", "training", evidence_column(F.col("text"), lexicon).alias("evidence")))
    model = fit(seen.where("training").select("id", "evidence"), sample, lexicon)
    return _scored(seen.select(F.col("id").alias("doc_id"), "evidence"), score_column(F.col("evidence"), model)) \
        .drop("evidence")
