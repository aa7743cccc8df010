"""Personal data by weak-supervision aggregation, in DataFrame functions only.

1. Candidate spans of each kind come from regular expressions with their places
   in the text (``split`` gives what lies between the matches that
   ``regexp_extract_all`` returns; their lengths add up to the places).
2. Labelers vote on every candidate: shape (regex), gazetteers, checksums, cue
   words before it, and what touches it.  A vote is for, against, or none.
3. Candidates are counted by kind and votes.  Expectation-maximisation over
   these counts estimates each labeler's reliability (how often it votes either
   way on true and on false candidates) and each kind's share of true ones.
4. A logistic regression on kind and votes is trained on the posteriors and
   decides, as a column expression, which candidates are kept.  Candidates of the
   base kinds are personal data by definition and are always kept.

Only the counts, at most ``3 ** len(LABELERS)`` for each kind, reach the driver.
The texts are read once; the candidates are written to the shared folder.

The patterns start at the beginning of a run, use possessive quantifiers where no
match can need backtracking, and repeat only groups of one character (a sign
counts if a look ahead finds what must follow it), which Java matches in a loop:
very long runs cost linear time and no stack.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

BASE = ("email", "ip", "card", "phone")
ADDED = ("ssn", "iban", "tel", "mail_at", "name")
KINDS = BASE + ADDED
LABELERS = ("shape", "gazetteer", "checksum", "cue", "edge")
WINDOW = 32             # characters before a candidate that hold cue words
USUAL_LENGTH = 254      # longer candidates look like none of their kind
ITERATIONS = 40

#: Java patterns of the candidates.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])"
             r"(?:(?!\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:(?![\x20-](?![0-9]))[0-9\x20-])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![0-9A-Za-z])",
    "tel": r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])",
    "mail_at": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}+"
               r"(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{1,63}+){1,10}+",
    "name": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame)\.?\x20\p{Lu}\p{L}{1,30}+"
            r"(?:\x20\p{Lu}\p{L}{1,30}+)?",
}
#: What a text must hold for a kind to occur in it.
NEEDS = {"email": "@", "phone": "+", "mail_at": "at"}

OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: Gazetteers and shapes: patterns on the candidate's text (fixed values).
TOP_DOMAINS = r"(?i)\.(?:com|org|net|edu|gov|int|info|biz|io|co|de|fr|es|uk|us|eu|it|nl|ch|at|ca|au|jp|cn|in|br)$"
PRIVATE_NET = r"^(?:0|10|127|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168|22[4-9]|2[3-5][0-9])\."
CARD_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35|30[0-5]|36|38)"
COUNTRY_CODES = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
IBAN_LANDS = r"^(?:AD|AT|BE|BG|CH|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IT|LI|LT|LU|LV|MC|MT|NL|NO|PL|PT|RO|SE|SI|SK|SM)"
CUES = {
    "email": "mail|contact|kontakt|correo|courriel|write|to:|from:",
    "ip": r"\bip\b|host|server|address|adresse|login|from",
    "card": "card|visa|master|amex|karte|carte|tarjeta|pay",
    "phone": "phone|tel|call|mobile|fax|handy|anruf|m.vil",
    "ssn": "ssn|social|security",
    "iban": "iban|konto|account|bank|compte|cuenta",
    "tel": "phone|tel|call|mobile|fax",
    "mail_at": "mail|contact|write",
    "name": "name|dear|from|by|regards",
}
AGAINST_CUES = r"version|\bv\.?\s*$|section|chapter|isbn|order|invoice|build|release|figure|table"


def matches(text: Column, pattern: str) -> Column:
    """array<struct(start, end, found)> of all matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    parts = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda gap, m: F.struct(
        F.length(gap).alias("gap"), F.length(m).alias("size"), m.alias("found")))
    kind = "array<struct<start:int,end:int,found:string>>"
    placed = F.aggregate(
        parts, F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")),
        lambda s, p: F.struct(
            (s["at"] + p["gap"] + p["size"]).alias("at"),
            F.concat(s["out"], F.array(F.struct(
                (s["at"] + p["gap"]).alias("start"), (s["at"] + p["gap"] + p["size"]).alias("end"),
                p["found"].alias("found")))).alias("out")),
        lambda s: s["out"])
    return F.when(F.size(found) > 0, placed).otherwise(F.array().cast(kind))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    size = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, size - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.transform(F.sequence(F.lit(0), size - 1), worth), F.lit(0), lambda s, x: s + x) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an IBAN passes its check: letters count 10 to 35, the first four last."""
    turned = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, F.lit(1), F.lit(4)))

    def step(s: Column, i: Column) -> Column:
        n = F.conv(F.substring(turned, i, F.lit(1)), 36, 10).cast("int")
        return F.when(n < 10, s * 10 + n).otherwise(s * 100 + n) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, found: Column) -> Column:
    """What a match must satisfy beyond its pattern."""
    n = F.length(digits_of(found))
    if kind == "ip":
        return found.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":  # the Luhn test is only computed for numbers of that length
        return F.when(n.between(13, 19), luhn(digits_of(found))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def candidates(text: Column, kind: str) -> Column:
    """array<struct(kind, start, end, votes)> of a kind's candidates; a vote of each
    labeler is 1 for, 2 against, 0 none, and ``votes`` holds them base 3."""
    spans = F.filter(matches(text, PATTERNS[kind]), lambda m: valid(kind, m["found"]))
    if kind in NEEDS:
        spans = F.when(F.contains(text, F.lit(NEEDS[kind])), spans)

    def labeled(m: Column) -> Column:
        found = m["found"]
        start = F.greatest(m["start"] - WINDOW, F.lit(0))
        before = F.lower(F.substring(text, start + 1, m["start"] - start))
        after = F.substring(text, m["end"] + 1, F.lit(1))
        votes = [
            shape(kind, found), gazetteer(kind, found), checksum(kind, found),
            F.when(before.rlike(CUES[kind]), 1).when(before.rlike(AGAINST_CUES), 2).otherwise(0),
            F.when(after.rlike(r"[\p{L}\p{N}_]") | before.rlike(r"[\p{L}\p{N}_]$"), 2).otherwise(1)]
        code = sum((v * 3 ** i for i, v in enumerate(votes)), F.lit(0))
        return F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
                        code.alias("votes"))
    return F.transform(spans, labeled)


def shape(kind: str, found: Column) -> Column:
    """Whether the candidate looks as most of its kind do."""
    usual = {
        "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9]+(?:[-.][A-Za-z0-9]+)*\.[A-Za-z]{2,}$",
        "ip": r"^(?:0|[1-9][0-9]*)(?:\.(?:0|[1-9][0-9]*)){3}$",
        "card": r"^[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$",
        "phone": r"^\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\))?[ .-]?[0-9]+(?:[ .-][0-9]+)*$",
        "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
        "iban": r"^[A-Z]{2}[0-9]{2}[A-Z0-9]*[0-9]{4}$",
        "tel": r"^\(?[2-9]",
        "mail_at": r"[\[(]at[\])].*[\[(]dot[\])]",
        "name": r"\p{Lu}\p{L}+\x20\p{Lu}\p{L}+$",
    }[kind]
    return F.when(F.length(found) > USUAL_LENGTH, 2).when(found.rlike(usual), 1).otherwise(2)


def gazetteer(kind: str, found: Column) -> Column:
    known = {"email": TOP_DOMAINS, "card": CARD_ISSUERS, "phone": COUNTRY_CODES, "iban": IBAN_LANDS,
             "mail_at": r"(?i)(?:com|org|net|edu|de|fr|es|uk)$"}.get(kind)
    if kind == "ip":
        return F.when(found.rlike(PRIVATE_NET), 2).otherwise(1)
    return F.lit(0) if known is None else F.when(found.rlike(known), 1).otherwise(2)


def checksum(kind: str, found: Column) -> Column:
    if kind == "card":
        return F.lit(1)  # no candidate without it
    return F.when(mod97(found), 1).otherwise(2) if kind == "iban" else F.lit(0)


# --------------------------------------------------------------------------
# Label model and classifier, over counts of (kind, votes)

def unpack(code: int) -> tuple[int, ...]:
    return tuple(code // 3 ** i % 3 for i in range(len(LABELERS)))


def posteriors(counts: dict[tuple[str, int], int]) -> dict[tuple[str, int], float]:
    """Probability that a candidate with these votes is true, by expectation-
    maximisation; starts from a majority vote.

    A labeler's reliability is shared by all kinds, and smoothed; the share of
    true candidates belongs to a kind."""
    votes = {key: unpack(key[1]) for key in counts}
    truth = {key: (1 + sum(x == 1 for x in v)) / (2 + sum(x > 0 for x in v)) for key, v in votes.items()}
    for _ in range(ITERATIONS):
        share: dict[str, list[float]] = {}
        table = [[[1.0, 2.0, 0.5], [1.0, 0.5, 2.0]] for _ in LABELERS]  # true and false: none, for, against
        for key, n in counts.items():
            own = share.setdefault(key[0], [1.0, 1.0])
            for side, weight in ((0, n * truth[key]), (1, n * (1 - truth[key]))):
                own[side] += weight
                for j, x in enumerate(votes[key]):
                    table[j][side][x] += weight
        for key, v in votes.items():
            odds = math.log(share[key[0]][0] / share[key[0]][1])
            for j, x in enumerate(v):
                if x:
                    odds += math.log(table[j][0][x] / sum(table[j][0][1:])) - math.log(table[j][1][x] / sum(table[j][1][1:]))
            truth[key] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return truth


def classifier(counts: dict[tuple[str, int], int], truth: dict[tuple[str, int], float],
               rounds: int = 300) -> dict[tuple, float]:
    """Weights of ("bias",), ("kind", k) and (labeler, vote) of a logistic regression
    on posteriors, by gradient ascent with a step for each weight (a common kind
    doesn't slow a rare one down)."""
    weights: dict[tuple, float] = {}
    inputs = {key: [("bias",), ("kind", key[0])] + [(name, x) for name, x in zip(LABELERS, unpack(key[1])) if x]
              for key in counts}
    for _ in range(rounds):
        slope: dict[tuple, float] = {}
        curve: dict[tuple, float] = {}
        for key, n in counts.items():
            p = 1 / (1 + math.exp(-sum(weights.get(f, 0.0) for f in inputs[key])))
            for f in inputs[key]:
                slope[f] = slope.get(f, 0.0) + n * (truth[key] - p)
                curve[f] = curve.get(f, 1.0) + n * len(inputs[key]) / 4
        for f in slope:
            weights[f] = weights.get(f, 0.0) + (slope[f] - 0.1 * weights.get(f, 0.0)) / curve[f]
    return weights


def probability(span: Column, weights: dict[tuple, float]) -> Column:
    """The classifier as an expression on a candidate."""
    def choose(value: Column, options: dict) -> Column:
        out = F.lit(0.0)
        for k, w in options.items():
            out = F.when(value == k, F.lit(w)).otherwise(out)
        return out
    odds = F.lit(weights.get(("bias",), 0.0)) + choose(
        span["kind"], {f[1]: w for f, w in weights.items() if f[0] == "kind"})
    for i, name in enumerate(LABELERS):
        vote = F.floor(span["votes"] / 3 ** i) % 3
        odds = odds + choose(vote, {f[1]: w for f, w in weights.items() if f[0] == name})
    return 1 / (1 + F.exp(-odds))


# --------------------------------------------------------------------------
# Operator

def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       threshold: float = 0.5) -> DataFrame:
    """``id_col`` and ``spans`` (array of kind, start, end, probability; code points, end
    exclusive; by kind as listed, then start) of every row.

    All base candidates are kept, others from ``threshold`` on.  A null text is an
    empty one, which has no spans.  Null ids and repeated rows are kept.  An empty
    table gives no rows.  Other columns are not read."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    every = F.concat(*[F.coalesce(candidates(F.col("text"), k), F.array().cast(
        "array<struct<kind:string,start:int,end:int,votes:int>>")) for k in KINDS])
    rows = materialize(docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
                       .select("id", every.alias("found")))
    got = rows.select(F.explode("found").alias("x")).groupBy("x.kind", "x.votes").count().collect()
    counts = {(r["kind"], r["votes"]): r["count"] for r in got}
    weights = classifier(counts, posteriors(counts))
    scored = F.transform("found", lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
        probability(x, weights).alias("probability")))
    kept = F.filter(scored, lambda x: x["kind"].isin(*BASE) | (x["probability"] >= threshold))
    return rows.select(F.col("id").alias(id_col), kept.alias("spans"))
