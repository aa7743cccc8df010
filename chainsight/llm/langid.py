"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams (1 to 3 letters,
words padded by a blank), most frequent first.  A document belongs to the
language whose profile has the smallest out-of-place distance to the
document's own profile: the sum, over the document's n-grams, of how far the
ranks are apart, where an n-gram that the language lacks costs ``size``.

Training counts n-grams in every text of the training rows (one pass, counts
merged by Spark) and keeps ``size`` n-grams a language; prediction is one pass
without a shuffle.  The model that tasks receive has at most
``MAX_LANGUAGES * size`` entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import beside

SIZE = 300              # n-grams of a profile
MAX_LANGUAGES = 1000    # more distinct labels than this are refused
HELD = 1_000_000        # distinct n-grams that a training task holds before it reports
UNKNOWN = "und"
LEAST = 0.25            # score below which a text is in none of the profiles' languages
LETTERS = 40            # letters that it must have to say so
BLANK = 1               # stands for what isn't a letter; NUL is no letter

_LETTERS: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    if "table" not in _LETTERS:
        _LETTERS["table"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS["table"]


def ngrams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of a text, repeats included; empty if no letter.

    Code points take 21 bits, so one to three of them fit a code exactly."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letter_table()[points]
    if not letter.any():
        return np.empty(0, np.uint64)
    points = np.concatenate(([BLANK], np.where(letter, points, BLANK), [BLANK])).astype(np.uint64)
    points = points[np.concatenate(([True], (points[1:] != BLANK) | (points[:-1] != BLANK)))]
    two = (points[:-1] << np.uint64(21)) | points[1:]
    three = (two[:-1] << np.uint64(21)) | points[2:]
    return np.concatenate((points[points != BLANK], two, three))


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first, ties to the smaller."""
    found, counts = np.unique(codes, return_counts=True)
    if len(found) > size:  # all that reach the count of the last place
        least = np.partition(counts, -size)[-size]
        found, counts = found[counts >= least], counts[counts >= least]
    return found[np.argsort(-counts, kind="stable")][:size]


def profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
             size: int = SIZE) -> dict[str, list[int]]:
    """Ranked n-grams of each language over all rows with a text and a language."""
    rows = docs.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")) \
        .where("lang IS NOT NULL AND text IS NOT NULL")

    letter_table()  # goes to the tasks as it is

    def count(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def report():
            for lang, (codes, counts) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64), pa.int64()),
                     pa.array(counts, pa.int64())],
                    names=["lang", "code", "n"])
            held.clear()

        def add(parts, lang):
            codes, counts = np.unique(np.concatenate(parts), return_counts=True)
            if lang in held:
                both = np.concatenate((held[lang][0], codes))
                weight = np.concatenate((held[lang][1], counts))
                codes, at = np.unique(both, return_inverse=True)
                counts = np.bincount(at, weight).astype(np.int64)
            held[lang] = codes, counts

        for batch in batches:
            parts: dict[str, list[np.ndarray]] = {}
            waiting: dict[str, int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes = ngrams(text.as_py())
                parts.setdefault(lang, []).append(codes)
                waiting[lang] = waiting.get(lang, 0) + len(codes)
                if waiting[lang] > 4 * HELD:
                    add(parts.pop(lang), lang)
                    waiting[lang] = 0
            for lang, some in parts.items():
                add(some, lang)
            if sum(len(c) for c, _ in held.values()) > HELD:
                yield from report()
        yield from report()

    counts = rows.mapInArrow(count, "lang string, code long, n long") \
        .groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # codes have at most 63 bits: signed order is theirs
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size)
    found: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "rank").limit(MAX_LANGUAGES * size + 1).collect():
        found.setdefault(row["lang"], []).append(row["code"])
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is {lang_col!r} a language?")
    return found


def classify_column(text: Column, model: dict[str, list[int]], size: int = SIZE) -> Column:
    """struct(lang_pred, score) of a text column."""
    langs = sorted(model)
    letter_table()  # goes to the tasks as it is
    codes = np.unique(np.array([c for l in langs for c in model[l]], np.int64)).astype(np.uint64)
    place = np.full((len(codes) + 1, len(langs)), size, np.int32)  # the last row: in no profile
    for j, lang in enumerate(langs):
        place[np.searchsorted(codes, np.array(model[lang], np.uint64)), j] = np.arange(len(model[lang]))

    def one(value: str | None) -> tuple[str, float]:
        own = ranked(ngrams(value), size)
        if not len(own) or not langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(codes, own)
        at[at == len(codes)] = 0
        at = np.where(codes[at] == own, at, len(codes))
        ranks = place[at]
        apart = np.where(ranks < size, np.abs(ranks - np.arange(len(own))[:, None]), size).sum(axis=0)
        best = int(apart.argmin())
        return langs[best], 1.0 - float(apart[best]) / (size * len(own))

    @F.arrow_udf("lang_pred string, score double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [one(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["lang_pred", "score"])
    return run(text)


def identify(docs: DataFrame, model: dict[str, list[int]], text_col: str = "text",
             size: int = SIZE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1: one less the out-of-place
    distance as a share of the largest possible).

    A null text, or one without letters, is ``und`` with score 0, and so is any
    text if the model is empty.  Equal distances go to the first language in
    alphabetical order.  Columns of the input that bear one of the new names give
    way; repeated rows and other columns stay as they are."""
    found = classify_column(F.col(f"`{text_col}`"), model, size)
    work = beside(docs)
    return docs.withColumn(work, found).select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")],
        f"{work}.lang_pred", f"{work}.score")


def drop_unknown(docs: DataFrame, model: dict[str, list[int]], text_col: str = "text", size: int = SIZE,
                 least: float = LEAST, letters: int = LETTERS) -> DataFrame:
    """The rows of ``docs`` whose language one of the profiles describes.

    Texts without letters go, and so do texts of at least ``letters`` letters whose nearest
    profile is so far off that the score is under ``least``: another script, other letter
    sequences, or random letters.  Fewer letters are too few to tell; those texts stay.
    With an empty model all rows go.  Repeated rows, null ids and all columns are kept."""
    work = beside(docs)
    score, text = F.col(f"{work}.score"), F.col(f"`{text_col}`")
    strange = (score < least) & (F.regexp_count(text, F.lit(r"\p{L}")) >= letters)
    return docs.withColumn(work, classify_column(text, model, size)) \
        .where((F.col(f"{work}.lang_pred") != UNKNOWN) & ~strange).drop(work)
