"""A small table with everything that must not break an operator."""

from pyspark.sql import types as T

LONG = "word " * 30_000 + "end."

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog.", "en"),
    (1, "The quick brown fox jumps over the lazy dog.", "en"),      # a repeated row
    (1, "Another text under the same id.", None),
    (None, "The quick brown fox jumps over the lazy dog.", "en"),   # no id
    (None, None, None),
    (2, None, "fr"),
    (3, "", "fr"),
    (4, " \t\n ", None),
    (5, LONG, "en"),
    (6, LONG, "en"),
    (7, "12345 67890 !!! ???", "xx"),
    (8, "one", None),
    (9, "Ünïcödé 😀 ﬁ İstanbul ΣΑΣ \x1c a\x1fb", "de"),
]

#: Names that operators use for their own columns.
CLASHES = ("id", "row", "code", "size", "shard", "slot", "score", "predicted", "lang_pred", "fingerprint",
           "component", "node", "key", "piece", "start", "blob", "findings", "spans", "votes", "found",
           "part", "first", "before", "_a", "_b", "_place", "_work", "_langid", "_toxicity", "_lang", "_blob", "_findings")

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType())]
                      + [T.StructField(c, T.StringType()) for c in CLASHES])


def messy(spark, rows=ROWS):
    return spark.createDataFrame([(*r, *("x" if i % 2 else None for i in range(len(CLASHES)))) for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
