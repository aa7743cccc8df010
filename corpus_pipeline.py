"""Corpus pipeline: language ID, near-duplicate removal, benchmark decontamination,
secret redaction and packing, each stage on all that its predecessor kept.

Part of the package ``chainsight.llm`` (registered as query ``pipeline``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainsight.llm import decontaminate, langid, packing, secret_scan, simhash
from chainsight.llm.common import beside, materialize, read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is known.

    Profiles come from the labelled documents.  A document without letters goes, and one
    whose text is far from every profile (``langid.LEAST``); short or mixed texts are kept."""
    return langid.drop_unknown(docs, langid.profiles(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: the one with the smallest id."""
    return simhash.drop_near_duplicates(docs, words=3, max_bits=3)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by its kind in brackets; a column ``n_chars`` follows the text.

    Findings are joined by blob, by a merge join at every size.  Rows without secrets stay
    as they are, null texts and ids and repeated rows among them."""
    found = secret_scan.scan(docs.select("doc_id", "text")) \
        .where(F.size("findings") > 0).select("blob", "findings").distinct()
    found = materialize(found).select(F.struct("blob", "findings").alias("found"))
    work = beside(docs)
    blob = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    joined = docs.join(found.withColumnRenamed("found", work).hint("merge"), blob == F.col(f"{work}.blob"), "left")
    hit = F.col(work).isNotNull()
    text = F.when(hit, secret_scan.redact_column(F.col("text"), F.col(f"{work}.findings"))).otherwise(F.col("text"))
    done = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return done.select(*[f"`{c}`" for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaked),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: The stages are tested against brute-force versions: SQL has neither their hash nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
