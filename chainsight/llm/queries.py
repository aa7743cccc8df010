"""Registered queries of this package: each applies one operator, with production
parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, chat_format, decontaminate, langid, lexical, licenses, packing, pii, secret_scan, sharding, simhash,
               toxicity, turn_repair)
from .common import read_table, spans_text
from .oracle import ORACLE  # noqa: F401  (registered with the queries)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the best window."""
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"),
                                    read_table(spark, sf_dir, "benchmark")).drop("bits")


def is_held_out(modulus: int, rest: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; profiles from those whose crc32 mod 3 isn't 1."""
    docs = read_table(spark, sf_dir, "documents")
    model = langid.profiles(docs.where(~is_held_out(3, 1)))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", is_held_out(3, 1).alias("held_out"), "lang_pred", "score")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id", *[count(k) for k in pii.BASE],
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"))


def op5_byte_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, shards of near-equal bytes."""
    rows = sharding.shard_by_bytes(read_table(spark, sf_dir, "documents").select("doc_id", "text"), 16)
    return rows.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed licence paragraphs of every document."""
    docs = read_table(spark, sf_dir, "documents")
    found = licenses.scan_licences(docs, licenses.train(docs))
    each = F.transform("licences", lambda x: F.concat_ws(":", x["family"], x["start"], x["end"]))
    families = F.array_sort(F.array_distinct(F.transform("licences", lambda x: x["family"])))
    return found.select(
        "doc_id", F.size("licences").cast("long").alias("n_licences"), F.array_join(families, ",").alias("families"),
        F.array_max(F.transform("licences", lambda x: x["probability"])).alias("probability"),
        F.array_join(each, ",").alias("spans"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def secret_digest(found: DataFrame) -> DataFrame:
    """Digest columns of ``secret_scan.scan``."""
    def count(kind: str):
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda s: s["kind"].isin(*secret_scan.BASE))
    return found.select(
        "doc_id", *[count(k) for k in secret_scan.BASE],
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("findings")).alias("spans"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, scanned once a blob into a new ledger."""
    return secret_digest(secret_scan.scan(read_table(spark, sf_dir, "documents")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels only from those whose crc32 mod 5 isn't 0."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(~is_held_out(5, 0))
    return toxicity.train_and_score(docs, labels, ~is_held_out(5, 0)).select(
        "doc_id", is_held_out(5, 0).alias("held_out"), "score", "predicted")


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted windows."""
    chats = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    windows = chat_format.format_chats(chats.union(tricky))
    turns = chat_format.read_turns(F.col("formatted"))
    fresh = F.slice(turns, F.col("repeated") + 1, F.col("turns") - F.col("repeated"))
    each = windows.select(
        "conv_id", F.struct("block", "window", F.array_join(F.transform(
            fresh, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
            F.array_join(chat_format.read_targets(F.col("formatted"), F.col("loss")), "").alias("targets")).alias("part"),
        (F.col("turns") - F.col("repeated")).cast("long").alias("n"), F.length("formatted").cast("long").alias("chars"))
    whole = each.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sort_array(F.collect_list("part")).alias("parts"), F.sum("chars").alias("formatted_chars"))

    def text(name: str):
        return F.array_join(F.transform("parts", lambda p: p[name]), "")

    return whole.select(
        "conv_id", "n_turns", F.sha2(text("turns").cast("binary"), 256).alias("turns_sha256"),
        F.length(text("targets")).cast("long").alias("loss_chars"),
        F.sha2(text("targets").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 highest-scoring documents of every benchmark item."""
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=50)


def damaged(chats: DataFrame) -> DataFrame:
    """Conversation rows with one of five kinds of damage, by their id and turn."""
    def known(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", known("conv_id"), known("turn")).cast("binary")) % 20
    rows = chats.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, its cheapest edits, and a digest of what they give."""
    chats = read_table(spark, sf_dir, "conversations")
    repaired = turn_repair.repair(damaged(chats))
    line = F.concat("role", F.lit(":"), "text")
    lines = repaired.turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("part", "seq", "place", line.alias("line")))).alias("lines"))
    every = chats.select("conv_id").distinct().withColumnRenamed("conv_id", "id")
    reports = repaired.reports.withColumnRenamed("conv_id", "r")
    found = every.join(reports, F.expr("id <=> r"), "left").join(lines, F.expr("id <=> conv_id"), "left")
    text = F.coalesce(F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), F.lit(""))
    return found.select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.sha2(text.cast("binary"), 256).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_language_id": op2_language_id,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_personal_data": op4_personal_data,
    "op5_byte_sharding": op5_byte_sharding,
    "op6_license_scan": op6_license_scan,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_secret_scan": op9_secret_scan,
    "op10_toxicity": op10_toxicity,
    "op11_chat_formatting": op11_chat_formatting,
    "op12_lexical_search": op12_lexical_search,
    "op13_turn_repair": op13_turn_repair,
}
