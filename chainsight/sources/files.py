"""Raw-file readers (S1, S2, S4-S7) producing the role tables.

Every reader is a single distributed scan: executors read the files
directly, no driver-side parsing.  Numeric text is converted with
``try_cast`` so malformed values become NULL instead of failing the job
(ANSI mode raises on a plain cast).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainsight import schemas as SC
from chainsight.functions import constants as K
from chainsight.functions import features as FX
from chainsight.operators.sets import tag_series
from chainsight.run import RunContext
from chainsight.sources import rows as ROWS


def _lineage(df: DataFrame, source_name: str, with_file: bool = True, run: RunContext | None = None) -> DataFrame:
    """K7 columns: ingest time (the run's), source file, source name, pipeline version."""
    run = run or RunContext()
    df = df.withColumn("_ingested_at", run.stamp())
    if with_file:
        df = df.withColumn("_source_file", F.col("_metadata.file_path"))
    return df.withColumn("_source_name", F.lit(source_name)).withColumn("_pipeline_version", F.lit(run.version))


# S1 -------------------------------------------------------------------------
def read_shipping_raw(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The 53-column order-line export: Latin-1, ``"`` escapes, one record per
    line, header skipped; columns bound by position; bad numbers -> NULL."""
    return (spark.read
            .option("header", True)
            .option("encoding", "ISO-8859-1")
            .option("multiLine", False)
            .options(**ROWS.ORDER_LINE)
            .schema(SC.SHIPPING_CSV)
            .csv(path if isinstance(path, str) else list(path)))


def shipping_bronze(raw: DataFrame, drop_columns: Sequence[str] = (), run: RunContext | None = None) -> DataFrame:
    """Bronze shipping table: raw columns plus lineage.

    ``drop_columns`` names source columns that must not be stored, such as
    ``schemas.SHIPPING_PERSONAL``; silver never selects those."""
    return _lineage(raw.drop(*drop_columns), "order_line_export", run=run)


def shipping_roles(raw: DataFrame) -> DataFrame:
    """Rename the raw export into the shipping role table."""
    return raw.select(*[F.col(src).alias(dst) for src, dst in SC.SHIPPING_ROLES.items()])


def read_shipping(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return shipping_roles(read_shipping_raw(spark, path))


# S2 / U2 --------------------------------------------------------------------
def read_weather(spark: SparkSession, paths: Sequence[str], run: RunContext | None = None) -> DataFrame:
    """Storm event files (gzip CSV, several years) in one scan.

    Read as text (no inference pass over compressed files), then cast in one
    projection.  A gzip file can't be split, so reading it is one task; its rows
    are dealt out evenly before all that follows.
    """
    raw = spark.read.option("header", True).option("multiLine", False).csv(list(paths)).hint("rebalance")
    cols = []
    for src, dst, typ in SC.STORM_COLUMNS:
        c = F.col(f"`{src}`")
        cols.append((c if typ == "string" else c.try_cast(typ)).alias(dst))
    df = raw.select(*cols)
    df = df.withColumn("severity_score", FX.severity_score("event_type"))
    df = df.withColumn("severity_label", FX.severity_label("severity_score"))
    return _lineage(df, "storm_events", with_file=False, run=run)


# S4 + W2 --------------------------------------------------------------------
def read_news(spark: SparkSession, path: str, summary_chars: int | None = None,
              run: RunContext | None = None) -> DataFrame:
    """Landed RSS feeds, one folder per search query: ``<path>/<query>/*.xml``.

    Each ``<item>`` becomes a row, its fields read as text (missing -> ""); the
    feed's ``<source>`` element has text and a ``url`` attribute (missing ->
    "Unknown"); ``summary_chars`` may cut the summary, which is whole by default;
    the query tag is the parent folder name.  ``feed_order`` keeps file and item
    order for the first-per-title de-duplication.
    """
    run = run or RunContext()
    items = (spark.read.format("xml").option("rowTag", "item").schema(SC.NEWS_ITEM)
             .option("recursiveFileLookup", True).load(path))
    file_path = F.col("_metadata.file_path")

    df = items.select(
        *ROWS.news_fields(),
        F.regexp_extract(file_path, r"([^/]+)/[^/]+$", 1).alias("query_used"),
        run.day().cast("string").alias("ingested_date"),
        F.struct(file_path.alias("file"), F.monotonically_increasing_id().alias("item")).alias("feed_order"),
    )
    if summary_chars is not None:
        df = df.withColumn("summary", F.substring("summary", 1, summary_chars))
    return _lineage(df, "news_feed", with_file=False, run=run)


# S5 + U1 --------------------------------------------------------------------
def read_commodity(spark: SparkSession, path: str,
                   series_names: Mapping[str, str] | None = None, run: RunContext | None = None) -> DataFrame:
    """Landed price-series JSON files ``<path>/<SERIES_ID>.json``, each
    ``{"observations": [{"date": ..., "value": ...}]}``.

    One scan over all files (the union of the series), exploded to one row
    per observation; ``"."`` marks a missing value and is dropped; the metric
    name comes from a literal map of series ids (a series not in it keeps its id).
    """
    run = run or RunContext()
    names = dict(series_names or dict(K.COMMODITY_SERIES))
    raw = spark.read.option("multiLine", True).schema(SC.PRICE_OBSERVATIONS).json(path)
    series = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
    obs = raw.select(series.alias("series_id"), F.explode("observations").alias("o"))
    prices = obs.where(ROWS.is_observed("o")).select(*ROWS.price_fields("o"), "series_id")
    return tag_series(prices, names).withColumn("ingested_date", run.day()).withColumn("ingested_ts", run.stamp()) \
     .withColumn("source", F.lit("price_api"))


# S6 -------------------------------------------------------------------------
def read_country_scores(spark: SparkSession, path: str, run: RunContext | None = None) -> DataFrame:
    """Country logistics scores (CSV with header) plus the F8 tier."""
    df = spark.read.option("header", True).schema(SC.COUNTRY_SCORES).csv(path)
    df = (df.withColumn("logistics_risk_tier", FX.logistics_tier("lpi_score"))
          .withColumn("year", F.lit(K.SCORE_YEAR)).withColumn("data_source", F.lit(K.SCORE_SOURCE)))
    return _lineage(df, "country_scores", with_file=False, run=run)


# S7 -------------------------------------------------------------------------
def read_suppliers(spark: SparkSession, path: str, fmt: str = "parquet", run: RunContext | None = None) -> DataFrame:
    """Supplier dimension with its declared schema; NOT NULL is checked by the job
    (``supplier_null_check``), as no file format enforces it on reading."""
    reader = spark.read.format(fmt).schema(SC.SUPPLIERS)
    if fmt == "csv":
        reader = reader.option("header", True)
    return _lineage(reader.load(path), "supplier_master", with_file=False, run=run)


def supplier_null_check(suppliers: DataFrame) -> DataFrame:
    """Q1-style count of NULLs in the columns declared NOT NULL (one pass)."""
    required = [f.name for f in SC.SUPPLIERS.fields if not f.nullable and f.name in suppliers.columns]
    return suppliers.agg(F.count(F.lit(1)).alias("rows"),
                         *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required])
