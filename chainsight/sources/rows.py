"""Raw records held as text in a column (S1, S4, S5), for records that arrive through a
table, a queue or an archive in place of files.

Each parser takes a string column and gives the same fields as the file reader of its
format, with which it shares options, schema and projection, and ``bad``: whether the
record could not be read whole.  Bad records are kept and counted, never dropped: a
field that can't be read is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainsight import schemas as SC
from chainsight.functions import constants as K

BAD = "_bad_record"
#: One record a line, ``"`` doubled inside quotes, what can't be read is NULL.
ORDER_LINE = {"escape": '"', "mode": "PERMISSIVE"}


def _with_bad(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])


# S1 -------------------------------------------------------------------------
def parse_order_lines(df: DataFrame, line: str) -> DataFrame:
    """``df`` without ``line``, and the role columns of the order line in it and ``bad``.

    Columns are bound by position; fields that a short line lacks are NULL."""
    record = F.from_csv(line, f"{SC.SHIPPING_CSV}, {BAD} string", {**ORDER_LINE, "columnNameOfCorruptRecord": BAD})
    rest = [f"`{c}`" for c in df.columns if c != line]
    return df.select(*rest, record.alias("_r")).select(
        *rest, *[F.col(f"_r.{src}").alias(dst) for src, dst in SC.SHIPPING_ROLES.items()],
        (F.col("_r").isNull() | F.col(f"_r.{BAD}").isNotNull()).alias("bad"))


# S4 -------------------------------------------------------------------------
def news_fields(item: str = "") -> list[Column]:
    """Title, published, summary, link and source of a feed item (missing text is empty, a
    missing source "Unknown"); ``item`` names the struct that holds it."""
    at = f"{item}." if item else ""

    def text(name: str, default: str = "") -> Column:
        return F.coalesce(F.col(f"{at}{name}"), F.lit(default))
    return [text("title").alias("title"), text("pubDate").alias("published"), text("description").alias("summary"),
            text("link").alias("link"), text("source._VALUE", "Unknown").alias("source")]


def parse_feeds(df: DataFrame, feed: str) -> DataFrame:
    """One row for each item of the RSS document in ``feed``, in order (``item``, from 0); a
    document that can't be read, or without items, is one row without fields."""
    channel = T.StructType([T.StructField("channel", T.StructType([T.StructField("item", T.ArrayType(SC.NEWS_ITEM))]))])
    document = F.from_xml(feed, _with_bad(channel).simpleString(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    rest = [f"`{c}`" for c in df.columns if c != feed]
    read = df.select(*rest, document.alias("_d"))
    bad = F.col("_d").isNull() | F.col(f"_d.{BAD}").isNotNull()
    items = read.select(*rest, bad.alias("bad"), F.posexplode_outer("_d.channel.item").alias("item", "_i"))
    found = F.col("item").isNotNull()
    return items.select(*rest, "bad", "item", *[F.when(found, c).alias(n) for c, n in zip(
        news_fields("_i"), ("title", "published", "summary", "link", "source"))])


# S5 -------------------------------------------------------------------------
def price_fields(observation: str) -> list[Column]:
    """Date and value of an observation."""
    return [F.col(f"{observation}.date").alias("date"), F.col(f"{observation}.value").try_cast("double").alias("value")]


def is_observed(observation: str) -> Column:
    """Not the sign of a missing value."""
    return F.col(f"{observation}.value") != K.MISSING_OBSERVATION


def parse_prices(df: DataFrame, document: str) -> DataFrame:
    """One row for each observation of the price document in ``document`` but those marked
    missing; a document that can't be read is one row without fields."""
    read = F.from_json(document, _with_bad(SC.PRICE_OBSERVATIONS), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    rest = [f"`{c}`" for c in df.columns if c != document]
    bad = F.col("_d").isNull() | F.col(f"_d.{BAD}").isNotNull()
    rows = df.select(*rest, read.alias("_d")).select(*rest, bad.alias("bad"), F.explode_outer("_d.observations").alias("_o"))
    return rows.where(F.col("bad") | is_observed("_o")).select(*rest, "bad", *price_fields("_o"))
