"""Aggregations and marts.

Each mart is one ``groupBy().agg()``: Spark plans a partial aggregate before
the exchange, so only one partial row per group per task is shuffled, and a
group holding a third of all rows costs no more than any other.  Rounded
means and sums use ``functions.exact`` so they do not depend on how rows are
partitioned.  ``count(order_id)`` counts non-null order ids over lines, as the
source does; it is not a distinct-order count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainsight.functions import constants as K
from chainsight.functions import features as FX
from chainsight.functions.exact import decimal_mean, exact_mean, exact_ratio, exact_sum


# Silver columns each mart reads (lets a caller build only those).
COLUMNS = {
    "delay_by_market": ("market", "is_delayed", "order_id"),
    "delay_by_mode": ("shipping_mode", "is_delayed", "delay_days"),
    "kpi_totals": ("is_delayed", "sales", "order_profit", "delay_days"),
    "market_kpi": ("market", "order_id", "is_delayed", "delay_days", "sales", "lpi_score", "weather_risk_score"),
    "route_risk": ("order_country", "order_region", "shipping_mode", "order_id", "is_delayed", "delay_days",
                   "lpi_score", "weather_risk_score"),
    "supplier_leaderboard": ("supplier_name", "supplier_tier", "supplier_region", "order_id", "is_delayed",
                             "delay_days", "supplier_quality_score", "supplier_esg_score", "lead_time_days",
                             "sales"),
    "supplier_preview": ("supplier_name", "supplier_tier", "supplier_region", "order_id", "is_delayed",
                         "supplier_quality_score"),
    "mode_performance": ("shipping_mode", "order_id", "is_delayed", "delay_days", "sales", "order_profit"),
}


def delay_pct(flag: str = "is_delayed", places: int = 1) -> Column:
    return exact_mean(flag, places, times=100)


# G1 / T7 --------------------------------------------------------------------
def value_distribution(df: DataFrame, cols: Sequence[str], top: int | None = None,
                       order_by: Sequence[Column] | None = None) -> DataFrame:
    """Row count per value combination, largest first (ties by the values)."""
    out = df.groupBy(*cols).count()
    order = list(order_by) if order_by else [F.col("count").desc()]
    out = out.orderBy(*order, *[F.col(c).asc_nulls_first() for c in cols])
    return out.limit(top) if top else out


# G2 is operators.joins.storm_stats_by_state; G3 is operators.joins.route_stats.

# G4 -------------------------------------------------------------------------
def delay_by_market(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("market")
            .agg(F.avg("is_delayed").alias("delay_rate"), F.count("order_id").alias("orders"))
            .orderBy(F.col("delay_rate").desc(), "market"))


def delay_by_mode(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("shipping_mode")
            .agg(F.avg("is_delayed").alias("delay_rate"), F.avg("delay_days").alias("avg_delay_days"))
            .orderBy(F.col("delay_rate").desc(), "shipping_mode"))


# G5 -------------------------------------------------------------------------
def kpi_totals(silver: DataFrame, as_double: bool = True) -> DataFrame:
    """Grand totals in one pass (the source runs five jobs)."""
    return silver.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("is_delayed") == 1).alias("delayed_orders"),
        exact_ratio(F.count_if(F.col("is_delayed") == 1) * 100, F.count(F.lit(1)), 1, as_double).alias("delay_rate_pct"),
        exact_sum("sales", 0, as_double).alias("total_sales_usd"),
        exact_sum("order_profit", 0, as_double).alias("total_profit_usd"),
        exact_ratio(F.sum(F.col("delay_days").cast("long")), F.count("delay_days"), 2, as_double).alias("avg_delay_days"),
    )


# G6 -------------------------------------------------------------------------
def market_kpi(silver: DataFrame) -> DataFrame:
    """Market mart: lines, delay %, mean delay, sales, mean LPI, mean weather."""
    return (silver.groupBy("market")
            .agg(F.count("order_id").alias("total_orders"),
                 delay_pct().alias("delay_rate_pct"),
                 exact_mean("delay_days", 2).alias("avg_delay_days"),
                 exact_sum("sales", 0).alias("total_sales_usd"),
                 decimal_mean("lpi_score", 2).alias("avg_lpi_score"),
                 decimal_mean("weather_risk_score", 2).alias("avg_weather_risk"))
            .orderBy(F.col("delay_rate_pct").desc(), "market"))


# F15 over G6 ----------------------------------------------------------------
def market_bands(market: DataFrame) -> DataFrame:
    """Dashboard rows: band from the delay %, LPI as % of 5, sales as ``$x.xxM``."""
    return market.select(
        "market", "total_orders", "delay_rate_pct", "avg_delay_days",
        FX.sales_millions("total_sales_usd").alias("sales_label"),
        FX.lpi_width_pct("avg_lpi_score").alias("lpi_pct"),
        FX.market_band("delay_rate_pct").alias("band"),
    )


# G7 + W1 --------------------------------------------------------------------
def route_risk(silver: DataFrame, min_orders: int = K.ROUTE_MIN_ORDERS) -> DataFrame:
    """Route mart with ``risk_rank`` = ``rank()`` by delay % then volume (ties share a rank).

    The rank window has no partition key, but it runs on the aggregated,
    filtered routes (one row per country x region x mode), not on lines.
    """
    routes = (silver.groupBy("order_country", "order_region", "shipping_mode")
              .agg(F.count("order_id").alias("order_count"),
                   delay_pct().alias("delay_rate_pct"),
                   exact_mean("delay_days", 2).alias("avg_delay_days"),
                   decimal_mean("lpi_score", 2).alias("avg_lpi_score"),
                   decimal_mean("weather_risk_score", 2).alias("avg_weather_risk"))
              .where(F.col("order_count") >= min_orders))
    w = Window.orderBy(F.col("delay_rate_pct").desc(), F.col("order_count").desc())
    return routes.withColumn("risk_rank", F.rank().over(w))


# G8 -------------------------------------------------------------------------
SUPPLIER_GROUP = ("supplier_name", "supplier_tier", "supplier_region")


def supplier_leaderboard(silver: DataFrame, min_orders: int = K.SUPPLIER_MIN_ORDERS) -> DataFrame:
    return (silver.groupBy(*SUPPLIER_GROUP)
            .agg(F.count("order_id").alias("order_count"),
                 delay_pct().alias("delay_rate_pct"),
                 exact_mean("delay_days", 2).alias("avg_delay_days"),
                 decimal_mean("supplier_quality_score", 2).alias("quality_score"),
                 decimal_mean("supplier_esg_score", 2).alias("esg_score"),
                 exact_mean("lead_time_days", 1).alias("avg_lead_time"),
                 exact_sum("sales", 0).alias("total_sales"))
            .where(F.col("order_count") >= min_orders))


# G9 -------------------------------------------------------------------------
def supplier_preview(silver: DataFrame, min_orders: int = K.SUPPLIER_PREVIEW_MIN_ORDERS) -> DataFrame:
    return (silver.groupBy(*SUPPLIER_GROUP)
            .agg(F.count("order_id").alias("orders"),
                 delay_pct().alias("delay_rate_pct"),
                 decimal_mean("supplier_quality_score", 1).alias("quality"))
            .where(F.col("orders") >= min_orders))


# G10 ------------------------------------------------------------------------
def mode_performance(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("shipping_mode")
            .agg(F.count("order_id").alias("orders"),
                 delay_pct().alias("delay_rate_pct"),
                 exact_mean("delay_days", 2).alias("avg_delay_days"),
                 exact_sum("sales", 0).alias("total_sales"),
                 decimal_mean("order_profit", 2).alias("avg_profit"))
            .orderBy(F.col("delay_rate_pct").desc(), "shipping_mode"))


# G11 ------------------------------------------------------------------------
def accuracy_by_market(predictions: DataFrame) -> DataFrame:
    return (predictions.withColumn("correct", FX.correct("actual_risk", "predicted_risk"))
            .groupBy("market")
            .agg(F.count("order_id").alias("predictions"),
                 exact_mean("correct", 1, times=100).alias("accuracy_pct"))
            .orderBy(F.col("accuracy_pct").desc(), "market"))


# G14 ------------------------------------------------------------------------
def class_balance(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.groupBy(label_col).count().orderBy(label_col)


# G15 + F10 ------------------------------------------------------------------
def news_level_summary(scored_news: DataFrame, score_col: str = "news_risk_score") -> DataFrame:
    """One row: number of articles, mean title score and the level it maps to (empty
    feed -> LOW)."""
    return (scored_news.agg(F.count(F.lit(1)).alias("articles"), F.avg(score_col).alias("avg_news_risk"))
            .withColumn("news_risk_level", FX.news_level("avg_news_risk")))


# F11 / T4 -------------------------------------------------------------------
def latest_by_series(prices: DataFrame, series_col: str = "metric_name",
                     above: float = K.COMMODITY_SHOCK_ABOVE) -> DataFrame:
    """Latest observation per series (``max_by``, no sort; of one date's several values
    the largest) and its shock flag.  Rows without a value are no observations."""
    return (prices.where(F.col("value").isNotNull()).groupBy(series_col)
            .agg(F.max("date").alias("latest_date"),
                 F.max_by("value", F.struct("date", "value")).alias("latest_value"),
                 F.count(F.lit(1)).alias("observations"))
            .withColumn("shock_flag", FX.shock_flag("latest_value", above)))


def commodity_shock(prices: DataFrame, metric: str = K.OIL_METRIC,
                    above: float = K.COMMODITY_SHOCK_ABOVE) -> DataFrame:
    """One row with the latest price of ``metric`` and the shock flag; no rows -> flag 0."""
    latest = (prices.where((F.col("metric_name") == metric) & F.col("value").isNotNull())
              .agg(F.max_by("value", F.struct("date", "value")).alias("latest_price")))
    return latest.withColumn("commodity_shock_flag", FX.shock_flag("latest_price", above))


# G13 ------------------------------------------------------------------------
def kpi_summary(silver: DataFrame, model_metrics: DataFrame, news: DataFrame,
                pipeline_version: str) -> DataFrame:
    """KPI rows (metric, value) as strings, all computed (none hard-coded).

    Totals are one aggregate pass; ``model_metrics`` is a one-row frame with
    the text columns ``model_auc``, ``model_accuracy``, ``model_f1``;
    ``news`` is the one-row frame of ``news_level_summary``.  Numbers are rounded half-up in decimal
    before they become text.
    """
    totals = kpi_totals(silver, as_double=False)
    feed = news.select(F.struct("news_risk_level", "articles")).scalar()
    metrics = model_metrics.select(F.struct("model_auc", "model_accuracy", "model_f1")).scalar()
    row = totals.select(
        *[F.col(c).cast("string").alias(c) for c in totals.columns],
        *[metrics.getField(c).alias(c) for c in ("model_auc", "model_accuracy", "model_f1")],
        feed.getField("news_risk_level").alias("news_risk_level"),
        feed.getField("articles").cast("string").alias("news_articles"),
        F.lit(pipeline_version).alias("pipeline_version"),
    )
    names = row.columns
    stack = "stack({n}, {pairs}) as (metric, value)".format(
        n=len(names), pairs=", ".join(f"'{c}', `{c}`" for c in names))
    return row.selectExpr(stack)
