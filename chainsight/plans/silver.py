"""Silver build: one lazy plan from the bronze role tables to the wide
order-line table (one row per order line, partitioned by market on write).

Plan shape (see ``explain``): the fact is scanned for its ~15 used columns;
supplier, country-score and storm dimensions, and the route statistics (a
partial+final aggregate), are plain left joins whose side Spark broadcasts when
its measured bytes allow; the commodity and news signals are scalar subqueries.
With such dimensions the order lines are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from chainsight.functions import constants as K
from chainsight.functions import features as FX
from chainsight.operators import aggregates as G
from chainsight.operators import joins as J
from chainsight.operators.windows import first_per_key
from chainsight.run import RunContext


@dataclass
class BronzeTables:
    """The six bronze role tables and the parameters that tie them together."""

    shipping: DataFrame
    suppliers: DataFrame
    country_scores: DataFrame
    weather: DataFrame
    commodity: DataFrame
    news: DataFrame
    oil_metric: str = K.OIL_METRIC
    news_level3: Sequence[str] = tuple(K.NEWS_LEVEL3_KEYWORDS)
    news_level2: Sequence[str] = tuple(K.NEWS_LEVEL2_KEYWORDS)


# F1-F4 over the shipping lines.
def shipping_features(shipping: DataFrame) -> DataFrame:
    return (shipping
            .withColumn("delay_days", FX.delay_days("days_real", "days_scheduled"))
            .withColumn("is_delayed", FX.is_delayed("delay_days"))
            .withColumn("route_key", FX.route_key("order_country", "order_region"))
            .withColumn("profit_margin_flag", FX.profit_margin_flag("order_profit")))


# W2 + F9
def dedup_news(news: DataFrame) -> DataFrame:
    """First article per title in feed order."""
    return first_per_key(news, ["title"], ["feed_order"])


def score_news(news: DataFrame, level3: Sequence[str] = K.NEWS_LEVEL3_KEYWORDS,
               level2: Sequence[str] = K.NEWS_LEVEL2_KEYWORDS) -> DataFrame:
    return news.withColumn("news_risk_score", FX.news_title_score("title", level3, level2))


def news_summary(bronze: BronzeTables) -> DataFrame:
    """G15 + F10 over the de-duplicated, scored feed."""
    titles = dedup_news(bronze.news.select("title", "feed_order"))
    scored = score_news(titles, bronze.news_level3, bronze.news_level2)
    return G.news_level_summary(scored)


SILVER_COLUMNS = [
    "order_id", "line_number", "order_date", "shipping_date", "order_country", "order_region", "market",
    "shipping_mode", "customer_segment", "product_name", "late_delivery_risk", "delivery_status",
    "delay_days", "is_delayed", "profit_margin_flag", "route_delay_rate", "route_avg_delay_days",
    "route_order_count", "supplier_name", "supplier_tier", "supplier_region", "supplier_country_code",
    "lead_time_days", "supplier_quality_score", "supplier_esg_score", "supplier_risk_notes",
    "supplier_risk_flag", "lpi_score", "logistics_risk_tier", "infrastructure_score", "timeliness_score",
    "weather_risk_score", "storm_event_count", "high_critical_storm_count", "commodity_shock_flag",
    "news_risk_level", "news_risk_score_global", "sales", "order_profit",
]


def global_signals(bronze: BronzeTables, needed: Sequence[str] | None = None) -> dict:
    """J5 scalars: commodity shock flag, news level and mean news score, each
    news pair from one scalar subquery."""
    out = {}
    want = set(needed) if needed is not None else set(SIGNAL_COLUMNS)
    if "commodity_shock_flag" in want:
        shock = G.commodity_shock(bronze.commodity, bronze.oil_metric)
        out["commodity_shock_flag"] = shock.select("commodity_shock_flag").scalar()
    if want & {"news_risk_level", "news_risk_score_global"}:
        news = news_summary(bronze).select(F.struct("news_risk_level", "avg_news_risk")).scalar()
        if "news_risk_level" in want:
            out["news_risk_level"] = news.getField("news_risk_level")
        if "news_risk_score_global" in want:
            out["news_risk_score_global"] = news.getField("avg_news_risk")
    return out


# Output columns of each enrichment step.  Every step is a left join on a key
# that is unique on its right side (supplier number, country, normalised
# state, route) or a scalar, so it never changes the number of lines; a query
# that reads none of a step's columns can skip the step.  (Catalyst cannot
# drop an unused left join by itself: it does not know the keys are unique.)
SUPPLIER_COLUMNS = tuple(J.SUPPLIER_COLUMNS.values())
COUNTRY_COLUMNS = ("lpi_score", "logistics_risk_tier", "infrastructure_score", "timeliness_score",
                   "supplier_risk_flag")
WEATHER_COLUMNS = tuple(K.WEATHER_DEFAULTS)
SIGNAL_COLUMNS = ("commodity_shock_flag", "news_risk_level", "news_risk_score_global")
ROUTE_COLUMNS = ("route_delay_rate", "route_avg_delay_days", "route_order_count")


#: The enrichment joins, in their order.
JOINS = ("supplier", "country_scores", "weather", "routes")


def join_sides(bronze: BronzeTables) -> dict:
    """Right side, its key columns and the lines' key columns of every enrichment join."""
    keyed = J.supplier_keyed(bronze.suppliers)
    low, span = J.supplier_range(keyed)
    return {
        "supplier": (keyed, ["sup_key"], [FX.supplier_assignment("order_id", low, span)]),
        "country_scores": (J.country_side(bronze.country_scores), ["_lpi_country"], [FX.clean_key("order_country")]),
        "weather": (J.storm_stats_by_state(bronze.weather), ["state_key"], [FX.clean_upper_key("customer_state")]),
        "routes": (J.route_side(shipping_features(bronze.shipping)), [f"_r_{k}" for k in J.ROUTE_KEYS], list(J.ROUTE_KEYS)),
    }


def enrich(bronze: BronzeTables, needed: Sequence[str] | None = None,
           lines_seen: Observation | None = None, joins_seen: dict[str, Observation] | None = None) -> DataFrame:
    """Steps F1-F4, J1, J2(+F5), J3(+N1), J5, J4 as one plan (no defaults yet).

    ``needed`` (default: all) names the output columns a caller reads; steps
    producing none of them are left out.  ``joins_seen`` (name of ``JOINS`` -> observation)
    receives what leaves each join.
    """
    want = set(needed) if needed is not None else None
    seen = joins_seen or {}

    def uses(cols) -> bool:
        return want is None or bool(want & set(cols))

    lines = shipping_features(bronze.shipping)
    df = lines
    if lines_seen is not None:
        # Q6: only the branch that is written is counted, not the statistics'
        df = df.observe(lines_seen, F.count(F.lit(1)).alias("rows"))
    if uses(SUPPLIER_COLUMNS):
        df = J.join_suppliers(df, bronze.suppliers, seen=seen.get("supplier"))
    if uses(COUNTRY_COLUMNS):
        df = J.join_country_scores(df, bronze.country_scores, seen=seen.get("country_scores"))
    if uses(WEATHER_COLUMNS):
        df = J.join_weather(df, bronze.weather, seen=seen.get("weather"))
    if uses(SIGNAL_COLUMNS):
        df = J.attach_scalars(df, **global_signals(bronze, None if want is None else sorted(want)))
    if uses(ROUTE_COLUMNS):
        df = J.join_route_stats(df, source=lines, seen=seen.get("routes"))
    return df


def silver(bronze: BronzeTables, extra: Sequence[str] = (), columns: Sequence[str] | None = None,
           lines_seen: Observation | None = None, joins_seen: dict[str, Observation] | None = None) -> DataFrame:
    """The silver table (without lineage columns) with its N2 defaults.

    ``columns`` restricts the output (and the enrichment steps) to what a
    reader needs; by default all silver columns are built.  ``lines_seen``
    receives the number of shipping lines entering the joins, ``joins_seen`` what leaves
    each of them.
    """
    cols = list(SILVER_COLUMNS) if columns is None else list(columns)
    cols += [c for c in extra if c not in cols]
    df = enrich(bronze, None if columns is None else cols, lines_seen, joins_seen)
    fills = {k: v for k, v in K.SILVER_DEFAULTS.items() if k in cols}
    out = df.select(*cols)
    return out.fillna(fills) if fills else out


def with_lineage(df: DataFrame, run: RunContext | None = None) -> DataFrame:
    """K7 for silver: processing time (the run's) and pipeline version."""
    run = run or RunContext()
    return df.withColumn("_silver_processed_at", run.stamp()).withColumn("_pipeline_version", F.lit(run.version))
