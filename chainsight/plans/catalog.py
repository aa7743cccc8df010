"""Query catalogue: one entry per operator of the inventory.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the shared test tables
(through ``sources.tables.TestTables``); ``ORACLE_SQL[name]`` holds the DuckDB
text computing the same rows from the same tables.  Queries without SQL are
checked by row count and by the pytest suite.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainsight import PIPELINE_VERSION
from chainsight import schemas as SC
from chainsight.functions import constants as K
from chainsight.functions import features as FX
from chainsight.operators import aggregates as G
from chainsight.operators import joins as J
from chainsight.operators import quality as Q
from chainsight.operators import sets as U
from chainsight.operators import topk as T
from chainsight.operators.windows import first_per_key
from chainsight.plans import oracle as O
from chainsight.plans import silver as S
from chainsight.run import RunContext
from chainsight.sources import rows as ROWS
from chainsight.sources.tables import TEST_NEWS_KEYWORDS, TEST_OIL_METRIC, TestTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

# The test tables' stand-in for the excluded shipping mode of the route list.
TEST_EXCLUDED_MODE = "1-URGENT"
# Thresholds that filter at sf0.01 (the source's 50 / 10 keep every group there).
TEST_BUSY_ROUTE_ORDERS = 480


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


class TestBronze:
    """The bronze role tables over the test tables, each defined on first use
    (a query touching two role tables does not resolve the other four)."""

    oil_metric = TEST_OIL_METRIC
    news_level3 = TEST_NEWS_KEYWORDS.level3
    news_level2 = TEST_NEWS_KEYWORDS.level2

    def __init__(self, spark: SparkSession, sf_dir: str, with_product: bool = False):
        self._t = TestTables.shared(spark, sf_dir)
        self._with_product = with_product

    @cached_property
    def shipping(self) -> DataFrame:
        return self._t.shipping_events(with_product=self._with_product)

    @cached_property
    def suppliers(self) -> DataFrame:
        return self._t.supplier_master()

    @cached_property
    def country_scores(self) -> DataFrame:
        return self._t.supplier_risk()

    @cached_property
    def weather(self) -> DataFrame:
        return self._t.weather_events()

    @cached_property
    def commodity(self) -> DataFrame:
        return self._t.commodity_prices()

    @cached_property
    def news(self) -> DataFrame:
        return self._t.news_disruptions()


def bronze(spark: SparkSession, sf_dir: str, with_product: bool = False) -> TestBronze:
    return TestBronze(spark, sf_dir, with_product)


def silver(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """Silver over the test tables; ``columns`` limits it to what a query reads."""
    if columns is not None:
        return S.silver(bronze(spark, sf_dir), columns=list(columns))
    return S.silver(bronze(spark, sf_dir))


def mart_input(spark: SparkSession, sf_dir: str, mart: str) -> DataFrame:
    return silver(spark, sf_dir, G.COLUMNS[mart])


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.shipping_features(TestTables.shared(spark, sf_dir).shipping_events(with_product=False))


# ---------------------------------------------------------------------------
# Gold marts
# ---------------------------------------------------------------------------
_PCT = O.exact_mean("is_delayed", 1, times=100)


@register("market_kpi", O.sql(["silver"], f"""
SELECT market, COUNT(order_id) AS total_orders, {_PCT} AS delay_rate_pct,
       {O.exact_mean('delay_days', 2)} AS avg_delay_days,
       {O.exact_sum('sales', 0)} AS total_sales_usd,
       {O.decimal_mean('lpi_score', 2)} AS avg_lpi_score,
       {O.decimal_mean('weather_risk_score', 2)} AS avg_weather_risk
FROM silver GROUP BY market ORDER BY delay_rate_pct DESC, market"""))
def q_market_kpi(spark, sf_dir):
    return G.market_kpi(mart_input(spark, sf_dir, "market_kpi"))


@register("market_bands", O.sql(["silver"], f"""
SELECT market, total_orders, delay_rate_pct, avg_delay_days,
       '$' || CAST(k // 100 AS VARCHAR) || '.' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') || 'M' AS sales_label,
       CAST(round(avg_lpi_score / 5.0 * 100) AS INTEGER) AS lpi_pct,
       CASE WHEN delay_rate_pct > {K.MARKET_BAND_ABOVE} THEN 'HIGH' ELSE 'MEDIUM' END AS band
FROM (
  SELECT *, (2 * CAST(total_sales_usd AS HUGEINT) + 10000) // 20000 AS k FROM (
    SELECT market, COUNT(order_id) AS total_orders, {_PCT} AS delay_rate_pct,
           {O.exact_mean('delay_days', 2)} AS avg_delay_days,
           {O.exact_sum('sales', 0)} AS total_sales_usd,
           {O.decimal_mean('lpi_score', 2)} AS avg_lpi_score
    FROM silver GROUP BY market) m) b"""))
def q_market_bands(spark, sf_dir):
    return G.market_bands(G.market_kpi(mart_input(spark, sf_dir, "market_kpi")))


def _route_body(min_orders: int) -> str:
    return f"""
SELECT *, CAST(rank() OVER (ORDER BY delay_rate_pct DESC, order_count DESC) AS INTEGER) AS risk_rank FROM (
  SELECT order_country, order_region, shipping_mode, COUNT(order_id) AS order_count,
         {_PCT} AS delay_rate_pct, {O.exact_mean('delay_days', 2)} AS avg_delay_days,
         {O.decimal_mean('lpi_score', 2)} AS avg_lpi_score,
         {O.decimal_mean('weather_risk_score', 2)} AS avg_weather_risk
  FROM silver GROUP BY order_country, order_region, shipping_mode
  HAVING COUNT(order_id) >= {min_orders}) r"""


def _route_sql(min_orders: int) -> str:
    return O.sql(["silver"], _route_body(min_orders))


@register("route_risk", _route_sql(K.ROUTE_MIN_ORDERS))
def q_route_risk(spark, sf_dir):
    return G.route_risk(mart_input(spark, sf_dir, "route_risk"), K.ROUTE_MIN_ORDERS)


@register("route_risk_busy", _route_sql(TEST_BUSY_ROUTE_ORDERS))
def q_route_risk_busy(spark, sf_dir):
    return G.route_risk(mart_input(spark, sf_dir, "route_risk"), TEST_BUSY_ROUTE_ORDERS)


_SUPPLIER_BOARD = f"""
  SELECT supplier_name, supplier_tier, supplier_region, COUNT(order_id) AS order_count,
         {_PCT} AS delay_rate_pct, {O.exact_mean('delay_days', 2)} AS avg_delay_days,
         {O.decimal_mean('supplier_quality_score', 2)} AS quality_score,
         {O.decimal_mean('supplier_esg_score', 2)} AS esg_score,
         {O.exact_mean('lead_time_days', 1)} AS avg_lead_time,
         {O.exact_sum('sales', 0)} AS total_sales
  FROM silver GROUP BY supplier_name, supplier_tier, supplier_region
  HAVING COUNT(order_id) >= {K.SUPPLIER_MIN_ORDERS}"""


@register("supplier_leaderboard", O.sql(["silver"], _SUPPLIER_BOARD))
def q_supplier_leaderboard(spark, sf_dir):
    return G.supplier_leaderboard(mart_input(spark, sf_dir, "supplier_leaderboard"))


_KEYS_ASC = "supplier_name ASC NULLS FIRST, supplier_tier ASC NULLS FIRST, supplier_region ASC NULLS FIRST"


@register("top_suppliers", O.sql(["silver"], f"""
SELECT * FROM ({_SUPPLIER_BOARD}) b ORDER BY delay_rate_pct ASC NULLS FIRST, {_KEYS_ASC} LIMIT {K.TOP_K}"""))
def q_top_suppliers(spark, sf_dir):
    return T.best_suppliers(G.supplier_leaderboard(mart_input(spark, sf_dir, "supplier_leaderboard")), K.TOP_K)


@register("worst_suppliers", O.sql(["silver"], f"""
SELECT * FROM ({_SUPPLIER_BOARD}) b ORDER BY delay_rate_pct DESC NULLS LAST, {_KEYS_ASC} LIMIT {K.TOP_K}"""))
def q_worst_suppliers(spark, sf_dir):
    return T.worst_suppliers(G.supplier_leaderboard(mart_input(spark, sf_dir, "supplier_leaderboard")), K.TOP_K)


@register("supplier_preview", O.sql(["silver"], f"""
SELECT supplier_name, supplier_tier, supplier_region, COUNT(order_id) AS orders, {_PCT} AS delay_rate_pct,
       {O.decimal_mean('supplier_quality_score', 1)} AS quality
FROM silver GROUP BY supplier_name, supplier_tier, supplier_region
HAVING COUNT(order_id) >= {K.SUPPLIER_PREVIEW_MIN_ORDERS}"""))
def q_supplier_preview(spark, sf_dir):
    return G.supplier_preview(mart_input(spark, sf_dir, "supplier_preview"))


@register("top_routes_excl", O.sql(["silver"], f"""
SELECT * FROM ({_route_body(K.ROUTE_MIN_ORDERS)}) x
WHERE shipping_mode != {O.q(TEST_EXCLUDED_MODE)}
ORDER BY delay_rate_pct DESC, order_count DESC, order_country, order_region, shipping_mode LIMIT {K.TOP_K}"""))
def q_top_routes_excl(spark, sf_dir):
    routes = G.route_risk(mart_input(spark, sf_dir, "route_risk"), K.ROUTE_MIN_ORDERS)
    return T.riskiest_routes(routes, f"shipping_mode != '{TEST_EXCLUDED_MODE}'", K.TOP_K)


@register("mode_performance", O.sql(["silver"], f"""
SELECT shipping_mode, COUNT(order_id) AS orders, {_PCT} AS delay_rate_pct,
       {O.exact_mean('delay_days', 2)} AS avg_delay_days, {O.exact_sum('sales', 0)} AS total_sales,
       {O.decimal_mean('order_profit', 2)} AS avg_profit
FROM silver GROUP BY shipping_mode"""))
def q_mode_performance(spark, sf_dir):
    return G.mode_performance(mart_input(spark, sf_dir, "mode_performance"))


@register("kpi_totals", O.sql(["silver"], f"""
SELECT COUNT(*) AS total_orders, COUNT(*) FILTER (WHERE is_delayed = 1) AS delayed_orders,
       {O.half_up('CAST(COUNT(*) FILTER (WHERE is_delayed = 1) AS HUGEINT) * 100', 'COUNT(*)', 1)} AS delay_rate_pct,
       {O.exact_sum('sales', 0)} AS total_sales_usd, {O.exact_sum('order_profit', 0)} AS total_profit_usd,
       {O.exact_mean('delay_days', 2)} AS avg_delay_days
FROM silver"""))
def q_kpi_totals(spark, sf_dir):
    return G.kpi_totals(mart_input(spark, sf_dir, "kpi_totals"))


@register("delay_by_market", O.sql(["silver"], """
SELECT market, avg(is_delayed) AS delay_rate, COUNT(order_id) AS orders FROM silver GROUP BY market"""))
def q_delay_by_market(spark, sf_dir):
    return G.delay_by_market(mart_input(spark, sf_dir, "delay_by_market"))


@register("delay_by_mode", O.sql(["silver"], """
SELECT shipping_mode, avg(is_delayed) AS delay_rate, avg(delay_days) AS avg_delay_days
FROM silver GROUP BY shipping_mode"""))
def q_delay_by_mode(spark, sf_dir):
    return G.delay_by_mode(mart_input(spark, sf_dir, "delay_by_mode"))


# ---------------------------------------------------------------------------
# Features, joins, defaults (F*, J*, N*, W3)
# ---------------------------------------------------------------------------
@register("shipping_features", O.sql(["lines"], """
SELECT order_id, line_number, days_real, days_scheduled, delay_days, is_delayed, route_key,
       profit_margin_flag, order_profit, late_delivery_risk
FROM lines"""))
def q_shipping_features(spark, sf_dir):
    return lines(spark, sf_dir).select(
        "order_id", "line_number", "days_real", "days_scheduled", "delay_days", "is_delayed",
        "route_key", "profit_margin_flag", "order_profit", "late_delivery_risk")


@register("route_stats", O.sql(["routes"], "SELECT * FROM routes"))
def q_route_stats(spark, sf_dir):
    return J.route_stats(lines(spark, sf_dir))


@register("route_stats_window", O.sql(["routes"], "SELECT * FROM routes"))
def q_route_stats_window(spark, sf_dir):
    return J.route_stats_window(lines(spark, sf_dir))


@register("lpi_tiers", O.sql(["country_scores"], """
SELECT country, lpi_score, infrastructure_score, timeliness_score, logistics_risk_tier FROM country_scores"""))
def q_lpi_tiers(spark, sf_dir):
    return TestTables.shared(spark, sf_dir).supplier_risk().select(
        "country", "lpi_score", "infrastructure_score", "timeliness_score", "logistics_risk_tier")


@register("lpi_enrich", O.sql(["enriched"], """
SELECT order_country, lpi_score, logistics_risk_tier, supplier_risk_flag, COUNT(*) AS lines
FROM enriched GROUP BY order_country, lpi_score, logistics_risk_tier, supplier_risk_flag"""))
def q_lpi_enrich(spark, sf_dir):
    b = bronze(spark, sf_dir)
    df = J.join_country_scores(S.shipping_features(b.shipping), b.country_scores)
    return df.groupBy("order_country", "lpi_score", "logistics_risk_tier", "supplier_risk_flag") \
             .agg(F.count(F.lit(1)).alias("lines"))


@register("weather_enrich", O.sql(["enriched"], """
SELECT upper(trim(customer_state)) AS state_key, weather_risk_score, storm_event_count,
       high_critical_storm_count, COUNT(*) AS lines
FROM enriched GROUP BY 1, 2, 3, 4"""))
def q_weather_enrich(spark, sf_dir):
    b = bronze(spark, sf_dir)
    df = J.join_weather(S.shipping_features(b.shipping), b.weather)
    return df.groupBy(FX.clean_upper_key("customer_state").alias("state_key"), "weather_risk_score",
                      "storm_event_count", "high_critical_storm_count").agg(F.count(F.lit(1)).alias("lines"))


@register("weather_by_state", O.sql(["storm"], "SELECT * FROM storm"))
def q_weather_by_state(spark, sf_dir):
    return J.storm_stats_by_state(TestTables.shared(spark, sf_dir).weather_events())


@register("supplier_key", O.sql(["suppliers"], f"""
SELECT supplier_id, TRY_CAST(regexp_extract(supplier_id, {O.q(K.SUPPLIER_ID_PATTERN)}, 1) AS INTEGER) AS sup_key
FROM suppliers"""))
def q_supplier_key(spark, sf_dir):
    s = TestTables.shared(spark, sf_dir).supplier_master()
    return s.select("supplier_id", FX.supplier_number("supplier_id").alias("sup_key"))


@register("supplier_dim", O.sql(["sup_keyed"], "SELECT * FROM sup_keyed"))
def q_supplier_dim(spark, sf_dir):
    return J.supplier_keyed(TestTables.shared(spark, sf_dir).supplier_master())


@register("supplier_enrich", O.sql(["enriched"], """
SELECT supplier_name, supplier_tier, supplier_country_code, COUNT(*) AS lines, COUNT(DISTINCT order_id) AS orders
FROM enriched GROUP BY supplier_name, supplier_tier, supplier_country_code"""))
def q_supplier_enrich(spark, sf_dir):
    b = bronze(spark, sf_dir)
    df = J.join_suppliers(S.shipping_features(b.shipping), b.suppliers)
    return df.groupBy("supplier_name", "supplier_tier", "supplier_country_code") \
             .agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("order_id").alias("orders"))


@register("join_coverage", O.sql(["enriched"], """
SELECT 'supplier' AS join_name, COUNT(*) AS total_rows, COUNT(supplier_name) AS matched_rows,
       """ + O.half_up("CAST(COUNT(supplier_name) AS HUGEINT) * 100", "COUNT(*)", 1) + """ AS matched_pct FROM enriched
UNION ALL
SELECT 'country_scores', COUNT(*), COUNT(lpi_score),
       """ + O.half_up("CAST(COUNT(lpi_score) AS HUGEINT) * 100", "COUNT(*)", 1) + """ FROM enriched"""))
def q_join_coverage(spark, sf_dir):
    df = S.enrich(bronze(spark, sf_dir), needed=["supplier_name", "lpi_score"])
    return J.join_coverage(df, {"supplier": "supplier_name", "country_scores": "lpi_score"})


_JOIN_ORDER = "supplier, country_scores, weather, routes".split(", ")


@register("join_lines", O.sql(["lines", "sup_range", "sup_keyed", "country_scores", "storm", "routes"], """
SELECT 'supplier' AS join_name, 1 AS step, COUNT(*) AS lines_before, COUNT(*) AS lines_after, COUNT(s.sup_key) AS matched
FROM lines l CROSS JOIN sup_range sr
LEFT JOIN sup_keyed s ON s.sup_key = CAST(((l.order_id % sr.span) + sr.span) % sr.span + sr.low AS INTEGER)
UNION ALL
SELECT 'country_scores', 2, COUNT(*), COUNT(*), COUNT(cs.country)
FROM lines l LEFT JOIN country_scores cs ON trim(l.order_country) = trim(cs.country)
UNION ALL
SELECT 'weather', 3, COUNT(*), COUNT(*), COUNT(st.state_key)
FROM lines l LEFT JOIN storm st ON upper(trim(l.customer_state)) = st.state_key
UNION ALL
SELECT 'routes', 4, COUNT(*), COUNT(*), COUNT(rt.order_country)
FROM lines l LEFT JOIN routes rt ON l.order_country = rt.order_country AND l.order_region = rt.order_region
                                 AND l.shipping_mode = rt.shipping_mode"""))
def q_join_lines(spark, sf_dir):
    """Q6 + J6: lines before and after each enrichment join, and matched ones."""
    b = bronze(spark, sf_dir)
    return J.join_forecast(S.shipping_features(b.shipping), S.join_sides(b))


@register("route_lines_window", O.sql(["lines"], """
SELECT order_id, line_number, order_country, order_region, shipping_mode,
       CAST(SUM(is_delayed) OVER r AS DOUBLE) / COUNT(is_delayed) OVER r AS route_delay_rate,
       CAST(SUM(delay_days) OVER r AS DOUBLE) / COUNT(delay_days) OVER r AS route_avg_delay_days,
       COUNT(order_id) OVER r AS route_order_count
FROM lines WINDOW r AS (PARTITION BY order_country, order_region, shipping_mode)"""))
def q_route_lines_window(spark, sf_dir):
    """W3 line by line: every order line with its route's statistics, the lines read once."""
    df = lines(spark, sf_dir).select("order_id", "line_number", *J.ROUTE_KEYS, "is_delayed", "delay_days")
    return J.attach_route_stats_window(df).drop("is_delayed", "delay_days")


_FOLDS = 5
_FOLD = f"CAST('0x' || substr(md5(CAST(order_id AS VARCHAR) || '|' || CAST(line_number AS VARCHAR)), 1, 8) AS BIGINT) % {_FOLDS}"


@register("route_rates_out_of_fold", O.sql(["lines"], f"""
, folded AS (SELECT *, {_FOLD} AS fold FROM lines)
, per_fold AS (
  SELECT order_country, order_region, shipping_mode, fold, SUM(is_delayed) AS d, COUNT(is_delayed) AS dn,
         SUM(delay_days) AS s, COUNT(delay_days) AS sn, COUNT(order_id) AS n
  FROM folded GROUP BY 1, 2, 3, 4)
SELECT a.order_country, a.order_region, a.shipping_mode, a.fold, a.n AS lines,
       CAST(SUM(b.d) AS DOUBLE) / NULLIF(SUM(b.dn), 0) AS route_delay_rate,
       CAST(SUM(b.s) AS DOUBLE) / NULLIF(SUM(b.sn), 0) AS route_avg_delay_days,
       CAST(COALESCE(SUM(b.n), 0) AS BIGINT) AS route_order_count
FROM per_fold a LEFT JOIN per_fold b ON a.order_country = b.order_country AND a.order_region = b.order_region
     AND a.shipping_mode = b.shipping_mode AND a.fold <> b.fold
GROUP BY 1, 2, 3, 4, 5""".replace("\n, folded", ", folded", 1)))
def q_route_rates_out_of_fold(spark, sf_dir):
    """Route statistics of the lines of each fold, from the lines of the other folds."""
    df = lines(spark, sf_dir).withColumn("fold", J.fold_of(_FOLDS))
    out = J.join_route_stats_out_of_fold(df, "fold")
    return out.groupBy(*J.ROUTE_KEYS, "fold", "route_delay_rate", "route_avg_delay_days", "route_order_count") \
        .agg(F.count(F.lit(1)).alias("lines"))


_DATES = ("order_date", "shipping_date")


@register("silver_lines", O.sql(["silver"], "SELECT " + ", ".join(
    f"strftime(s.{c}, '%Y-%m-%d') AS {c}" if c in _DATES else "p.p_name AS product_name" if c == "product_name"
    else f"s.{c}" for c in S.SILVER_COLUMNS) + f""", '2024-02-29 12:00:00.5' AS _silver_processed_at, {O.q(PIPELINE_VERSION)} AS _pipeline_version
FROM silver s JOIN part p ON s.partkey = p.p_partkey"""))
def q_silver_lines(spark, sf_dir):
    """Every column of every silver row, lineage of a given run included."""
    run = RunContext(datetime(2024, 2, 29, 12, 0, 0, 500_000, timezone.utc), "given")
    df = S.with_lineage(S.silver(bronze(spark, sf_dir, with_product=True)), run)
    utc = F.to_utc_timestamp("_silver_processed_at", F.current_timezone()).cast("string")
    return df.withColumn("_silver_processed_at", utc).withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in _DATES})


@register("global_signals", O.sql(["silver"], """
SELECT commodity_shock_flag, news_risk_level, news_risk_score_global, COUNT(*) AS lines
FROM silver GROUP BY 1, 2, 3"""))
def q_global_signals(spark, sf_dir):
    return silver(spark, sf_dir, S.SIGNAL_COLUMNS).groupBy("commodity_shock_flag", "news_risk_level", "news_risk_score_global") \
                                .agg(F.count(F.lit(1)).alias("lines"))


@register("null_defaults", O.sql(["silver"], """
SELECT order_country, customer_state, lpi_score, logistics_risk_tier, infrastructure_score, timeliness_score,
       supplier_risk_flag, weather_risk_score, storm_event_count, high_critical_storm_count, COUNT(*) AS lines
FROM silver
GROUP BY ALL"""))
def q_null_defaults(spark, sf_dir):
    cols = ["order_country", "customer_state", *S.COUNTRY_COLUMNS, *S.WEATHER_COLUMNS]
    df = S.silver(bronze(spark, sf_dir), columns=cols)
    return df.groupBy("order_country", "customer_state", "lpi_score", "logistics_risk_tier",
                      "infrastructure_score", "timeliness_score", "supplier_risk_flag", "weather_risk_score",
                      "storm_event_count", "high_critical_storm_count").agg(F.count(F.lit(1)).alias("lines"))


# ---------------------------------------------------------------------------
# Bronze-side reports (P*, Q*, G1, T5, T7, U1)
# ---------------------------------------------------------------------------
@register("weather_select", O.sql(["weather"], "SELECT event_id, state, event_type, severity_score, severity_label FROM weather"))
def q_weather_select(spark, sf_dir):
    return TestTables.shared(spark, sf_dir).weather_events().select(
        "event_id", "state", "event_type", "severity_score", "severity_label")


@register("weather_severity", O.sql(["weather"], """
SELECT event_type, severity_score, severity_label, COUNT(*) AS events FROM weather GROUP BY 1, 2, 3"""))
def q_weather_severity(spark, sf_dir):
    return TestTables.shared(spark, sf_dir).weather_events() \
        .groupBy("event_type", "severity_score", "severity_label").agg(F.count(F.lit(1)).alias("events"))


@register("dist_event", O.sql(["weather"], f"""
SELECT event_type, COUNT(*) AS count FROM weather GROUP BY event_type
ORDER BY count DESC, event_type ASC NULLS FIRST LIMIT {K.TOP_K}"""))
def q_dist_event(spark, sf_dir):
    return G.value_distribution(TestTables.shared(spark, sf_dir).weather_events(), ["event_type"], top=K.TOP_K)


@register("dist_severity", O.sql(["weather"], """
SELECT severity_label, severity_score, COUNT(*) AS count FROM weather GROUP BY 1, 2"""))
def q_dist_severity(spark, sf_dir):
    return G.value_distribution(TestTables.shared(spark, sf_dir).weather_events(), ["severity_label", "severity_score"],
                                order_by=[F.col("severity_score").desc()])


@register("dist_state", O.sql(["weather"], f"""
SELECT state, COUNT(*) AS count FROM weather GROUP BY state
ORDER BY count DESC, state ASC NULLS FIRST LIMIT {K.TOP_K}"""))
def q_dist_state(spark, sf_dir):
    return G.value_distribution(TestTables.shared(spark, sf_dir).weather_events(), ["state"], top=K.TOP_K)


@register("dist_mode", O.sql(["shipping"], "SELECT shipping_mode, COUNT(*) AS count FROM shipping GROUP BY 1"))
def q_dist_mode(spark, sf_dir):
    return G.value_distribution(TestTables.shared(spark, sf_dir).shipping_events(with_product=False), ["shipping_mode"])


@register("dist_market", O.sql(["shipping"], "SELECT market, COUNT(*) AS count FROM shipping GROUP BY 1"))
def q_dist_market(spark, sf_dir):
    return G.value_distribution(TestTables.shared(spark, sf_dir).shipping_events(with_product=False), ["market"])


@register("dist_delivery_status", O.sql(["shipping"], "SELECT delivery_status, COUNT(*) AS count FROM shipping GROUP BY 1"))
def q_dist_delivery_status(spark, sf_dir):
    return G.value_distribution(TestTables.shared(spark, sf_dir).shipping_events(with_product=False), ["delivery_status"])


@register("dist_tier", O.sql(["country_scores"], "SELECT logistics_risk_tier, COUNT(*) AS count FROM country_scores GROUP BY 1"))
def q_dist_tier(spark, sf_dir):
    return G.value_distribution(TestTables.shared(spark, sf_dir).supplier_risk(), ["logistics_risk_tier"])


@register("dq_shipping", O.sql(["shipping", "lines"], """
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE order_id IS NULL) AS null_order_id,
       COUNT(*) FILTER (WHERE delivery_status IS NULL) AS null_delivery_status,
       COUNT(*) FILTER (WHERE order_date IS NULL) AS null_order_date,
       COUNT(*) FILTER (WHERE late_delivery_risk = 1) AS late_rows,
       COUNT(*) FILTER (WHERE late_delivery_risk = 0) AS on_time_rows,
       """ + O.half_up("CAST(COUNT(*) FILTER (WHERE late_delivery_risk = 1) AS HUGEINT) * 100", "COUNT(*)", 1) + """ AS late_pct,
       """ + O.half_up("CAST(COUNT(*) FILTER (WHERE late_delivery_risk = 0) AS HUGEINT) * 100", "COUNT(*)", 1) + """ AS on_time_pct
FROM lines"""))
def q_dq_shipping(spark, sf_dir):
    return Q.shipping_check(TestTables.shared(spark, sf_dir).shipping_events(with_product=False))


@register("dq_weather", O.sql(["weather"], f"""
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE state IS NULL) AS null_state,
       COUNT(*) FILTER (WHERE event_type IS NULL) AS null_event_type,
       COUNT(*) FILTER (WHERE severity_score >= {K.SEVERE_STORM_AT}) AS severe_events
FROM weather"""))
def q_dq_weather(spark, sf_dir):
    return Q.weather_check(TestTables.shared(spark, sf_dir).weather_events())


@register("dq_silver", O.sql(["silver"], """
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE is_delayed = 1) AS delayed_rows,
       """ + O.half_up("CAST(COUNT(*) FILTER (WHERE is_delayed = 1) AS HUGEINT) * 100", "COUNT(*)", 1) + """ AS delayed_pct,
       COUNT(*) FILTER (WHERE supplier_risk_flag = 1) AS high_risk_supplier_rows,
       """ + O.half_up("CAST(COUNT(*) FILTER (WHERE supplier_risk_flag = 1) AS HUGEINT) * 100", "COUNT(*)", 1) + """ AS high_risk_supplier_pct,
       COUNT(*) FILTER (WHERE commodity_shock_flag = 1) AS shock_rows,
       """ + O.half_up("CAST(COUNT(*) FILTER (WHERE commodity_shock_flag = 1) AS HUGEINT) * 100", "COUNT(*)", 1) + """ AS shock_pct
FROM silver"""))
def q_dq_silver(spark, sf_dir):
    return Q.silver_check(silver(spark, sf_dir, ["is_delayed", "supplier_risk_flag", "commodity_shock_flag"]))


@register("row_preview", O.sql(["lines"], f"""
SELECT order_id, line_number, market, shipping_mode, delay_days, is_delayed, order_profit FROM lines
ORDER BY order_id, line_number LIMIT {K.TOP_K}"""))
def q_row_preview(spark, sf_dir):
    return T.preview(lines(spark, sf_dir).select("order_id", "line_number", "market", "shipping_mode", "delay_days",
                                                 "is_delayed", "order_profit"), ["order_id", "line_number"])


# The order lines' columns in their order; the types are read from the SQL's own table.
_LINE_COLUMNS = [
    "order_id", "line_number", "order_date", "shipping_date", "days_real", "days_scheduled", "delivery_status",
    "shipping_mode", "market", "order_country", "order_region", "customer_segment", "customer_state",
    "product_name", "sales", "order_profit", "late_delivery_risk"]
_TYPE_NAMES = ("CASE typeof(any_value({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DATE' THEN 'date' "
               "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' END")


@register("schema_profile", O.sql(["lines"], "\nUNION ALL ".join(
    f"SELECT {i} AS position, {O.q(c)} AS column_name, {_TYPE_NAMES.format(c=c)} AS data_type, COUNT({c}) AS non_null "
    "FROM (SELECT l.*, p_name AS product_name FROM lines l JOIN part ON partkey = p_partkey) t"
    for i, c in enumerate(_LINE_COLUMNS))))
def q_schema_profile(spark, sf_dir):
    """All columns of the order lines."""
    return Q.schema_profile(bronze(spark, sf_dir, with_product=True).shipping)


@register("row_parity", O.sql(["enriched", "shipping"], """
SELECT 'shipping' AS stage, COUNT(*) AS rows FROM shipping
UNION ALL SELECT 'silver', COUNT(*) FROM enriched"""))
def q_row_parity(spark, sf_dir):
    b = bronze(spark, sf_dir)
    return Q.row_parity({"shipping": b.shipping, "silver": S.silver(b)})


@register("scan_all", O.sql(["shipping", "suppliers", "country_scores", "weather", "commodity", "news"], """
SELECT 'shipping_events' AS table_name, COUNT(*) AS rows FROM shipping
UNION ALL SELECT 'supplier_master', COUNT(*) FROM suppliers
UNION ALL SELECT 'supplier_risk', COUNT(*) FROM country_scores
UNION ALL SELECT 'weather_events', COUNT(*) FROM weather
UNION ALL SELECT 'commodity_prices', COUNT(*) FROM commodity
UNION ALL SELECT 'news_disruptions', COUNT(*) FROM news"""))
def q_scan_all(spark, sf_dir):
    b = bronze(spark, sf_dir)
    return Q.row_parity({"shipping_events": b.shipping, "supplier_master": b.suppliers,
                         "supplier_risk": b.country_scores, "weather_events": b.weather,
                         "commodity_prices": b.commodity, "news_disruptions": b.news},
                        name_col="table_name")


@register("commodity_shock", O.sql(["commodity"], f"""
SELECT metric_name, arg_max(value, (date, value)) AS latest_value, COUNT(*) AS observations,
       CAST(COALESCE(CASE WHEN arg_max(value, (date, value)) > {K.COMMODITY_SHOCK_ABOVE} THEN 1 ELSE 0 END, 0) AS INTEGER) AS shock_flag
FROM commodity WHERE value IS NOT NULL GROUP BY metric_name"""))
def q_commodity_shock(spark, sf_dir):
    return G.latest_by_series(TestTables.shared(spark, sf_dir).commodity_prices()).drop("latest_date")


@register("latest_prices", O.sql(["commodity"], f"""
SELECT strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date, value, series_id FROM commodity
ORDER BY commodity.date DESC, value DESC, series_id LIMIT {K.LATEST_PRICES_K}"""))
def q_latest_prices(spark, sf_dir):
    top = T.latest_rows(TestTables.shared(spark, sf_dir).commodity_prices(), "date", K.LATEST_PRICES_K,
                        tie_breakers=[F.col("value").desc(), F.col("series_id").asc()])
    return top.select(F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date"), "value", "series_id")


@register("series_profile", O.sql(["commodity"], """
SELECT series_id, COUNT(*) AS observations, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total_rows FROM commodity GROUP BY series_id"""))
def q_series_profile(spark, sf_dir):
    return Q.series_profile(TestTables.shared(spark, sf_dir).commodity_prices())


@register("series_union", O.sql(["commodity"], """
SELECT metric_name, series_id, COUNT(*) AS observations, min(value) AS min_value, max(value) AS max_value
FROM commodity WHERE value IS NOT NULL GROUP BY 1, 2"""))
def q_series_union(spark, sf_dir):
    prices = TestTables.shared(spark, sf_dir).commodity_prices().where(F.col("value").isNotNull())
    unioned = U.tag_series(prices.drop("metric_name"))
    return unioned.groupBy("metric_name", "series_id").agg(
        F.count(F.lit(1)).alias("observations"), F.min("value").alias("min_value"), F.max("value").alias("max_value"))


# ---------------------------------------------------------------------------
# News (W2, U3, F9, F10, G15)
# ---------------------------------------------------------------------------
@register("news_dedup", O.sql(["news"], """
SELECT title, feed_order, source, query_used FROM news
WHERE feed_order IN (SELECT min(feed_order) FROM news GROUP BY title)"""))
def q_news_dedup(spark, sf_dir):
    news = TestTables.shared(spark, sf_dir).news_disruptions().select("title", "feed_order", "source", "query_used")
    return first_per_key(news, ["title"], ["feed_order"])


@register("news_scores", O.sql(["news_scored"], "SELECT title, feed_order, news_risk_score FROM news_scored"))
def q_news_scores(spark, sf_dir):
    news = S.dedup_news(TestTables.shared(spark, sf_dir).news_disruptions())
    return S.score_news(news, TEST_NEWS_KEYWORDS.level3, TEST_NEWS_KEYWORDS.level2) \
        .select("title", "feed_order", "news_risk_score")


@register("news_level", O.sql(["news_sum"], "SELECT articles, avg_news_risk, news_risk_level FROM news_sum"))
def q_news_level(spark, sf_dir):
    return S.news_summary(bronze(spark, sf_dir))


@register("news_by_query", O.sql(["news"], """
SELECT query_used, COUNT(*) AS count FROM news
WHERE feed_order IN (SELECT min(feed_order) FROM news GROUP BY title) GROUP BY 1"""))
def q_news_by_query(spark, sf_dir):
    return G.value_distribution(S.dedup_news(TestTables.shared(spark, sf_dir).news_disruptions()), ["query_used"])


# ---------------------------------------------------------------------------
# Raw records as text (S1, S4, S5): written from the tables' values, with every odd form
# that the formats know, then parsed; the SQL gives the values themselves.
# ---------------------------------------------------------------------------
def _kind(order: str, n: int) -> str:
    return f"pmod({order}, {n}) = 0"


@register("parsed_order_lines", O.sql(["lines"], """
SELECT order_id % 10 AS part, CASE WHEN order_id % 7 = 0 THEN NULL ELSE CAST(order_id AS INTEGER) END AS order_id,
       CAST(line_number AS INTEGER) AS line_number, days_real, late_delivery_risk, market,
       CASE WHEN order_id % 11 = 0 THEN 'The "' || order_country || '", ' || order_region ELSE order_country END AS order_country,
       CASE WHEN order_id % 13 = 0 THEN NULL ELSE order_region END AS order_region,
       CASE WHEN order_id % 13 = 0 THEN NULL ELSE shipping_mode END AS shipping_mode,
       CASE WHEN order_id % 13 = 0 THEN NULL ELSE order_profit END AS order_profit, sales,
       order_id % 7 = 0 OR order_id % 13 = 0 AS bad
FROM lines"""))
def q_parsed_order_lines(spark, sf_dir):
    """Order lines as text lines, quoted, short, and with bad numbers, read back."""
    text = {src: F.col(dst).cast("string") for src, dst in SC.SHIPPING_ROLES.items()}
    text["Order_Id"] = F.when(F.expr(_kind("order_id", 7)), "n/a").otherwise(text["Order_Id"])
    quoted = F.concat(F.lit('"The ""'), F.col("order_country"), F.lit('"", '), F.col("order_region"), F.lit('"'))
    text["Order_Country"] = F.when(F.expr(_kind("order_id", 11)), quoted).otherwise(F.col("order_country"))
    names = [n for n, _ in SC.SHIPPING_CSV_COLUMNS]
    empty = F.lit("")

    def line(columns: list[str]) -> F.Column:
        return F.concat_ws(",", *[F.coalesce(text.get(n, empty), empty) for n in columns])
    short = line(names[:names.index("Order_Profit_Per_Order")])
    rows = lines(spark, sf_dir).withColumn("product_name", F.lit(None).cast("string")).select(
        F.pmod("order_id", F.lit(10)).alias("part"),
        F.when(F.expr(_kind("order_id", 13)), short).otherwise(line(names)).alias("line"))
    return ROWS.parse_order_lines(rows, "line").select(
        "part", "order_id", "line_number", "days_real", "late_delivery_risk", "market", "order_country", "order_region",
        "shipping_mode", "order_profit", "sales", "bad")


@register("parsed_news", """
SELECT doc_id, false AS bad, 0 AS item, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'Nr. ' || doc_id END AS title,
       length(text) AS chars, sha256(text) AS summary_sha256, CASE WHEN doc_id % 3 = 0 THEN 'Unknown' ELSE source END AS source
FROM documents WHERE doc_id % 9 <> 0
UNION ALL SELECT doc_id, false, 1, '007', 0, sha256(''), 'Unknown' FROM documents WHERE doc_id % 9 <> 0
UNION ALL SELECT doc_id, true, NULL, NULL, NULL, NULL, NULL FROM documents WHERE doc_id % 9 = 0""")
def q_parsed_news(spark, sf_dir):
    """Documents as RSS feeds, some without title or source, some broken off, read back."""
    d = TestTables.shared(spark, sf_dir).raw("documents").select("doc_id", "text", "source")

    def escaped(c: str) -> F.Column:
        return F.replace(F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    title = F.when(F.expr(_kind("doc_id", 5)), "").otherwise(F.concat(F.lit("<title>Nr. "), F.col("doc_id").cast("string"), F.lit("</title>")))
    source = F.when(F.expr(_kind("doc_id", 3)), "").otherwise(
        F.concat(F.lit('<source url="http://x/?a=1&amp;b=2">'), escaped("source"), F.lit("</source>")))
    first = F.concat(F.lit("<item>"), title, F.lit("<description>"), escaped("text"), F.lit("</description>"), source, F.lit("</item>"))
    feed = F.concat(F.lit("<rss><channel><link>x</link>"), first, F.when(F.expr(_kind("doc_id", 9)), "<item>").otherwise(
        "<item><title>007</title></item></channel></rss>"))
    items = ROWS.parse_feeds(d.select("doc_id", feed.alias("feed")), "feed")
    return items.select("doc_id", "bad", "item", "title", F.length("summary").alias("chars"),
                        F.sha2(F.col("summary").cast("binary"), 256).alias("summary_sha256"), "source")


@register("parsed_prices", """
SELECT event_id, false AS bad, strftime(ts, '%Y-%m-%d') AS date, CASE WHEN event_id % 6 = 0 THEN NULL ELSE value END AS value
FROM events WHERE event_id % 10 <> 0 AND value IS NOT NULL
UNION ALL SELECT event_id, false, 'x', 2.5 FROM events WHERE event_id % 10 <> 0
UNION ALL SELECT event_id, true, NULL, NULL FROM events WHERE event_id % 10 = 0""")
def q_parsed_prices(spark, sf_dir):
    """Events as price documents with missing and bad values, some broken off, read back."""
    ev = TestTables.shared(spark, sf_dir).raw("events").select("event_id", "ts", "value")
    value = F.when(F.expr(_kind("event_id", 6)), "1,5").otherwise(F.col("value").cast("string"))
    seen = F.array(F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), value.alias("value")),
                   F.struct(F.lit("y").alias("date"), F.lit(".").alias("value")),
                   F.struct(F.lit("x").alias("date"), F.lit("2.5").alias("value")))
    whole = F.to_json(F.struct(F.filter(seen, lambda o: o["value"].isNotNull()).alias("observations")))
    text = F.when(F.expr(_kind("event_id", 10)), F.concat(F.lit('{"observations": ['), F.col("event_id").cast("string"))).otherwise(whole)
    return ROWS.parse_prices(ev.select("event_id", text.alias("document")), "document")


def queries() -> dict[str, Query]:
    from chainsight.plans import catalog_ml  # noqa: F401  (registers the model queries)
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from chainsight.plans import catalog_ml  # noqa: F401
    return dict(ORACLE_SQL)
