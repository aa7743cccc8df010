"""DuckDB SQL for every oracle-checked query in ``plans.catalog``.

The SQL is written independently of the Spark code: the role tables, silver
table and marts are rebuilt from the pre-registered test views (region nation
customer supplier part orders lineitem events documents ...).  Only the
fixed values (keyword lists, event classes, thresholds) are shared, taken
from ``functions.constants``.

Rounded means and sums are computed from whole-number or ten-decimal sums with
half-up integer division; no value is rounded before it is summed.
"""

from __future__ import annotations

from chainsight.functions import constants as K
from chainsight.sources.tables import TEST_NEWS_KEYWORDS, TEST_OIL_METRIC


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return ", ".join(q(v) for v in values)


def half_up(num: str, den: str, places: int) -> str:
    """round(num / den, places) half away from zero, from integers."""
    p = 10 ** places
    return (f"(CAST(sign({num}) * ((2 * {p} * abs({num}) + ({den})) // NULLIF(2 * ({den}), 0)) AS DOUBLE) / {p})")


def half_up_text(num: str, den: str, places: int) -> str:
    """num / den rounded half away from zero to ``places`` decimals, as text."""
    p = 10 ** places
    k = f"((2 * {p} * abs(CAST({num} AS HUGEINT)) + CAST({den} AS HUGEINT)) // (2 * CAST({den} AS HUGEINT)))"
    sign = f"(CASE WHEN ({num}) < 0 AND {k} > 0 THEN '-' ELSE '' END)"
    body = (f"CAST({k} AS VARCHAR)" if places == 0 else
            f"CAST({k} // {p} AS VARCHAR) || '.' || lpad(CAST({k} % {p} AS VARCHAR), {places}, '0')")
    return f"(CASE WHEN ({den}) <> 0 THEN {sign} || {body} END)"


def exact_mean(expr: str, places: int, times: int = 1) -> str:
    """Mean of whole numbers."""
    return half_up(f"(CAST(SUM(CAST({expr} AS BIGINT)) AS HUGEINT) * {times})", f"COUNT({expr})", places)


TENTHS = 10 ** 10  # a value's unit in sums: its tenth decimal


def units(expr: str) -> str:
    """Sum of any numbers in units of the tenth decimal."""
    return f"CAST(SUM(CAST(({expr}) AS DECIMAL(28,10))) * {TENTHS} AS HUGEINT)"


def decimal_mean(expr: str, places: int) -> str:
    return half_up(units(expr), f"(CAST(COUNT({expr}) AS HUGEINT) * {TENTHS})", places)


def exact_sum(expr: str, places: int) -> str:
    return half_up(units(expr), f"CAST({TENTHS} AS HUGEINT)", places)


def severity_case(col: str) -> str:
    parts = " ".join(f"WHEN {col} IN ({in_list(types)}) THEN {score}" for score, types in K.SEVERITY_CLASSES)
    return f"CASE {parts} ELSE {K.SEVERITY_DEFAULT} END"


def severity_label_case(col: str) -> str:
    parts = " ".join(f"WHEN {col} = {v} THEN {q(l)}" for v, l in K.SEVERITY_LABELS)
    return f"CASE {parts} ELSE {q(K.SEVERITY_LABEL_DEFAULT)} END"


def tier_case(col: str) -> str:
    parts = " ".join(f"WHEN {col} <= {u} THEN {q(l)}" for u, l in K.LPI_TIER_BINS)
    return (f"CASE WHEN {col} > {K.LPI_TIER_LOW} AND {col} <= {K.LPI_TIER_BINS[-1][0]} "
            f"THEN CASE {parts} END END")


def regex(words) -> str:
    import re
    return "(?i)(" + "|".join(re.escape(w) for w in words) + ")"


def news_score_case(col: str) -> str:
    return (f"CASE WHEN regexp_matches({col}, {q(regex(TEST_NEWS_KEYWORDS.level3))}) THEN 3 "
            f"WHEN regexp_matches({col}, {q(regex(TEST_NEWS_KEYWORDS.level2))}) THEN 2 ELSE 1 END")


def news_level_case(col: str) -> str:
    return (f"CASE WHEN {col} >= {K.NEWS_HIGH_AT} THEN 'HIGH' WHEN {col} >= {K.NEWS_MEDIUM_AT} "
            f"THEN 'MEDIUM' ELSE 'LOW' END")


# --- role tables ------------------------------------------------------------
ROLE_CTES = {
    "shipping": f"""
shipping AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number,
         CAST(o.o_orderdate AS DATE) AS order_date, CAST(l.l_shipdate AS DATE) AS shipping_date,
         CAST(1 + abs(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE))) % 7 AS INTEGER) AS days_real,
         CAST(CASE o.o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END AS INTEGER) AS days_scheduled,
         l.l_returnflag AS returnflag, l.l_linestatus AS delivery_status, o.o_orderpriority AS shipping_mode,
         c.c_mktsegment AS market, n.n_name AS order_country, r.r_name AS order_region,
         o.o_orderstatus AS customer_segment, '  s' || CAST(c.c_nationkey AS VARCHAR) || ' ' AS customer_state,
         l.l_extendedprice AS sales, l.l_partkey AS partkey,
         CAST(round(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (CAST(0.05 AS DECIMAL(18,2)) - CAST(l.l_discount AS DECIMAL(18,2))), 2) AS DOUBLE) AS order_profit
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)""",
    "lines": """
lines AS (
  SELECT order_id, line_number, order_date, shipping_date, days_real, days_scheduled,
         delivery_status, shipping_mode, market, order_country, order_region, customer_segment,
         customer_state, sales, order_profit, partkey,
         CAST(CASE WHEN days_real > days_scheduled AND returnflag <> 'R' THEN 1 ELSE 0 END AS INTEGER) AS late_delivery_risk,
         days_real - days_scheduled AS delay_days,
         CASE WHEN days_real - days_scheduled > 0 THEN 1 ELSE 0 END AS is_delayed,
         concat_ws('_', order_country, order_region) AS route_key,
         CASE WHEN order_profit < 0 THEN 1 ELSE 0 END AS profit_margin_flag
  FROM shipping
)""",
    "suppliers": """
suppliers AS (
  SELECT 'SUP-' || CASE WHEN length(CAST(2 * s.s_suppkey + 1 AS VARCHAR)) >= 6 THEN CAST(2 * s.s_suppkey + 1 AS VARCHAR)
                        ELSE lpad(CAST(2 * s.s_suppkey + 1 AS VARCHAR), 6, '0') END AS supplier_id,
         s.s_name AS supplier_name, n.n_name AS country, n.n_name AS country_code, r.r_name AS region,
         CAST(1 + s.s_suppkey % 3 AS INTEGER) AS tier,
         CAST(10 + s.s_suppkey % 30 AS INTEGER) AS lead_time_days,
         CAST(40 + s.s_suppkey % 60 AS DOUBLE) AS quality_score,
         CAST(20 + s.s_suppkey % 80 AS DOUBLE) AS esg_score,
         CASE WHEN s.s_acctbal < 0 THEN 'negative balance' END AS risk_notes
  FROM supplier s
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)""",
    "sup_keyed": f"""
sup_keyed AS (
  SELECT TRY_CAST(regexp_extract(supplier_id, {q(K.SUPPLIER_ID_PATTERN)}, 1) AS INTEGER) AS sup_key,
         supplier_name, tier AS supplier_tier, region AS supplier_region, country_code AS supplier_country_code,
         lead_time_days, quality_score AS supplier_quality_score, esg_score AS supplier_esg_score,
         risk_notes AS supplier_risk_notes
  FROM suppliers
)""",
    "sup_range": """
sup_range AS (SELECT min(sup_key) AS low, max(sup_key) - min(sup_key) + 1 AS span FROM sup_keyed)""",
    "country_scores": f"""
country_scores AS (
  SELECT country, country_code, region, lpi_score, infrastructure_score, timeliness_score,
         {tier_case('lpi_score')} AS logistics_risk_tier
  FROM (
    SELECT CASE WHEN n.n_nationkey % 5 = 4 THEN 'The ' || n.n_name ELSE n.n_name END AS country,
           n.n_name AS country_code, r.r_name AS region,
           CAST(24 + n.n_nationkey AS DOUBLE) / 10.0 AS lpi_score,
           CAST(24 + n.n_nationkey AS DOUBLE) / 10.0 - 0.2 AS infrastructure_score,
           CAST(24 + n.n_nationkey AS DOUBLE) / 10.0 + 0.2 AS timeliness_score
    FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  ) t
)""",
    "weather": f"""
weather AS (
  SELECT event_id, state, event_type, severity_score, {severity_label_case('severity_score')} AS severity_label
  FROM (
    SELECT event_id, state, event_type, {severity_case('event_type')} AS severity_score
    FROM (
      SELECT CAST(event_id AS VARCHAR) AS event_id, 'S' || CAST(user_id % 20 AS VARCHAR) AS state,
             CASE event_type WHEN 'error' THEN 'Hurricane' WHEN 'signup' THEN 'Tornado'
                             WHEN 'purchase' THEN 'Flood' WHEN 'click' THEN 'High Wind'
                             WHEN 'view' THEN 'Other' END AS event_type
      FROM events
    ) a
  ) b
)""",
    "commodity": """
commodity AS (SELECT ts AS date, value, event_type AS series_id, event_type AS metric_name FROM events)""",
    "news": """
news AS (
  SELECT text AS title, source, lang AS query_used, doc_id AS feed_order
  FROM documents
)""",
    "news_dedup": """
news_dedup AS (
  SELECT title, min(feed_order) AS feed_order FROM news GROUP BY title
)""",
    "news_scored": f"""
news_scored AS (
  SELECT title, feed_order, {news_score_case('title')} AS news_risk_score FROM news_dedup
)""",
    "news_sum": f"""
news_sum AS (
  SELECT COUNT(*) AS articles, avg(news_risk_score) AS avg_news_risk, {news_level_case('avg(news_risk_score)')} AS news_risk_level
  FROM news_scored
)""",
    "shock": f"""
shock AS (
  SELECT arg_max(value, (date, value)) AS latest_price,
         CAST(COALESCE(CASE WHEN arg_max(value, (date, value)) > {K.COMMODITY_SHOCK_ABOVE} THEN 1 ELSE 0 END, 0) AS INTEGER) AS commodity_shock_flag
  FROM commodity WHERE metric_name = {q(TEST_OIL_METRIC)} AND value IS NOT NULL
)""",
    "storm": f"""
storm AS (
  SELECT upper(trim(state)) AS state_key,
         {exact_mean('severity_score', 2)} AS weather_risk_score,
         COUNT(event_id) AS storm_event_count,
         COUNT(*) FILTER (WHERE severity_score >= {K.SEVERE_STORM_AT}) AS high_critical_storm_count
  FROM weather GROUP BY upper(trim(state))
)""",
    "routes": """
routes AS (
  SELECT order_country, order_region, shipping_mode,
         avg(is_delayed) AS route_delay_rate, avg(delay_days) AS route_avg_delay_days,
         COUNT(order_id) AS route_order_count
  FROM lines GROUP BY order_country, order_region, shipping_mode
)""",
    "enriched": f"""
enriched AS (
  SELECT l.*, s.supplier_name, s.supplier_tier, s.supplier_region, s.supplier_country_code,
         s.lead_time_days, s.supplier_quality_score, s.supplier_esg_score, s.supplier_risk_notes,
         cs.lpi_score, cs.logistics_risk_tier, cs.infrastructure_score, cs.timeliness_score,
         CASE WHEN cs.logistics_risk_tier IN ({in_list(K.HIGH_RISK_TIERS)}) THEN 1 ELSE 0 END AS supplier_risk_flag,
         COALESCE(st.weather_risk_score, 1.0) AS weather_risk_score,
         COALESCE(st.storm_event_count, 0) AS storm_event_count,
         COALESCE(st.high_critical_storm_count, 0) AS high_critical_storm_count,
         (SELECT commodity_shock_flag FROM shock) AS commodity_shock_flag,
         (SELECT news_risk_level FROM news_sum) AS news_risk_level,
         (SELECT avg_news_risk FROM news_sum) AS news_risk_score_global,
         rt.route_delay_rate, rt.route_avg_delay_days, rt.route_order_count
  FROM lines l
  CROSS JOIN sup_range sr
  LEFT JOIN sup_keyed s ON s.sup_key = CAST(((l.order_id % sr.span) + sr.span) % sr.span + sr.low AS INTEGER)
  LEFT JOIN country_scores cs ON trim(l.order_country) = trim(cs.country)
  LEFT JOIN storm st ON upper(trim(l.customer_state)) = st.state_key
  LEFT JOIN routes rt ON l.order_country = rt.order_country AND l.order_region = rt.order_region
                     AND l.shipping_mode = rt.shipping_mode
)""",
    "silver": """
silver AS (
  SELECT order_id, line_number, order_date, shipping_date, order_country, order_region, market, shipping_mode,
         customer_segment, late_delivery_risk, delivery_status, delay_days, is_delayed,
         profit_margin_flag,
         COALESCE(route_delay_rate, 0.5) AS route_delay_rate,
         COALESCE(route_avg_delay_days, 0.0) AS route_avg_delay_days,
         route_order_count, supplier_name, supplier_tier, supplier_region, supplier_country_code,
         lead_time_days, supplier_quality_score, supplier_esg_score, supplier_risk_notes,
         COALESCE(supplier_risk_flag, 0) AS supplier_risk_flag,
         COALESCE(lpi_score, 3.0) AS lpi_score,
         COALESCE(logistics_risk_tier, 'Medium Risk') AS logistics_risk_tier,
         COALESCE(infrastructure_score, 3.0) AS infrastructure_score,
         COALESCE(timeliness_score, 3.0) AS timeliness_score,
         weather_risk_score, storm_event_count, high_critical_storm_count, commodity_shock_flag,
         news_risk_level, news_risk_score_global, sales, order_profit, customer_state, partkey
  FROM enriched
)""",
}

# Dependencies between CTEs (in definition order).
_DEPS = {
    "shipping": [], "lines": ["shipping"], "suppliers": [], "sup_keyed": ["suppliers"],
    "sup_range": ["sup_keyed"], "country_scores": [], "weather": [], "commodity": [],
    "news": [], "news_dedup": ["news"], "news_scored": ["news_dedup"], "news_sum": ["news_scored"],
    "shock": ["commodity"], "storm": ["weather"], "routes": ["lines"],
    "enriched": ["lines", "sup_range", "sup_keyed", "country_scores", "storm", "shock", "news_sum", "routes"],
    "silver": ["enriched"],
}


def with_ctes(*names: str) -> str:
    """``WITH`` clause holding the named CTEs and everything they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",".join(ROLE_CTES[n] for n in order) + "\n"


def sql(ctes: list[str] | tuple[str, ...], body: str) -> str:
    return with_ctes(*ctes) + body.strip()
