"""Row-level feature expressions.

Every function returns a ``Column`` built only from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen.  Arguments are column names or
Columns, so the same expression works on the raw-file schema and on the
test-table adapter.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainsight.functions import constants as K


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# F1
def delay_days(real: str | Column = "days_real", scheduled: str | Column = "days_scheduled") -> Column:
    """Real minus scheduled shipping days; NULL when either is NULL."""
    return _c(real) - _c(scheduled)


# F2
def is_delayed(delay: str | Column = "delay_days") -> Column:
    """1 when the delay is positive, else 0 (NULL -> 0)."""
    return F.when(_c(delay) > 0, F.lit(1)).otherwise(F.lit(0))


# F3
def profit_margin_flag(profit: str | Column = "order_profit") -> Column:
    """1 for a loss-making line, else 0 (NULL -> 0)."""
    return F.when(_c(profit) < 0, F.lit(1)).otherwise(F.lit(0))


# F4
def route_key(country: str | Column = "order_country", region: str | Column = "order_region") -> Column:
    """``country_region``; NULL parts are skipped by concat_ws."""
    return F.concat_ws("_", _c(country), _c(region))


# F5
def supplier_risk_flag(tier: str | Column = "logistics_risk_tier") -> Column:
    """1 when the order country's logistics tier is high risk (NULL -> 0)."""
    return F.when(_c(tier).isin(*K.HIGH_RISK_TIERS), F.lit(1)).otherwise(F.lit(0))


# F6
def severity_score(event_type: str | Column = "event_type") -> Column:
    """Storm severity 5..2 by event-type class, else 1."""
    expr = None
    for score, types in K.SEVERITY_CLASSES:
        cond = _c(event_type).isin(*types)
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    return expr.otherwise(F.lit(K.SEVERITY_DEFAULT))


# F7
def severity_label(score: str | Column = "severity_score") -> Column:
    expr = None
    for value, label in K.SEVERITY_LABELS:
        cond = _c(score) == value
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(K.SEVERITY_LABEL_DEFAULT))


# F8
def logistics_tier(score: str | Column = "lpi_score") -> Column:
    """Right-closed bins (0,2.5], (2.5,3], (3,3.5], (3.5,4], (4,5]; outside -> NULL."""
    s = _c(score)
    expr = None
    for upper, label in K.LPI_TIER_BINS:
        cond = s <= upper
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    in_range = (s > K.LPI_TIER_LOW) & (s <= K.LPI_TIER_BINS[-1][0])
    return F.when(in_range, expr)


def keyword_regex(words: Iterable[str]) -> str:
    """Case-insensitive alternation matching any word as a substring."""
    return "(?i)(" + "|".join(re.escape(w) for w in words) + ")"


# F9
def news_title_score(title: str | Column = "title",
                     level3: Sequence[str] = K.NEWS_LEVEL3_KEYWORDS,
                     level2: Sequence[str] = K.NEWS_LEVEL2_KEYWORDS) -> Column:
    """3 if any level-3 keyword occurs, else 2 for a level-2 keyword, else 1."""
    t = _c(title)
    return (F.when(t.rlike(keyword_regex(level3)), F.lit(3))
            .when(t.rlike(keyword_regex(level2)), F.lit(2))
            .otherwise(F.lit(1)))


# F10
def news_level(mean_score: str | Column) -> Column:
    """HIGH from 2.5, MEDIUM from 1.5, else LOW (also for an empty feed)."""
    m = _c(mean_score)
    return (F.when(m >= K.NEWS_HIGH_AT, F.lit("HIGH"))
            .when(m >= K.NEWS_MEDIUM_AT, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


# F11 (row form; the aggregate lives in operators.aggregates.commodity_shock)
def shock_flag(latest_price: str | Column, above: float = K.COMMODITY_SHOCK_ABOVE) -> Column:
    """1 when the latest price is strictly above the threshold; no price -> 0."""
    return F.coalesce(F.when(_c(latest_price) > above, F.lit(1)).otherwise(F.lit(0)), F.lit(0))


def _code(col: Column, pairs, default: float) -> Column:
    expr = None
    for key, code in pairs:
        cond = col == key
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.otherwise(F.lit(default))


# F12
def news_risk_numeric(level: str | Column = "news_risk_level") -> Column:
    return _code(_c(level), K.NEWS_LEVEL_CODES, K.NEWS_LEVEL_CODE_DEFAULT)


# F13
def lpi_risk_numeric(tier: str | Column = "logistics_risk_tier") -> Column:
    return _code(_c(tier), K.LPI_TIER_CODES, K.LPI_TIER_CODE_DEFAULT)


# F14
def correct(actual: str | Column = "actual_risk", predicted: str | Column = "predicted_risk") -> Column:
    """1 when the prediction equals the label (NULL -> 0)."""
    return F.when(_c(actual) == _c(predicted), F.lit(1)).otherwise(F.lit(0))


# F15
def market_band(delay_rate_pct: str | Column = "delay_rate_pct") -> Column:
    return F.when(_c(delay_rate_pct) > K.MARKET_BAND_ABOVE, F.lit("HIGH")).otherwise(F.lit("MEDIUM"))


def lpi_width_pct(avg_lpi: str | Column = "avg_lpi_score") -> Column:
    """LPI as a whole percent of the 5-point scale."""
    return F.round(_c(avg_lpi) / K.LPI_SCALE_MAX * 100, 0).cast("int")


def sales_millions(sales: str | Column, decimals: int = 2) -> Column:
    """``$x.xxM``; rounded half-up in decimal so the text is exact."""
    m = F.round(_c(sales).cast("decimal(38,6)") / F.lit(1_000_000), decimals)
    return F.concat(F.lit("$"), m.cast("string"), F.lit("M"))


# F16
def clean_key(c: str | Column) -> Column:
    return F.trim(_c(c))


def clean_upper_key(c: str | Column) -> Column:
    return F.upper(F.trim(_c(c)))


# F17
def supplier_number(supplier_id: str | Column = "supplier_id") -> Column:
    """Numeric part of ``SUP-000123``; malformed ids give NULL (never raise)."""
    return F.regexp_extract(_c(supplier_id), K.SUPPLIER_ID_PATTERN, 1).try_cast("int")


# F18
def supplier_assignment(order_id: str | Column, low: Column, span: Column) -> Column:
    """Deterministic supplier number ``pmod(order_id, span) + low``."""
    return (F.pmod(_c(order_id), span) + low).cast("int")


# F19
def label(col: str | Column = "late_delivery_risk") -> Column:
    return _c(col).cast("double")
