"""Sorts, limits and top-k lists.

Every list orders by its measure and then by its grouping keys, so ties are
broken the same way on every run.  ``orderBy(...).limit(k)`` is planned as
``TakeOrderedAndProject``: each task keeps its own k best rows and only those
reach the final merge, so no full sort of the input happens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainsight.functions import constants as K

SUPPLIER_KEYS = ("supplier_name", "supplier_tier", "supplier_region")
ROUTE_KEYS = ("order_country", "order_region", "shipping_mode")


def _keys_asc(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).asc_nulls_first() for k in keys]


# T2
def best_suppliers(board: DataFrame, k: int = K.TOP_K) -> DataFrame:
    return board.orderBy(F.col("delay_rate_pct").asc_nulls_first(), *_keys_asc(SUPPLIER_KEYS)).limit(k)


def worst_suppliers(board: DataFrame, k: int = K.TOP_K) -> DataFrame:
    return board.orderBy(F.col("delay_rate_pct").desc_nulls_last(), *_keys_asc(SUPPLIER_KEYS)).limit(k)


# T3 + P8
def riskiest_routes(routes: DataFrame, predicate: str, k: int = K.TOP_K) -> DataFrame:
    """Routes passing a SQL predicate (e.g. ``shipping_mode != 'First Class'``,
    which also drops NULL modes), riskiest first."""
    return (routes.filter(predicate)
            .orderBy(F.col("delay_rate_pct").desc(), F.col("order_count").desc(), *_keys_asc(ROUTE_KEYS))
            .limit(k))


# T5
def latest_rows(df: DataFrame, date_col: str, k: int = K.LATEST_PRICES_K,
                tie_breakers: Sequence[Column] = ()) -> DataFrame:
    return df.orderBy(F.col(date_col).desc(), *tie_breakers).limit(k)


# P11
def preview(df: DataFrame, keys: Sequence[str], k: int = K.TOP_K) -> DataFrame:
    """The first ``k`` rows by a key that identifies a row."""
    return df.orderBy(*keys).limit(k)


# T6
def top_importances(importances: DataFrame, k: int = K.TOP_K) -> DataFrame:
    return importances.orderBy(F.col("importance").desc(), F.col("feature").asc()).limit(k)
