"""Data-quality and profile reports.

Each report is one aggregate pass with ``count_if`` columns (the source runs
one job per number).  Percentages use ``try_divide`` so an empty input gives
NULL instead of a division error under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainsight.functions import constants as K
from chainsight.functions.exact import exact_pct


def _total() -> F.Column:
    return F.count(F.lit(1))


# Q1 + P3 + P4
def shipping_check(shipping: DataFrame) -> DataFrame:
    late = F.count_if(F.col("late_delivery_risk") == 1)
    on_time = F.count_if(F.col("late_delivery_risk") == 0)
    return shipping.agg(
        _total().alias("total_rows"),
        F.count_if(F.col("order_id").isNull()).alias("null_order_id"),
        F.count_if(F.col("delivery_status").isNull()).alias("null_delivery_status"),
        F.count_if(F.col("order_date").isNull()).alias("null_order_date"),
        late.alias("late_rows"),
        on_time.alias("on_time_rows"),
        exact_pct(late, _total()).alias("late_pct"),
        exact_pct(on_time, _total()).alias("on_time_pct"),
    )


# Q2 + P5
def weather_check(weather: DataFrame) -> DataFrame:
    return weather.agg(
        _total().alias("total_rows"),
        F.count_if(F.col("state").isNull()).alias("null_state"),
        F.count_if(F.col("event_type").isNull()).alias("null_event_type"),
        F.count_if(F.col("severity_score") >= K.SEVERE_STORM_AT).alias("severe_events"),
    )


# Q3
def silver_check(silver: DataFrame) -> DataFrame:
    delayed = F.count_if(F.col("is_delayed") == 1)
    risky = F.count_if(F.col("supplier_risk_flag") == 1)
    shock = F.count_if(F.col("commodity_shock_flag") == 1)
    return silver.agg(
        _total().alias("total_rows"),
        delayed.alias("delayed_rows"), exact_pct(delayed, _total()).alias("delayed_pct"),
        risky.alias("high_risk_supplier_rows"), exact_pct(risky, _total()).alias("high_risk_supplier_pct"),
        shock.alias("shock_rows"), exact_pct(shock, _total()).alias("shock_pct"),
    )


# Q4
def series_profile(prices: DataFrame, series_col: str = "series_id") -> DataFrame:
    """Observations per series with the table total alongside: a window over the
    aggregated series, of which there is one row each."""
    return (prices.groupBy(series_col).agg(_total().alias("observations"))
            .withColumn("total_rows", F.sum("observations").over(Window.partitionBy()))
            .orderBy(F.col("observations").desc(), series_col))


# Q5
def schema_profile(df: DataFrame) -> DataFrame:
    """Position, name, type and number of non-null values of each column, in one pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"),
                     F.col(f"_n{i}").alias("non_null")) for i, (name, kind) in enumerate(df.dtypes)]
    return counts.select(F.inline(F.array(*rows)))


# Q6 / K5
def row_parity(stages: Mapping[str, DataFrame], name_col: str = "stage") -> DataFrame:
    """Row count per named stage in one union plan (compare before/after joins)."""
    parts = [df.agg(_total().alias("rows")).select(F.lit(name).alias(name_col), "rows")
             for name, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
