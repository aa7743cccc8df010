"""Set operations.

U2 (several yearly files in one scan) is a multi-path read in
``sources.files.read_weather``; U3 (keep the first row per title) is
``operators.windows.first_per_key``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tag_series(prices: DataFrame, names: Mapping[str, str] | None = None, series_col: str = "series_id",
               tag_col: str = "metric_name") -> DataFrame:
    """The union of all series as one scan, each row tagged with its metric name.

    ``names`` maps series ids to metric names; a series that it doesn't name (or any,
    without ``names``) keeps its id, so that no series is lost."""
    if not names:
        return prices.withColumn(tag_col, F.col(series_col))
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return prices.withColumn(tag_col, F.coalesce(F.try_element_at(lookup, F.col(series_col)), F.col(series_col)))
