"""De-duplication.

W1 (route rank) lives with the route mart in ``operators.aggregates``;
W3 (route statistics through windows) in ``operators.joins``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampType


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key by ``order`` (smallest first).

    Written as ``groupBy(keys).agg(min(struct(order..., rest...)))``: the
    minimum is partially aggregated before the shuffle, so a key that repeats
    across a third of the input costs one partial row per task instead of
    shipping all its rows to one task, as a ``row_number`` window would.  NULL
    keys form one group (pandas ``drop_duplicates`` treats NULLs as equal).
    The order columns must identify a row uniquely within a key for a
    deterministic pick; ``dropDuplicates`` would pick an arbitrary row.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not rest and len(order) == 1 and isinstance(df.schema[order[0]].dataType, (NumericType, DateType, TimestampType)):
        # one number is all there is to find: hash aggregation, so long keys aren't sorted
        first = F.when(F.bool_or(F.col(order[0]).isNull()), None).otherwise(F.min(order[0]))
        return df.groupBy(*keys).agg(first.alias(order[0])).select(*df.columns)
    packed = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("_first")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in [*order, *rest]]).select(*df.columns)
