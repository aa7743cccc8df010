"""Exact, order-independent rounded aggregates.

A double sum depends on the order rows arrive in, which changes with the
partitioning; rounding such a sum (or a mean built on it) to 1-2 places can
then flip the last digit between runs and engines.  These helpers sum whole
numbers as ``long`` and other numbers as ``decimal(38,10)``, without rounding a
value first, divide once per group in decimal and round half-up once, so a
mart's numbers are the same on any cluster layout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ten decimals of a value are summed: all that scores, prices and profits carry.
VALUE = "decimal(28,10)"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _rounded(num: Column, den: Column, places: int, as_double: bool) -> Column:
    q = F.round(F.try_divide(num, den.cast("decimal(20,0)")), places)
    return q.cast("double") if as_double else q


def exact_ratio(num: Column, den: Column, places: int, as_double: bool = True) -> Column:
    """``round(num / den, places)`` of whole numbers, half-up in decimal; NULL when
    ``den`` is 0.

    ``as_double=False`` keeps the decimal, whose text form has exactly
    ``places`` digits (used for the KPI strings).
    """
    return _rounded(num.cast("decimal(20,0)"), den, places, as_double)


def exact_mean(col: str | Column, places: int, times: int = 1) -> Column:
    """``round(avg(col) * times, places)`` of whole numbers; NULLs are skipped, like avg."""
    c = _c(col)
    num = F.sum(c.cast("long"))
    return exact_ratio(num * times if times != 1 else num, F.count(c), places)


def decimal_mean(col: str | Column, places: int) -> Column:
    """``round(avg(col), places)`` of any numbers; NULLs are skipped, like avg."""
    c = _c(col)
    return _rounded(F.sum(c.cast(VALUE)), F.count(c), places, True)


def exact_sum(col: str | Column, places: int, as_double: bool = True) -> Column:
    """``round(sum(col), places)`` of any numbers."""
    q = F.round(F.sum(_c(col).cast(VALUE)), places)
    return q.cast("double") if as_double else q


def exact_pct(flag_count: Column, total: Column, places: int = 1) -> Column:
    """Percent of ``total`` as ``round(100 * part / total, places)``."""
    return exact_ratio(flag_count * 100, total, places)


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` of non-negative whole numbers with ``num <= den``, to 18 decimals;
    NULL when ``den`` is 0."""
    return F.try_divide(num.cast("decimal(20,0)"), den.cast("decimal(20,0)")).cast("decimal(19,18)")


def text(value: Column, places: int) -> Column:
    """A decimal rounded half-up, as text with exactly ``places`` decimals."""
    return F.round(value, places).cast("string")
