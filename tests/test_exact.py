"""Exact rounded aggregates against Python's Decimal."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chainsight.functions.exact import decimal_mean, exact_mean, exact_ratio, exact_sum


def py_round(num, den, places):
    q = (Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP) \
        if den else None
    return q


def test_tie_rounds_half_up(spark):
    # 201/200 = 1.005 exactly: half-up gives 1.01 (a binary double would give 1.0)
    df = spark.createDataFrame([(201, 200)], "n long, d long")
    assert df.select(exact_ratio(F.col("n"), F.col("d"), 2)).first()[0] == 1.01
    as_text = exact_ratio(F.col("n"), F.col("d"), 2, as_double=False).cast("string")
    assert df.select(as_text).first()[0] == "1.01"


def test_negative_and_zero(spark):
    df = spark.createDataFrame([(-201, 200), (0, 3), (5, 0)], "n long, d long")
    rows = df.select(exact_ratio(F.col("n"), F.col("d"), 2), exact_ratio(F.col("n"), F.col("d"), 2, as_double=False).cast("string")).collect()
    assert [tuple(r) for r in rows] == [(-1.01, "-1.01"), (0.0, "0.00"), (None, None)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=40),
       st.integers(min_value=0, max_value=3))
@example(values=[0, 0, -1], places=0)  # -1/3 rounds to zero: text "0", not "-0"
@example(values=[1, 2], places=0)      # 1.5 rounds half up to 2
def test_exact_mean_matches_decimal(spark, values, places):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    got = df.agg(exact_mean("x", places),
                 exact_ratio(F.sum("x"), F.count("x"), places, as_double=False).cast("string")).first()
    want = py_round(sum(values), len(values), places)
    assert got[0] == float(want)
    assert got[1] == str(want + 0)  # "+ 0" turns Decimal's "-0" into "0": no signed zero in text


def test_exact_sum_in_cents(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (1234.56,)], "x double")
    assert df.agg(exact_sum("x", 2)).first()[0] == 1234.86


def test_means_round_once(spark):
    """No value is rounded before the mean is."""
    df = spark.createDataFrame([(3.45, 88.1471), (3.45, None), (3.44, 88.1471), (None, 88.1471)], "a double, b double")
    assert tuple(df.agg(decimal_mean("a", 2), decimal_mean("b", 1)).first()) == (3.45, 88.1)
    tiny = spark.createDataFrame([(0.00006,)] * 100, "x double")
    assert tuple(tiny.agg(exact_sum("x", 3), decimal_mean("x", 4)).first()) == (0.006, 0.0001)
