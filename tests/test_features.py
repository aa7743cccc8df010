"""Row-level expressions: every NULL / edge case of the inventory."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainsight.functions import constants as K
from chainsight.functions import features as FX


def one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_delay_flags_and_nulls(spark):
    df = spark.createDataFrame([(5, 3, -1.0), (2, 4, 0.0), (None, 4, None), (3, 3, 2.5)],
                               "days_real int, days_scheduled int, order_profit double")
    df = df.withColumn("delay_days", FX.delay_days()).withColumn("is_delayed", FX.is_delayed())
    rows = df.select("delay_days", "is_delayed", FX.profit_margin_flag().alias("p")).collect()
    assert [tuple(r) for r in rows] == [(2, 1, 1), (-2, 0, 0), (None, 0, 0), (0, 0, 0)]


def test_route_key_skips_nulls(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, None)], "order_country string, order_region string")
    assert col_values(df, FX.route_key()) == ["A_B", "A", ""]


def test_supplier_risk_flag(spark):
    df = one_col(spark, ["Very High Risk", "High Risk", "Medium Risk", None], T.StringType())
    assert col_values(df, FX.supplier_risk_flag("x")) == [1, 1, 0, 0]


def test_severity_classes_and_labels(spark):
    types = ["Hurricane", "Typhoon", "Tornado", "Tsunami", "Flood", "Blizzard", "High Wind", "Heavy Rain",
             "Drought", None]
    df = one_col(spark, types, T.StringType()).withColumn("s", FX.severity_score("x"))
    rows = df.select("s", FX.severity_label("s").alias("l")).collect()
    assert [r.s for r in rows] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]
    assert [r.l for r in rows] == ["CRITICAL", "CRITICAL", "HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW",
                                   "MINIMAL", "MINIMAL"]


def test_logistics_tier_right_closed_bins(spark):
    scores = [2.5, 2.51, 3.0, 3.01, 3.5, 4.0, 4.01, 5.0, 0.0, 5.1, None]
    df = one_col(spark, scores, T.DoubleType())
    assert col_values(df, FX.logistics_tier("x")) == [
        "Very High Risk", "High Risk", "High Risk", "Medium Risk", "Medium Risk", "Low Risk", "Very Low Risk",
        "Very Low Risk", None, None, None]


def test_news_title_score_real_keywords(spark):
    titles = ["Port STRIKE looms", "Shipping delays grow", "Calm seas", None, "Risky business", "Striker wins"]
    df = one_col(spark, titles, T.StringType())
    # substring match without word boundaries, case-insensitive, first class wins
    assert col_values(df, FX.news_title_score("x")) == [3, 2, 1, 1, 2, 3]


def test_news_level_cut_points(spark):
    df = one_col(spark, [2.5, 2.4999, 1.5, 1.4999, None], T.DoubleType())
    assert col_values(df, FX.news_level("x")) == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]


def test_shock_flag_is_strict(spark):
    df = one_col(spark, [85.0, 85.01, None], T.DoubleType())
    assert col_values(df, FX.shock_flag("x")) == [0, 1, 0]


def test_numeric_codes(spark):
    df = spark.createDataFrame([("HIGH", "Very High Risk"), ("MEDIUM", "Low Risk"), ("LOW", "Very Low Risk"),
                                (None, None)], "news_risk_level string, logistics_risk_tier string")
    rows = df.select(FX.news_risk_numeric(), FX.lpi_risk_numeric()).collect()
    assert [tuple(r) for r in rows] == [(3.0, 5.0), (2.0, 2.0), (1.0, 1.0), (1.0, 1.0)]


def test_correct_and_band(spark):
    df = spark.createDataFrame([(1, 1.0, 57.0), (0, 1.0, 57.1), (None, 0.0, None)],
                               "actual_risk int, predicted_risk double, delay_rate_pct double")
    rows = df.select(FX.correct(), FX.market_band()).collect()
    assert [tuple(r) for r in rows] == [(1, "MEDIUM"), (0, "HIGH"), (0, "MEDIUM")]


def test_supplier_number_never_raises(spark):
    ids = ["SUP-000001", "SUP-002000", "SUP-0", "XYZ-12", "", None]
    df = one_col(spark, ids, T.StringType())
    assert col_values(df, FX.supplier_number("x")) == [1, 2000, 0, None, None, None]


def test_supplier_assignment_uses_pmod(spark):
    df = spark.createDataFrame([(7,), (-7,), (0,)], "order_id long")
    got = col_values(df, FX.supplier_assignment("order_id", F.lit(1), F.lit(5)))
    assert got == [3, 4, 1]  # pmod keeps negative ids in range


def test_sales_millions_and_width(spark):
    df = spark.createDataFrame([(36_812_345.0, 3.27), (1_005_000.0, 2.5)], "s double, l double")
    rows = df.select(FX.sales_millions("s"), FX.lpi_width_pct("l")).collect()
    assert [tuple(r) for r in rows] == [("$36.81M", 65), ("$1.01M", 50)]


def test_keyword_lists_are_the_fixed_values():
    assert K.NEWS_LEVEL3_KEYWORDS[:2] == ["crisis", "critical"]
    assert len(K.FEATURE_COLS) == 15 and K.GBT_PARAMS["maxIter"] == 50
