"""Properties from the test strategy: group counts add up to the total, joins
keep the line count, confusion cells add up to the scored rows."""

from pyspark.sql import functions as F

from chainsight.operators import aggregates as G
from chainsight.operators import ml as M
from chainsight.plans import catalog as C
from chainsight.plans import catalog_ml as CM
from chainsight.plans import silver as S

from .conftest import SF001


def test_group_counts_add_up(spark):
    lines = C.lines(spark, SF001)
    n = lines.count()
    silver = C.silver(spark, SF001)
    assert silver.count() == n  # every enrichment keeps the line count
    assert G.market_kpi(silver).agg(F.sum("total_orders")).first()[0] == n
    assert G.route_risk(silver, min_orders=0).agg(F.sum("order_count")).first()[0] == n
    assert G.supplier_leaderboard(silver, min_orders=0).agg(F.sum("order_count")).first()[0] == n
    assert G.value_distribution(lines, ["shipping_mode"]).agg(F.sum("count")).first()[0] == n


def test_lean_silver_matches_full_silver(spark):
    b = C.bronze(spark, SF001)
    cols = ["order_id", "line_number", "market", "lpi_score", "weather_risk_score", "is_delayed"]
    lean = sorted(map(tuple, S.silver(b, columns=cols).collect()), key=str)
    full = sorted(map(tuple, S.silver(b, extra=["line_number"]).select(*cols).collect()), key=str)
    assert lean == full


def test_confusion_cells_add_up(spark):
    preds = CM.fixed_predictions(spark, SF001)
    n = preds.count()
    assert M.confusion(preds).agg(F.sum("count")).first()[0] == n
    per = M.score_counts(preds, "label", "score", "prediction")
    c = M.confusion_from_score_counts(per).first()
    direct = M.confusion_counts(preds).first()
    assert tuple(c) == tuple(direct) and c.n == n


def test_severity_label_is_a_function_of_score(spark):
    w = C.TestTables.shared(spark, SF001).weather_events()
    assert w.groupBy("severity_score").agg(F.countDistinct("severity_label").alias("k")) \
            .where("k > 1").count() == 0


def test_hot_key_holding_a_third_of_rows(spark):
    """One market / route / title with a third of all rows: aggregates stay exact
    and the plan aggregates partially before any shuffle."""
    from chainsight.operators import joins as J
    from chainsight.operators.windows import first_per_key

    n = 3000
    rows = [("HOT" if i % 3 == 0 else f"m{i % 7}", "C", "R", "HOT" if i % 3 == 0 else f"x{i % 5}",
             i % 2, (i % 5) - 2, i, 10.25) for i in range(n)]
    fact = spark.createDataFrame(rows, "market string, order_country string, order_region string, "
                                       "shipping_mode string, is_delayed int, delay_days int, order_id long, "
                                       "sales double").withColumn("lpi_score", F.lit(3.0)) \
                                                      .withColumn("weather_risk_score", F.lit(1.0))
    hot = [r for r in rows if r[0] == "HOT"]
    mart = {r.market: r for r in G.market_kpi(fact).collect()}
    assert mart["HOT"].total_orders == len(hot) == n // 3
    assert mart["HOT"].delay_rate_pct == round(100 * sum(r[4] for r in hot) / len(hot), 1)
    stats = {r.shipping_mode: r for r in J.route_stats(fact).collect()}
    window = {r.shipping_mode: r for r in J.route_stats_window(fact).collect()}
    assert stats["HOT"].route_order_count == window["HOT"].route_order_count == n // 3
    assert stats["HOT"].route_delay_rate == window["HOT"].route_delay_rate
    plan = G.market_kpi(fact)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # map-side combine before the exchange
    titles = fact.select(F.col("market").alias("title"), F.col("order_id").alias("feed_order"))
    firsts = {r.title: r.feed_order for r in first_per_key(titles, ["title"], ["feed_order"]).collect()}
    assert firsts["HOT"] == 0


def test_quality_reports_on_empty_input(spark):
    """Q1/Q3 on no rows: counts 0, percentages NULL (no ANSI division error)."""
    from chainsight.operators import quality as Q

    empty = spark.createDataFrame([], "order_id long, delivery_status string, order_date date, "
                                      "late_delivery_risk int")
    r = Q.shipping_check(empty).first()
    assert (r.total_rows, r.late_rows, r.late_pct, r.on_time_pct) == (0, 0, None, None)
    empty_silver = spark.createDataFrame([], "is_delayed int, supplier_risk_flag int, commodity_shock_flag int")
    s = Q.silver_check(empty_silver).first()
    assert (s.total_rows, s.delayed_pct, s.shock_pct) == (0, None, None)
    k = G.kpi_totals(empty_silver.withColumn("sales", F.lit(1.0)).withColumn("order_profit", F.lit(1.0))
                     .withColumn("delay_days", F.lit(1))).first()
    assert (k.total_orders, k.delay_rate_pct, k.avg_delay_days) == (0, None, None)
