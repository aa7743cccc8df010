"""Enrichment joins, defaults and de-duplication."""

from pyspark.sql import functions as F

from chainsight.operators import joins as J
from chainsight.operators.windows import first_per_key
from chainsight.plans import silver as S


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_country_join_keeps_rows_and_flags_before_default(spark):
    fact = spark.createDataFrame([(1, " Kenya "), (2, "Peru"), (3, "Atlantis"), (4, None)],
                                 "order_id long, order_country string")
    scores = spark.createDataFrame(
        [("Kenya", 2.4, "Very High Risk", 2.2, 2.6), ("Peru", 3.6, "Low Risk", 3.4, 3.8)],
        "country string, lpi_score double, logistics_risk_tier string, infrastructure_score double, "
        "timeliness_score double")
    out = J.join_country_scores(fact, scores)
    assert out.count() == 4
    rows = {r.order_id: r for r in out.collect()}
    assert rows[1].supplier_risk_flag == 1 and rows[1].lpi_score == 2.4
    assert rows[3].lpi_score is None and rows[3].supplier_risk_flag == 0


def test_supplier_join_by_assignment_with_gaps(spark):
    fact = spark.createDataFrame([(i,) for i in range(10)], "order_id long")
    sup = spark.createDataFrame([("SUP-000001", "a", 1), ("SUP-000002", "b", 2), ("SUP-000004", "d", 3)],
                                "supplier_id string, supplier_name string, tier int")
    out = J.join_suppliers(fact, sup).orderBy("order_id").collect()
    # range 1..4 (span 4): order i -> i % 4 + 1; number 3 is missing -> no supplier
    assert [r.supplier_name for r in out] == ["a", "b", None, "d", "a", "b", None, "d", "a", "b"]
    assert [r.supplier_tier for r in out][:4] == [1, 2, None, 3]


def test_weather_join_merges_spellings_and_fills(spark):
    fact = spark.createDataFrame([(1, " tx "), (2, "TX"), (3, "ZZ")], "order_id long, customer_state string")
    weather = spark.createDataFrame([("e1", "Tx", 5), ("e2", " TX", 4), ("e3", "tx ", 1)],
                                    "event_id string, state string, severity_score int")
    out = {r.order_id: r for r in J.join_weather(fact, weather).collect()}
    assert out[1].storm_event_count == 3 and out[1].high_critical_storm_count == 2
    assert out[1].weather_risk_score == 3.33
    assert (out[3].weather_risk_score, out[3].storm_event_count, out[3].high_critical_storm_count) == (1.0, 0, 0)


def test_route_stats_join_and_window_agree_with_null_keys(spark):
    rows = [("A", "R", "m1", 1, 2, i) for i in range(300)] + [("A", "R", "m2", 0, -1, 1000),
                                                             (None, "R", "m1", 1, 3, 1001), (None, "R", "m1", 0, 0, 1002)]
    fact = spark.createDataFrame(rows, "order_country string, order_region string, shipping_mode string, "
                                       "is_delayed int, delay_days int, order_id long")
    by_group = sorted(map(tuple, J.route_stats(fact).collect()), key=str)
    by_window = sorted(map(tuple, J.route_stats_window(fact, salts=8).collect()), key=str)
    assert by_group == by_window and len(by_group) == 3
    joined = {r.order_id: r for r in J.join_route_stats(fact).collect()}
    assert joined[1001].route_delay_rate is None  # NULL keys do not match in the join
    assert joined[5].route_order_count == 300


def test_coverage(spark):
    df = spark.createDataFrame([("a", 1), (None, None), ("b", None)], "supplier_name string, lpi_score int")
    got = {tuple(r) for r in J.join_coverage(df, {"supplier": "supplier_name", "scores": "lpi_score"}).collect()}
    assert got == {("supplier", 3, 2, 66.7), ("scores", 3, 1, 33.3)}
    empty = J.join_coverage(df.where("false"), {"supplier": "supplier_name"}).first()
    assert tuple(empty) == ("supplier", 0, 0, None)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "k int")
    assert [tuple(r) for r in J.duplicate_keys(df, "k").collect()] == [(2, 2)]


def first_per_key_window(df, keys, order):
    """Reference form of W2 (row_number per key) for the test only."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def test_first_per_key_both_forms(spark):
    df = spark.createDataFrame([("t1", 3, "x"), ("t1", 1, "y"), ("t2", 2, "z"), (None, 5, "n1"), (None, 4, "n2")],
                               "title string, feed_order int, source string")
    a = sorted((tuple(r) for r in first_per_key(df, ["title"], ["feed_order"]).collect()), key=str)
    b = sorted((tuple(r) for r in first_per_key_window(df, ["title"], ["feed_order"]).collect()), key=str)
    assert a == b == sorted([("t1", 1, "y"), ("t2", 2, "z"), (None, 4, "n2")], key=str)


def test_news_level_on_empty_feed_is_low(spark):
    empty = spark.createDataFrame([], "title string, feed_order long")
    b = S.BronzeTables(shipping=None, suppliers=None, country_scores=None, weather=None, commodity=None, news=empty)
    r = S.news_summary(b).first()
    assert r.avg_news_risk is None and r.news_risk_level == "LOW"


def test_scalars_attach_without_cross_join(spark):
    fact = spark.range(5)
    one = spark.createDataFrame([(7,)], "v int")
    out = J.attach_scalars(fact, v=one.select("v").scalar())
    assert {r.v for r in out.collect()} == {7}
    assert "CartesianProduct" not in plan_text(out) and "BroadcastNestedLoopJoin" not in plan_text(out)


def test_silver_same_rows_without_broadcasts(spark):
    """Sides too large to broadcast (shuffle joins) give the same silver."""
    from chainsight.plans import catalog as C
    from .conftest import SF001

    b = C.bronze(spark, SF001)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = S.silver(b)
        rows_shuffled = sorted(map(tuple, shuffled.collect()), key=str)
        assert "SortMergeJoin" in plan_text(shuffled) and "BroadcastHashJoin" not in plan_text(shuffled)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert rows_shuffled == sorted(map(tuple, S.silver(b).collect()), key=str)


def test_building_a_query_runs_no_job(spark):
    """Nothing is counted, persisted or run before the caller asks for rows."""
    from chainsight.plans import catalog as C
    from .conftest import SF001

    C.bronze(spark, SF001).shipping.count()  # the files' schemas are known now
    spark.sparkContext.setJobGroup("building", "")
    try:
        S.silver(C.bronze(spark, SF001))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    C.QUERIES["route_risk"](spark, SF001).collect()
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_latest_value_does_not_depend_on_row_order(spark):
    from chainsight.operators import aggregates as G

    rows = [("oil_price_usd", "2024-01-01", 80.0), ("oil_price_usd", "2024-01-01", 90.0), ("oil_price_usd", "2024-02-01", None)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "metric_name string, date string, value double").coalesce(1)
        assert tuple(G.commodity_shock(df).first()) == (90.0, 1)
        latest = G.latest_by_series(df).first()
        assert (latest.latest_value, latest.observations, latest.shock_flag) == (90.0, 2, 1)


def test_unlisted_series_are_kept(spark):
    from chainsight.operators.sets import tag_series

    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "series_id string, value double")
    assert {tuple(r) for r in tag_series(df, {"a": "first"}).collect()} == {("a", 1.0, "first"), ("b", 2.0, "b")}


def test_out_of_fold_route_rates(spark):
    """Against a plain loop, with a third of the lines on one route, unknown keys and test rows."""
    from chainsight.operators import joins as J
    from chainsight.operators import ml as M

    rows = [(i, i % 3, "A" if i % 3 == 0 else f"C{i % 11}" if i % 17 else None, "R", f"M{i % 2}", i % 4 - 1, int(i % 4 > 1), i % 6 - 1)
            for i in range(600)]
    rows += [(1000, 0, "lonely", "R", "M0", 2, 1, 0)]
    df = spark.createDataFrame(rows, "order_id long, line_number int, order_country string, order_region string, "
                                     "shipping_mode string, delay_days int, is_delayed int, fold int")
    got = J.join_route_stats_out_of_fold(df, "fold", known=F.col("fold") >= 0).collect()
    assert len(got) == len(rows)
    for r in got:
        other = [x for x in rows if x[2:5] == (r.order_country, r.order_region, r.shipping_mode) and None not in x[2:5]
                 and x[7] >= 0 and x[7] != r.fold]
        if r.order_country is None:
            assert r.route_order_count is None
            continue
        assert r.route_order_count == len(other)
        if other:
            assert abs(r.route_delay_rate - sum(x[6] for x in other) / len(other)) < 1e-12
            assert abs(r.route_avg_delay_days - sum(x[5] for x in other) / len(other)) < 1e-12
        else:
            assert r.route_delay_rate is None
    # no test outcome reaches any row: turning all of them changes nothing
    silver = df.drop("fold").withColumn("route_delay_rate", F.lit(0.0)).withColumn("route_avg_delay_days", F.lit(0.0)) \
        .withColumn("route_order_count", F.lit(0).cast("long"))
    turned = silver.withColumn("is_delayed", F.when(M.split_flag(), F.col("is_delayed")).otherwise(1 - F.col("is_delayed")))
    keep = ("order_id", "line_number", "route_delay_rate", "route_avg_delay_days", "route_order_count")
    a, b = (sorted(map(str, M.train_only_route_rates(x).select(*keep).collect())) for x in (silver, turned))
    assert a == b and len(set(a)) > 100


def test_first_per_key_of_a_number_alone_hashes(spark):
    rows = [("a", 3), ("a", 1), (None, 5), (None, 4), ("b", None), ("b", 2), ("c", 7), ("c", 7)]
    df = spark.createDataFrame(rows, "title string, feed_order long")
    out = first_per_key(df, ["title"], ["feed_order"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("a", 1), (None, 4), ("b", None), ("c", 7)], key=str)
    wide = first_per_key(df.withColumn("x", F.lit(1)), ["title"], ["feed_order"]).drop("x")
    assert sorted(map(str, wide.collect())) == sorted(map(str, out.collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_window_attach_equals_join_with_a_hot_route(spark):
    """A third of the lines on one route, NULL keys and values; the lines are read once."""
    rows = [(i, None if i % 50 == 7 else i % 9, "HOT" if i % 3 == 0 else f"C{i % 13}" if i % 19 else None, "R",
             f"M{i % 2}" if i % 23 else None, None if i % 31 == 0 else i % 5 - 1, None if i % 37 == 0 else int(i % 5 > 1))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "order_id long, x int, order_country string, order_region string, shipping_mode string, "
                                     "delay_days int, is_delayed int")
    want = J.join_route_stats(df)
    got = J.attach_route_stats_window(df, salts=8)
    assert got.columns == want.columns

    def rounded(r):
        return tuple(round(v, 12) if isinstance(v, float) else v for v in r)
    key = lambda t: tuple(map(str, t))
    assert sorted(map(rounded, got.collect()), key=key) == sorted(map(rounded, want.collect()), key=key)
    assert J.attach_route_stats_window(df.where("false")).count() == 0


def test_window_attach_reads_the_lines_once(spark):
    from chainsight.plans import catalog
    from .conftest import SF001

    plan = catalog.queries()["route_lines_window"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") <= 2 and "Join" in plan  # initial and final plan; the adapter's own joins
    hot = J.attach_route_stats_window(spark.read.parquet(f"{SF001}/orders.parquet").selectExpr(
        "o_orderkey AS order_id", "o_orderstatus AS order_country", "o_orderpriority AS order_region", "'m' AS shipping_mode",
        "1 AS delay_days", "0 AS is_delayed"))
    text = hot._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation") == 1 and "Join" not in text
