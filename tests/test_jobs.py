"""Jobs end to end: test tables -> silver -> model -> gold, and raw files ->
bronze -> silver."""

import gzip
import json
import os
from datetime import datetime

from chainsight import schemas as SC
from chainsight.plans import jobs as JB
from chainsight.sinks import writers as W

from .conftest import SF001


def test_pipeline_on_test_tables(spark, tmp_dir):
    out = os.path.join(tmp_dir, "run")
    result = JB.run_on_test_tables(spark, SF001, out)
    assert result["silver_rows"] == spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    silver = spark.read.parquet(f"{out}/silver/supply_chain_master")
    assert {"market", "route_delay_rate", "supplier_name", "_silver_processed_at"} <= set(silver.columns)
    assert any(d.startswith("market=") for d in os.listdir(f"{out}/silver/supply_chain_master"))
    kpi = {r.metric: r.value for r in spark.read.parquet(f"{out}/gold/kpi_summary").collect()}
    assert kpi["total_orders"] == str(result["silver_rows"])
    assert kpi["model_auc"] == result["model_metrics"]["model_auc"]
    assert kpi["news_risk_level"] in {"LOW", "MEDIUM", "HIGH"}
    hist = W.history(spark, f"{out}/run_log").collect()
    assert {r.job for r in hist} == {"silver", "model", "gold"}
    assert W.load_model(f"{out}/gold/model/gbt_risk_classifier") is not None


def _raw_inputs(root):
    os.makedirs(root, exist_ok=True)
    # order lines: 3 countries x 2 modes, some late
    header = ",".join(n for n, _ in SC.SHIPPING_CSV_COLUMNS)
    lines = []
    for i in range(60):
        vals = {"Order_Id": str(1000 + i // 2), "Order_Item_Id": str(i), "Days_for_shipping_real": str(2 + i % 5),
                "Days_for_shipment_scheduled": str(2 + i % 3), "Late_delivery_risk": str(int(i % 5 > i % 3)),
                "Market": ["Europe", "LATAM"][i % 2], "Order_Country": ["Kenya", "Peru", "Japan"][i % 3],
                "Order_Region": "R", "Shipping_Mode": ["Standard Class", "First Class"][i % 2],
                "Customer_State": [" tx", "CA "][i % 2], "Sales": f"{10 + i}.25",
                "Order_Profit_Per_Order": f"{(i % 7) - 3}.5", "Delivery_Status": "x", "Order_Date": "1/2/2018 10:00"}
        row = []
        for name, typ in SC.SHIPPING_CSV_COLUMNS:
            row.append(vals.get(name, {"string": "x", "int": "1", "double": "1.0"}[typ]))
        lines.append(",".join(row))
    with open(os.path.join(root, "orders.csv"), "wb") as f:
        f.write(("\n".join([header, *lines]) + "\n").encode("latin-1"))
    storm_cols = [c[0] for c in SC.STORM_COLUMNS]
    with gzip.open(os.path.join(root, "storms.csv.gz"), "wt") as f:
        f.write(",".join(storm_cols) + "\n")
        for i, (st, ev) in enumerate([("TX", "Hurricane"), ("TX", "Flood"), ("CA", "Drought")]):
            f.write(",".join({"EVENT_ID": str(i), "STATE": st, "EVENT_TYPE": ev}.get(c, "") for c in storm_cols) + "\n")
    os.makedirs(os.path.join(root, "news", "port_delay"))
    with open(os.path.join(root, "news", "port_delay", "feed.xml"), "w") as f:
        f.write("<rss><channel><item><title>Port strike spreads</title><description>d</description>"
                "<link>l</link></item><item><title>Shipping delay eases</title><description>d</description>"
                "<link>l2</link></item></channel></rss>")
    os.makedirs(os.path.join(root, "prices"))
    with open(os.path.join(root, "prices", "DCOILWTICO.json"), "w") as f:
        json.dump({"observations": [{"date": "2024-01-01", "value": "80"}, {"date": "2024-02-01", "value": "90.5"}]}, f)
    with open(os.path.join(root, "lpi.csv"), "w") as f:
        f.write("country,country_code,region,lpi_score,customs_score,infrastructure_score,"
                "international_shipments_score,logistics_quality_score,timeliness_score\n"
                "Kenya,KEN,SSA,2.8,2.6,2.9,2.8,2.7,2.9\nJapan,JPN,EAP,3.9,3.8,4.0,3.9,3.8,4.0\n")
    return root


def test_raw_files_through_all_jobs(spark, tmp_dir):
    root = _raw_inputs(os.path.join(tmp_dir, "raw"))
    sup_path = os.path.join(root, "suppliers")
    rows = [(f"SUP-{i:06d}", f"S{i}", "USA", "USA", "NA", "Retail", 1 + i % 3, 10 + i, 1.0, 70.0 + i, 50.0, None,
             datetime(2024, 1, 1)) for i in range(1, 6)]
    spark.createDataFrame(rows, SC.SUPPLIERS).write.parquet(sup_path)
    raw = JB.RawInputs(shipping_csv=os.path.join(root, "orders.csv"),
                       storm_csv=[os.path.join(root, "storms.csv.gz")], news_dir=os.path.join(root, "news"),
                       prices_dir=os.path.join(root, "prices"), country_scores_csv=os.path.join(root, "lpi.csv"),
                       suppliers=sup_path)
    out = os.path.join(tmp_dir, "out")
    result = JB.run_on_raw_files(spark, raw, out, params={"maxIter": 5})
    assert result["bronze"] == {"shipping_events": 60, "weather_events": 3, "news_disruptions": 2,
                                "commodity_prices": 2, "supplier_risk": 2, "supplier_master": 5}
    assert result["silver_rows"] == 60
    assert set(result["gold"]) == {"market_dashboard", "route_risk", "supplier_leaderboard", "mode_performance",
                                   "kpi_summary"}
    assert set(os.listdir(f"{out}/reports")) == {
        "dq_shipping", "dq_weather", "series_profile", "dq_silver", "join_lines", "confusion",
        "feature_importance", "accuracy_by_market", "model_metrics"}
    for name in result["bronze"]:
        columns = set(spark.read.parquet(f"{out}/bronze/{name}").columns)
        lineage = {"ingested_ts", "source"} if name == "commodity_prices" else \
            {"_ingested_at", "_source_name", "_pipeline_version"}
        assert lineage <= columns, name
    # one clock: every table of the run carries the same time, every log row the same id
    stamps = {"shipping_events": "_ingested_at", "weather_events": "_ingested_at", "news_disruptions": "_ingested_at",
              "commodity_prices": "ingested_ts", "supplier_risk": "_ingested_at", "supplier_master": "_ingested_at"}
    times = {r[0] for n, c in stamps.items() for r in spark.read.parquet(f"{out}/bronze/{n}").select(c).distinct().collect()}
    times |= {r[0] for r in spark.read.parquet(f"{out}/silver/supply_chain_master").select("_silver_processed_at").distinct().collect()}
    times |= {r[0] for r in spark.read.parquet(f"{out}/gold/market_dashboard").select("_processed_at").distinct().collect()}
    times |= {r[0] for r in spark.read.parquet(f"{out}/gold/risk_predictions").select("_gold_processed_at").distinct().collect()}
    assert len(times) == 1
    assert len({r.run_id for r in W.history(spark, f"{out}/run_log").collect()}) == 1
    silver = spark.read.parquet(f"{out}/silver/supply_chain_master")
    by_country = {r.order_country: r for r in silver.select("order_country", "lpi_score", "logistics_risk_tier",
                                                            "supplier_risk_flag", "commodity_shock_flag",
                                                            "news_risk_level").distinct().collect()}
    assert by_country["Kenya"].logistics_risk_tier == "High Risk" and by_country["Kenya"].supplier_risk_flag == 1
    assert by_country["Peru"].lpi_score == 3.0 and by_country["Peru"].logistics_risk_tier == "Medium Risk"
    assert {r.commodity_shock_flag for r in by_country.values()} == {1}  # latest oil price 90.5 > 85
    assert {r.news_risk_level for r in by_country.values()} == {"HIGH"}  # mean of 3 and 2 = 2.5
    tx = silver.where("weather_risk_score <> 1.0").select("weather_risk_score").distinct().collect()
    assert [r.weather_risk_score for r in tx] == [4.0]  # TX: hurricane 5, flood 3
    assert silver.where("supplier_name IS NULL").count() == 0


def test_silver_job_rejects_fan_out(spark, tmp_dir):
    """A duplicated country in the score table would multiply lines: Q6 stops it."""
    import pytest
    from pyspark.sql import functions as F
    from chainsight.plans.catalog import bronze

    b = bronze(spark, SF001)
    out = os.path.join(tmp_dir, "fan")
    rows = JB.silver_job(spark, b, out)
    dup = b.country_scores.unionByName(b.country_scores.where(F.col("country") == "NATION_0"))
    b.__dict__["country_scores"] = dup
    with pytest.raises(JB.RowParityError, match="join country_scores: .*NATION_0.* 2 times"):
        JB.silver_job(spark, b, out)
    # the failed run left the earlier table as it was
    assert spark.read.parquet(f"{out}/silver/supply_chain_master").count() == rows


def test_main_keeps_the_sessions_settings(spark, monkeypatch, tmp_dir):
    seen = {}

    def run(session, sf_dir, out):
        seen.update(master=session.sparkContext.master, partitions=session.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(JB, "run_on_test_tables", run)
    before = spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions")
    JB.main(["--test-tables", SF001, "--out", tmp_dir])
    assert (seen["master"], seen["partitions"]) == before


def test_null_in_a_required_supplier_column(spark):
    import pytest

    row = (None, "S", "USA", "USA", "NA", "Retail", 1, 10, 1.0, 70.0, 50.0, None, datetime(2024, 1, 1))
    loose = type(SC.SUPPLIERS)([type(f)(f.name, f.dataType, True) for f in SC.SUPPLIERS])
    with pytest.raises(JB.NullInRequiredColumn):
        JB.require_suppliers(spark.createDataFrame([row], loose))


def test_shipping_enriched_side_table(spark, tmp_dir):
    from chainsight.plans.catalog import bronze

    b = bronze(spark, SF001)
    path = JB.shipping_enriched_job(spark, b.shipping, tmp_dir)
    df = spark.read.parquet(path)
    assert {"delay_days", "is_delayed", "route_key", "profit_margin_flag"} <= set(df.columns)
    assert df.count() == b.shipping.count()
    JB.shipping_enriched_job(spark, b.shipping, tmp_dir)  # same schema: overwrite allowed


def test_silver_job_counts_every_join(spark, tmp_dir):
    from pyspark.sql import functions as F
    from chainsight.plans.catalog import bronze, queries

    b = bronze(spark, SF001)
    out = os.path.join(tmp_dir, "joins")
    rows = JB.silver_job(spark, b, out, table="silver_by_name")
    got = {r.join_name: r for r in spark.read.parquet(f"{out}/reports/join_lines").collect()}
    want = {r.join_name: r for r in queries()["join_lines"](spark, SF001).collect()}
    assert list(want) == ["supplier", "country_scores", "weather", "routes"] and set(got) == set(want)
    for name, r in got.items():
        assert (r.step, r.lines_before, r.lines_after, r.matched) == tuple(want[name])[1:]
        assert r.lines_after == rows
    # five nations are spelt otherwise: the default score hides them in the table, not in the report
    assert 0 < got["country_scores"].matched < rows and spark.table("silver_by_name").where("lpi_score IS NULL").count() == 0
    JB.silver_job(spark, b, out, table="silver_by_name")
    assert spark.table("silver_by_name").count() == rows
    spark.sql("DROP VIEW silver_by_name")


def test_forecast_names_the_join_that_would_multiply_lines(spark):
    from pyspark.sql import functions as F
    from chainsight.operators import joins as J

    fact = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "k long, c string")
    one = spark.createDataFrame([(1,), (2,), (9,)], "x long")
    two = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "y string")
    sides = {"one": (one, ["x"], ["k"]), "two": (two, ["y"], [F.col("c")]), "again": (one, ["x"], ["k"])}
    rows = [tuple(r) for r in J.join_forecast(fact, sides).collect()]
    assert rows == [("one", 1, 4, 4, 2), ("two", 2, 4, 6, 5), ("again", 3, 6, 6, 4)]
    assert [r.lines_after for r in J.join_forecast(fact.where("false"), sides).collect()] == [0, 0, 0]
