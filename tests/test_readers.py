"""Raw-file readers on hand-made fixtures."""

import gzip
import json
import os
from datetime import datetime

from chainsight import schemas as SC
from chainsight.sources import files as SRC


def shipping_line(**over):
    vals = []
    for name, typ in SC.SHIPPING_CSV_COLUMNS:
        v = over.get(name, {"string": "x", "int": "1", "double": "1.5"}[typ])
        vals.append(v)
    return ",".join(vals)


def test_shipping_csv_latin1_quotes_bad_ints(spark, tmp_dir):
    header = ",".join(f"col{i}" for i in range(len(SC.SHIPPING_CSV_COLUMNS)))  # renamed header: bound by position
    rows = [
        shipping_line(Order_Id="10", Order_Country='"Côte ""Ivoire"""', Days_for_shipping_real="5",
                      Days_for_shipment_scheduled="3", Market="Africa"),
        shipping_line(Order_Id="abc", Order_Country="Perú", Days_for_shipping_real="2",
                      Days_for_shipment_scheduled="4", Market="LATAM"),
    ]
    path = os.path.join(tmp_dir, "ship.csv")
    with open(path, "wb") as f:
        f.write(("\n".join([header, *rows]) + "\n").encode("latin-1"))
    raw = SRC.read_shipping_raw(spark, path)
    assert len(raw.columns) == 53
    roles = SRC.shipping_roles(raw).orderBy("market").collect()
    assert roles[0].order_country == 'Côte "Ivoire"' and roles[0].order_id == 10
    assert roles[1].order_country == "Perú" and roles[1].order_id is None  # non-numeric int -> NULL
    bronze = SRC.shipping_bronze(raw)
    assert set(raw.columns) < set(bronze.columns) and "_source_file" in bronze.columns
    assert "Customer_Password" not in SRC.shipping_bronze(raw, SC.SHIPPING_PERSONAL).columns


def test_storm_gz_union_and_severity(spark, tmp_dir):
    cols = [c[0] for c in SC.STORM_COLUMNS]
    def write(name, rows):
        p = os.path.join(tmp_dir, name)
        with gzip.open(p, "wt") as f:
            f.write(",".join(cols) + "\n")
            for r in rows:
                f.write(",".join(r.get(c, "") for c in cols) + "\n")
        return p
    a = write("s2022.csv.gz", [{"EVENT_ID": "1", "STATE": "TEXAS", "EVENT_TYPE": "Hurricane", "BEGIN_DAY": "3"},
                               {"EVENT_ID": "2", "STATE": " texas", "EVENT_TYPE": "Drought", "BEGIN_DAY": "x"}])
    b = write("s2023.csv.gz", [{"EVENT_ID": "3", "STATE": "", "EVENT_TYPE": "", "BEGIN_LAT": "29.7"}])
    df = SRC.read_weather(spark, [a, b]).orderBy("event_id").collect()
    assert [r.severity_score for r in df] == [5, 1, 1]
    assert [r.severity_label for r in df] == ["CRITICAL", "MINIMAL", "MINIMAL"]
    assert df[0].begin_day == 3 and df[1].begin_day is None and df[2].begin_lat == 29.7
    assert df[2].state is None and df[2].event_type is None


def test_news_rss_folders(spark, tmp_dir):
    def feed(query, items):
        d = os.path.join(tmp_dir, "news", query)
        os.makedirs(d, exist_ok=True)
        body = "".join(items)
        with open(os.path.join(d, "feed.xml"), "w") as f:
            f.write(f"<rss><channel><title>q</title>{body}</channel></rss>")
    long = "y" * 700
    feed("port_delay", [
        "<item><title>Port strike</title><pubDate>Mon</pubDate><description>d1</description>"
        "<link>l1</link><source url='http://a'>Agency A</source></item>",
        f"<item><title>Calm</title><pubDate>Tue</pubDate><description>{long}</description><link>l2</link></item>",
    ])
    feed("supply_risk", [
        "<item><title>Port strike</title><pubDate>Wed</pubDate><description>d3</description>"
        "<link>l3</link><source url='http://b'>Agency B</source></item>",
    ])
    news = SRC.read_news(spark, os.path.join(tmp_dir, "news"))
    rows = {(r.query_used, r.title): r for r in news.collect()}
    assert len(rows) == 3
    assert rows[("port_delay", "Calm")].source == "Unknown"
    assert rows[("port_delay", "Calm")].summary == long
    assert rows[("port_delay", "Calm")]._source_name == "news_feed"
    cut = SRC.read_news(spark, os.path.join(tmp_dir, "news"), summary_chars=500)
    assert max(len(r.summary) for r in cut.collect()) == 500
    assert rows[("supply_risk", "Port strike")].source == "Agency B"
    from chainsight.operators.windows import first_per_key
    dedup = first_per_key(news, ["title"], ["feed_order"]).collect()
    assert len(dedup) == 2 and {r.title for r in dedup} == {"Port strike", "Calm"}
    assert [r.query_used for r in dedup if r.title == "Port strike"] == ["port_delay"]


def test_news_text_is_not_altered(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "q"))
    with open(os.path.join(tmp_dir, "q", "feed.xml"), "w") as f:
        f.write("<rss><channel>" + "".join(
            f"<item><title>{t}</title><source>{s}</source></item>" for t, s in [("007", "1.50"), ("1e3", "B")])
            + "</channel></rss>")
    rows = {(r.title, r.source, r.summary) for r in SRC.read_news(spark, tmp_dir).collect()}
    assert rows == {("007", "1.50", ""), ("1e3", "B", "")}


def test_price_json_series(spark, tmp_dir):
    d = os.path.join(tmp_dir, "prices")
    os.makedirs(d)
    with open(os.path.join(d, "DCOILWTICO.json"), "w") as f:
        json.dump({"observations": [{"date": "2024-01-01", "value": "71.1"}, {"date": "2024-01-02", "value": "."},
                                    {"date": "2024-01-03", "value": "85"}]}, f)
    with open(os.path.join(d, "DHHNGSP.json"), "w") as f:
        json.dump({"observations": [{"date": "2024-01-01", "value": "2.5"}]}, f)
    prices = SRC.read_commodity(spark, d)
    rows = sorted((r.series_id, r.date, r.value, r.metric_name) for r in prices.collect())
    assert rows == [("DCOILWTICO", "2024-01-01", 71.1, "oil_price_usd"), ("DCOILWTICO", "2024-01-03", 85.0, "oil_price_usd"),
                    ("DHHNGSP", "2024-01-01", 2.5, "natural_gas_price")]
    from chainsight.operators import aggregates as G
    shock = G.commodity_shock(prices).first()
    assert shock.latest_price == 85.0 and shock.commodity_shock_flag == 0  # strictly above 85
    none = G.commodity_shock(prices, metric="no_such_series").first()
    assert none.latest_price is None and none.commodity_shock_flag == 0


def test_country_scores_csv(spark, tmp_dir):
    p = os.path.join(tmp_dir, "lpi.csv")
    with open(p, "w") as f:
        f.write("country,country_code,region,lpi_score,customs_score,infrastructure_score,"
                "international_shipments_score,logistics_quality_score,timeliness_score\n")
        for name, s in [("A", 2.5), ("B", 3.0), ("C", 3.5), ("D", 4.0), ("E", 0), ("F", 5.1)]:
            f.write(f"{name},{name},R,{s},1,1,1,1,1\n")
    scores = SRC.read_country_scores(spark, p)
    assert {"year", "data_source", "_ingested_at", "_source_name", "_pipeline_version"} <= set(scores.columns)
    tiers = [r.logistics_risk_tier for r in scores.orderBy("country").collect()]
    assert tiers == ["Very High Risk", "High Risk", "Medium Risk", "Low Risk", None, None]


def test_suppliers_not_null_check(spark, tmp_dir):
    rows = [("SUP-000001", "Acme", "USA", "USA", "NA", "Retail", 1, 10, 1.0, 80.0, 60.0, None, datetime(2024, 1, 1)),
            ("SUP-000002", "Acme", "China", "CHN", "EA", "Retail", 2, 20, 1.0, 70.0, 50.0, "late", datetime(2024, 1, 1))]
    path = os.path.join(tmp_dir, "suppliers")
    spark.createDataFrame(rows, SC.SUPPLIERS).write.parquet(path)
    sup = SRC.read_suppliers(spark, path)
    check = SRC.supplier_null_check(sup).first()
    assert check.rows == 2 and check.null_supplier_id == 0


def test_text_columns_are_parsed_like_files(spark, tmp_dir):
    """The row parsers give what the file readers give, and keep and mark bad records."""
    from chainsight.sources import rows as ROWS

    # header in the file only; a quoted quote, a bad number, a short line, an empty one
    body = [shipping_line(Order_Id="10", Order_Country='"C, ""I"""'), shipping_line(Order_Id="abc"), "only,2", shipping_line(Sales="")]
    path = os.path.join(tmp_dir, "lines.csv")
    with open(path, "w") as f:
        f.write("\n".join([",".join(f"c{i}" for i in range(53)), *body]) + "\n")
    text = spark.createDataFrame([(i, b) for i, b in enumerate(body)], "n int, line string")
    parsed = ROWS.parse_order_lines(text, "line")
    assert sorted(map(str, parsed.drop("n", "bad").collect())) == sorted(map(str, SRC.read_shipping(spark, path).collect()))
    assert [r.bad for r in parsed.orderBy("n").collect()] == [False, True, True, False]
    nothing = ROWS.parse_order_lines(spark.createDataFrame([(None,), ("",)], "line string"), "line").collect()
    assert len(nothing) == 2 and all(r.order_id is None for r in nothing) and nothing[0].bad
    # feeds
    feeds = ["<rss><channel><item><title>a &amp; b</title><source url='u'>S</source></item><item><link>l</link></item></channel></rss>",
             "<rss><channel><item><title>x", "<rss><channel></channel></rss>", None]
    rows = ROWS.parse_feeds(spark.createDataFrame(list(enumerate(feeds)), "n int, feed string"), "feed").orderBy("n", "item").collect()
    assert [(r.n, r.bad, r["item"], r.title, r.link, r.source) for r in rows] == [
        (0, False, 0, "a & b", "", "S"), (0, False, 1, "", "l", "Unknown"), (1, True, None, None, None, None),
        (2, False, None, None, None, None), (3, True, None, None, None, None)]
    # prices
    docs = ['{"observations":[{"date":"d1","value":"1.5"},{"date":"d2","value":"."},{"date":"d3","value":"x"}]}', '{"observ', None]
    rows = ROWS.parse_prices(spark.createDataFrame(list(enumerate(docs)), "n int, doc string"), "doc").orderBy("n", "date").collect()
    assert [(r.n, r.bad, r.date, r.value) for r in rows] == [
        (0, False, "d1", 1.5), (0, False, "d3", None), (1, True, None, None), (2, True, None, None)]
