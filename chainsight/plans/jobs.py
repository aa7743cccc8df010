"""The pipeline's jobs: bronze ingest, silver build, model, gold marts.

Each job is one lazy plan and one write per output table.  Run on the test
tables with::

    python -m chainsight.plans.jobs --test-tables /root/testdata/sf0.01 --out /shared/run1

or on landed raw files with::

    python -m chainsight.plans.jobs --out /shared/run1 --shipping-csv orders.csv \
        --storm-csv storms_2022.csv.gz storms_2023.csv.gz --news-dir news/ --prices-dir prices/ \
        --country-scores-csv lpi.csv --suppliers suppliers/

On a cluster ``--out`` must be a shared folder; checkpoints go to the
folder the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chainsight.functions import constants as K
from chainsight.operators import aggregates as G
from chainsight.operators import joins as J
from chainsight.operators import ml as M
from chainsight.operators import quality as Q
from chainsight.operators.windows import first_per_key
from chainsight.plans import silver as S
from chainsight.run import RunContext
from chainsight.sinks import writers as W
from chainsight.sources import files as SRC


@dataclass
class RawInputs:
    """Landed raw files of one run."""

    shipping_csv: str
    storm_csv: list[str]
    news_dir: str
    prices_dir: str
    country_scores_csv: str
    suppliers: str
    suppliers_fmt: str = "parquet"


class NullInRequiredColumn(ValueError):
    pass


def require_suppliers(suppliers: DataFrame) -> None:
    """Raise if a supplier column declared NOT NULL holds a null (one pass)."""
    found = SRC.supplier_null_check(suppliers).first().asDict()
    bad = {c: n for c, n in found.items() if c != "rows" and n}
    if bad:
        raise NullInRequiredColumn(f"suppliers: {bad}")


def report(df: DataFrame, out: str, name: str, fmt: str = "parquet") -> None:
    """A small quality or model report under ``<out>/reports``."""
    W.overwrite(df, f"{out}/reports/{name}", fmt)


def bronze_job(spark: SparkSession, raw: RawInputs, out: str, fmt: str = "parquet",
               drop_columns: Sequence[str] = (), run: RunContext | None = None) -> dict[str, int]:
    """Read every raw source once, write the six bronze tables and the quality
    reports on them.  ``drop_columns``: order-line columns not to store."""
    run = run or RunContext()
    tables = {
        "shipping_events": SRC.shipping_bronze(SRC.read_shipping_raw(spark, raw.shipping_csv), drop_columns, run),
        "weather_events": SRC.read_weather(spark, raw.storm_csv, run),
        "news_disruptions": first_per_key(SRC.read_news(spark, raw.news_dir, run=run), ["title"], ["feed_order"]),
        "commodity_prices": SRC.read_commodity(spark, raw.prices_dir, run=run),
        "supplier_risk": SRC.read_country_scores(spark, raw.country_scores_csv, run),
        "supplier_master": SRC.read_suppliers(spark, raw.suppliers, raw.suppliers_fmt, run),
    }
    # commodity and supplier tables keep their schema across runs (K2)
    schema_guarded = {"commodity_prices", "supplier_master"}
    require_suppliers(tables["supplier_master"])
    counts = {}
    for name, df in tables.items():
        path = f"{out}/bronze/{name}"
        counts[name] = W.write_counted(df, path, fmt, same_schema_as=spark if name in schema_guarded else None)
        W.log_run(spark, f"{out}/run_log", "bronze", path, "WRITE", counts[name], run.version, run)
    bronze = bronze_from_paths(spark, out, fmt)
    report(Q.shipping_check(bronze.shipping), out, "dq_shipping", fmt)
    report(Q.weather_check(bronze.weather), out, "dq_weather", fmt)
    report(Q.series_profile(bronze.commodity), out, "series_profile", fmt)
    return counts


def bronze_from_paths(spark: SparkSession, out: str, fmt: str = "parquet", **params) -> S.BronzeTables:
    """Bronze role tables read back from a bronze folder."""
    read = lambda n: spark.read.format(fmt).load(f"{out}/bronze/{n}")
    shipping = read("shipping_events")
    if "Order_Id" in shipping.columns:
        shipping = SRC.shipping_roles(shipping)
    return S.BronzeTables(shipping=shipping, suppliers=read("supplier_master"),
                          country_scores=read("supplier_risk"), weather=read("weather_events"),
                          commodity=read("commodity_prices"), news=read("news_disruptions"), **params)


def shipping_enriched_job(spark: SparkSession, shipping: DataFrame, out: str, fmt: str = "parquet") -> str:
    """Side table: shipping lines plus F1-F4, overwritten only with an
    unchanged schema (K2).  Nothing downstream reads it; silver derives the
    same features itself."""
    path = f"{out}/silver/shipping_enriched"
    W.overwrite_same_schema(spark, S.shipping_features(shipping), path, fmt)
    return path


class RowParityError(RuntimeError):
    pass


def silver_job(spark: SparkSession, bronze: S.BronzeTables, out: str, fmt: str = "parquet",
               table: str | None = None, run: RunContext | None = None) -> int:
    """Build silver in one plan and write it partitioned by market (K3).

    Q6, J6: the lines that enter the enrichment joins, those that leave each of them
    and those that found a match there are counted during the write.  Every join is a
    left join on a unique key, so all counts of lines must be equal; where they aren't, a
    side with a repeated key multiplied lines, and the job fails, naming the join and a
    key.  The table is written beside the current one and put in its place only after
    that check (K4); the counts are the report ``join_lines``.

    ``table``: a catalogue name to publish under.  Then each run writes a version of its own
    beside the others, and the name is switched to it in one step, so that readers of the
    name find a table at any time; without it the table's folder is replaced by renames.
    """
    run = run or RunContext()
    seen = Observation("silver_input")
    joins = {name: Observation(f"silver_{name}") for name in S.JOINS}
    df = S.with_lineage(S.silver(bronze, lines_seen=seen, joins_seen=joins), run)
    path = f"{out}/silver/supply_chain_master"
    staged = W.new_version(path) if table else f"{path}.new"
    rows = W.write_counted(df, staged, fmt, partition_by="market")
    counts = J.join_report(spark, int(seen.get["rows"]), joins)
    for step in counts.collect():  # one row a join
        if step.lines_after != step.lines_before:
            side, keys, _ = S.join_sides(bronze)[step.join_name]
            twice = J.duplicate_keys(side, keys[0]).first() if len(keys) == 1 else None
            key = "" if twice is None else f": {twice[0]!r} occurs {twice[1]} times"
            raise RowParityError(f"silver, join {step.join_name}: {step.lines_before} lines in, {step.lines_after} out{key}")
    if int(seen.get["rows"]) != rows:
        raise RowParityError(f"silver: {seen.get['rows']} lines in, {rows} rows out")
    if table:
        W.switch(spark, table, staged, fmt)
        W.drop_old_versions(spark, path, staged)
    else:
        W.publish(spark, staged, path)
    written = spark.table(table) if table else spark.read.format(fmt).load(path)
    report(Q.silver_check(written), out, "dq_silver", fmt)
    report(counts, out, "join_lines", fmt)
    W.log_run(spark, f"{out}/run_log", "silver", path, "WRITE", rows, run.version, run)
    return rows


def model_job(spark: SparkSession, silver: DataFrame, out: str, fmt: str = "parquet",
              params: dict | None = None, exclude: Sequence[str] = (), partitions: int | None = None,
              route_rates: str = "all", run: RunContext | None = None) -> DataFrame:
    """Fit on the training split, write scored test rows by market, save the
    model, return the one-row metrics frame (AUC, accuracy, F1), which is written
    too, with the confusion counts, the importances and the accuracy by market.

    ``exclude`` leaves features out, such as those that the label is derived from;
    ``partitions`` is passed to ``ml.fit``.  ``route_rates="train"`` takes the route
    features from training rows alone, and each training row's from the other folds."""
    run = run or RunContext()
    if route_rates not in ("all", "train"):
        raise ValueError(route_rates)
    features = [c for c in K.FEATURE_COLS if c not in set(exclude)]
    if route_rates == "train":
        silver = M.train_only_route_rates(silver)
    train, test = M.train_test_split(M.model_frame(silver))
    model = M.fit(spark, train, features, params=params, partitions=partitions)
    pred = (M.predictions_table(model, test)
            .withColumn("_gold_processed_at", run.stamp())
            .withColumn("_model_version", F.lit(K.MODEL_VERSION)))
    path = f"{out}/gold/risk_predictions"
    rows = W.write_counted(pred, path, fmt, partition_by="market")
    W.log_run(spark, f"{out}/run_log", "model", path, "WRITE", rows, K.MODEL_VERSION, run)
    W.save_model(model, f"{out}/gold/model/gbt_risk_classifier")
    written = spark.read.format(fmt).load(path)
    report(M.confusion(written, "actual_risk", "predicted_risk"), out, "confusion", fmt)
    report(M.feature_importances(spark, model, features), out, "feature_importance", fmt)
    report(G.accuracy_by_market(written), out, "accuracy_by_market", fmt)
    report(model_metrics(written), out, "model_metrics", fmt)
    return spark.read.format(fmt).load(f"{out}/reports/model_metrics")


def model_metrics(predictions: DataFrame) -> DataFrame:
    """Text metrics (4 places) of a prediction table, for the KPI summary."""
    pred = predictions.withColumn("label", F.col("actual_risk").cast("double"))
    per = M.score_counts(pred, "label", "late_probability", "predicted_risk")
    counts = M.confusion_from_score_counts(per, "predicted_risk")
    frac = M.auc_fraction(pred, "label", "late_probability", per_score=per)
    return M.exact_metric_strings(counts, frac)


def gold_job(spark: SparkSession, silver: DataFrame, metrics: DataFrame, news: DataFrame, out: str,
             fmt: str = "parquet", run: RunContext | None = None) -> dict[str, int]:
    """Market, route, supplier and mode marts plus the KPI summary (all computed);
    ``metrics`` is what ``model_job`` returned."""
    run = run or RunContext()
    stamp = run.stamp()
    marts = {
        "market_dashboard": G.market_kpi(silver).withColumn("_processed_at", stamp),
        "route_risk": G.route_risk(silver).withColumn("_processed_at", stamp),
        "supplier_leaderboard": G.supplier_leaderboard(silver).withColumn("_processed_at", stamp),
        "mode_performance": G.mode_performance(silver).withColumn("_processed_at", stamp),
        "kpi_summary": G.kpi_summary(silver, metrics, news, run.version),
    }
    counts = {}
    for name, df in marts.items():
        path = f"{out}/gold/{name}"
        counts[name] = W.write_counted(df, path, fmt)
        W.log_run(spark, f"{out}/run_log", "gold", path, "WRITE", counts[name], run.version, run)
    return counts


def run_on_test_tables(spark: SparkSession, sf_dir: str, out: str) -> dict[str, object]:
    """Silver -> model -> gold over the shared test tables."""
    from chainsight.plans.catalog import bronze as test_bronze

    b = test_bronze(spark, sf_dir, with_product=True)
    run = RunContext()
    result: dict[str, object] = {"silver_rows": silver_job(spark, b, out, run=run)}
    silver = spark.read.parquet(f"{out}/silver/supply_chain_master")
    metrics = model_job(spark, silver, out, run=run)
    result["model_metrics"] = metrics.first().asDict()
    result["gold"] = gold_job(spark, silver, metrics, S.news_summary(b), out, run=run)
    return result


def run_on_raw_files(spark: SparkSession, raw: RawInputs, out: str, params: dict | None = None) -> dict[str, object]:
    """Raw files -> bronze -> silver -> model -> gold, each stage reading the
    table the previous one wrote."""
    run = RunContext()  # one time and id for all tables
    result: dict[str, object] = {"bronze": bronze_job(spark, raw, out, run=run)}
    b = bronze_from_paths(spark, out)
    result["silver_rows"] = silver_job(spark, b, out, run=run)
    silver = spark.read.parquet(f"{out}/silver/supply_chain_master")
    metrics = model_job(spark, silver, out, params=params, run=run)
    result["model_metrics"] = metrics.first().asDict()
    result["gold"] = gold_job(spark, silver, metrics, S.news_summary(b), out, run=run)
    return result


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--out", required=True)
    p.add_argument("--test-tables", help="folder of the shared test tables")
    p.add_argument("--shipping-csv")
    p.add_argument("--storm-csv", nargs="+")
    p.add_argument("--news-dir")
    p.add_argument("--prices-dir")
    p.add_argument("--country-scores-csv")
    p.add_argument("--suppliers")
    p.add_argument("--suppliers-fmt", default="parquet")
    args = p.parse_args(argv)
    # master, memory and partitions are spark-submit's
    spark = SparkSession.builder.appName("chainsight-jobs").getOrCreate()
    if args.test_tables:
        print(run_on_test_tables(spark, args.test_tables, args.out))
        return
    raw = RawInputs(shipping_csv=args.shipping_csv, storm_csv=args.storm_csv, news_dir=args.news_dir,
                    prices_dir=args.prices_dir, country_scores_csv=args.country_scores_csv,
                    suppliers=args.suppliers, suppliers_fmt=args.suppliers_fmt)
    print(run_on_raw_files(spark, raw, args.out))


if __name__ == "__main__":
    main()
