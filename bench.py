"""Benchmark: headline queries and the model fit on one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3).
Prints one JSON line; per-query values are medians in seconds.  Each run
executes the full plan (scan to result) into Spark's no-op sink, with the
session's cache cleared before every run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "market_kpi", "route_risk", "supplier_leaderboard", "top_routes_excl", "mode_performance",
    "kpi_totals", "kpi_summary", "route_stats", "weather_by_state", "join_coverage", "dq_shipping",
    "dq_silver", "news_level", "commodity_shock", "latest_prices", "auc", "accuracy_f1",
    "accuracy_by_market", "standardize",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    from chainsight.session import local_session
    from chainsight.plans import catalog, catalog_ml
    from chainsight.operators import ml as M

    spark = local_session(cpus, app="chainsight-bench", shuffle_partitions=int(cpus))
    qs = catalog.queries()

    def run(name: str) -> float:
        spark.catalog.clearCache()
        t = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    results: dict[str, float] = {}
    for name in HEADLINE:
        run(name)  # warm-up
        results[name] = round(statistics.median(run(name) for _ in range(runs)), 3)

    # Model fit (pipeline: indexers, assembler, scaler, GBT 50 x depth 5) on the training split.
    spark.catalog.clearCache()
    train, _ = catalog_ml.split(spark, sf_dir)
    train_rows = train.count()

    def fit() -> float:
        spark.catalog.clearCache()
        t = time.perf_counter()
        M.fit(spark, train, partitions=int(cpus))
        return time.perf_counter() - t

    results["gbt_fit"] = round(statistics.median(fit() for _ in range(runs)), 3)

    total = round(sum(results.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_plus_gbt_fit_total", "value": total, "unit": "sec",
        "queries": results, "sf": sf, "cpus": int(cpus), "runs": runs,
        "gbt_train_rows": train_rows, "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
