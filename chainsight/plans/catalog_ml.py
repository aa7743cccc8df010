"""Model queries.

Metric queries run on a deterministic prediction table derived from the
shipping lines (score = delay / 7, predicted late when the score is
positive), so their SQL twins can check them exactly.  A small model that is stored
with the library scores the test rows and is audited on the training rows, against SQL
that walks its nodes.  Queries that fit a model while they run (``fitted_predictions``,
``fitted_importance``, ``model_metrics``) are checked by row count and by the pytest
suite.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainsight import PIPELINE_VERSION
from chainsight.functions import constants as K
from chainsight.operators import aggregates as G
from chainsight.operators import ml as M
from chainsight.operators import topk as TK
from chainsight.operators import trees as TR
from chainsight.plans import oracle as O
from chainsight.plans import silver as S
from chainsight.plans.catalog import bronze, lines, register, silver

def fixed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic scores for the metric operators (FIXTURES.md: predictions)."""
    score = (F.col("days_real") - F.col("days_scheduled")).cast("double") / F.lit(7.0)
    return lines(spark, sf_dir).select(
        "order_id", "market", F.col("late_delivery_risk").alias("actual_risk"), score.alias("score"),
        F.when(score > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("predicted_risk"),
    ).withColumn("label", F.col("actual_risk").cast("double")).withColumn("prediction", F.col("predicted_risk"))


_PREDS = """
, preds AS (
  SELECT order_id, market, late_delivery_risk AS actual_risk,
         CAST(days_real - days_scheduled AS DOUBLE) / 7.0 AS score,
         CAST(CASE WHEN CAST(days_real - days_scheduled AS DOUBLE) / 7.0 > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS predicted_risk,
         CAST(late_delivery_risk AS DOUBLE) AS label
  FROM lines)
, counts AS (
  SELECT COUNT(*) AS n,
         COUNT(*) FILTER (WHERE label = 1 AND predicted_risk = 1) AS tp,
         COUNT(*) FILTER (WHERE label = 0 AND predicted_risk = 0) AS tn,
         COUNT(*) FILTER (WHERE label = 0 AND predicted_risk = 1) AS fp,
         COUNT(*) FILTER (WHERE label = 1 AND predicted_risk = 0) AS fn
  FROM preds)
, per_score AS (
  SELECT score, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label = 0) AS neg
  FROM preds GROUP BY score)
, auc_frac AS (
  SELECT CAST(SUM(CAST(pos AS HUGEINT) * (2 * neg_below + neg)) AS HUGEINT) AS auc_num2,
         CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives,
         2 * CAST(SUM(pos) AS HUGEINT) * CAST(SUM(neg) AS HUGEINT) AS auc_den2
  FROM (SELECT score, pos, neg,
               COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
        FROM per_score) c)
"""


def _pred_sql(body: str, extra_ctes: tuple[str, ...] = ()) -> str:
    return O.with_ctes("lines", *extra_ctes).rstrip() + _PREDS + body.strip()


# G11 + F14 ------------------------------------------------------------------
@register("accuracy_by_market", _pred_sql(f"""
SELECT market, COUNT(order_id) AS predictions, {O.exact_mean('correct', 1, times=100)} AS accuracy_pct
FROM (SELECT *, CASE WHEN actual_risk = predicted_risk THEN 1 ELSE 0 END AS correct FROM preds) p
GROUP BY market"""))
def q_accuracy_by_market(spark, sf_dir):
    return G.accuracy_by_market(fixed_predictions(spark, sf_dir))


# M9 -------------------------------------------------------------------------
@register("confusion", _pred_sql("""
SELECT label, predicted_risk AS prediction, COUNT(*) AS count FROM preds GROUP BY 1, 2"""))
def q_confusion(spark, sf_dir):
    return M.confusion(fixed_predictions(spark, sf_dir))


# M8 -------------------------------------------------------------------------
@register("accuracy_f1", _pred_sql("""
SELECT CAST(tp + tn AS DOUBLE) / CAST(n AS DOUBLE) AS accuracy,
       (CAST(tn + fp AS DOUBLE) / CAST(n AS DOUBLE)) * COALESCE(CAST(2 * tn AS DOUBLE) / NULLIF(CAST(2 * tn + fn + fp AS DOUBLE), 0), 0.0)
     + (CAST(tp + fn AS DOUBLE) / CAST(n AS DOUBLE)) * COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1,
       n, tp, tn, fp, fn
FROM counts"""))
def q_accuracy_f1(spark, sf_dir):
    return M.accuracy_f1(fixed_predictions(spark, sf_dir))


# M7 -------------------------------------------------------------------------
@register("auc", _pred_sql("""
SELECT CAST(auc_num2 AS DOUBLE) / CAST(auc_den2 AS DOUBLE) AS auc, positives, negatives,
       (SELECT COUNT(*) FILTER (WHERE score IS NULL) FROM preds) AS unscored FROM auc_frac"""))
def q_auc(spark, sf_dir):
    return M.area_under_roc(fixed_predictions(spark, sf_dir), "label", "score")


# G13 ------------------------------------------------------------------------
def _kpi_sql() -> str:
    h = O.half_up_text
    news = "(SELECT news_risk_level FROM news_sum)"
    f1_num = ("((CAST(tn + fp AS HUGEINT)) * 2 * tn * (2 * tp + fp + fn) "
              "+ (CAST(tp + fn AS HUGEINT)) * 2 * tp * (2 * tn + fn + fp))")
    f1_den = ("(CASE WHEN CAST(n AS HUGEINT) * (2 * tn + fn + fp) * (2 * tp + fp + fn) = 0 THEN 1 "
              "ELSE CAST(n AS HUGEINT) * (2 * tn + fn + fp) * (2 * tp + fp + fn) END)")
    rows = [
        ("total_orders", "CAST(COUNT(*) AS VARCHAR)", "silver"),
        ("delayed_orders", "CAST(COUNT(*) FILTER (WHERE is_delayed = 1) AS VARCHAR)", "silver"),
        ("delay_rate_pct", h("COUNT(*) FILTER (WHERE is_delayed = 1) * 100", "COUNT(*)", 1), "silver"),
        ("total_sales_usd", h(O.units("sales"), str(O.TENTHS), 0), "silver"),
        ("total_profit_usd", h(O.units("order_profit"), str(O.TENTHS), 0), "silver"),
        ("avg_delay_days", h("SUM(CAST(delay_days AS BIGINT))", "COUNT(delay_days)", 2), "silver"),
        ("model_auc", h("auc_num2", "auc_den2", 4), "auc_frac"),
        ("model_accuracy", h("tp + tn", "n", 4), "counts"),
        ("model_f1", h(f1_num, f1_den, 4), "counts"),
        ("news_risk_level", news, "silver LIMIT 1"),
        ("news_articles", "(SELECT CAST(articles AS VARCHAR) FROM news_sum)", "silver LIMIT 1"),
        ("pipeline_version", O.q(PIPELINE_VERSION), "silver LIMIT 1"),
    ]
    body = "\nUNION ALL ".join(f"(SELECT {O.q(m)} AS metric, {v} AS value FROM {src})" for m, v, src in rows)
    return _pred_sql(body, ("silver",))


@register("kpi_summary", _kpi_sql())
def q_kpi_summary(spark, sf_dir):
    preds = fixed_predictions(spark, sf_dir)
    # one pass over the predictions feeds both the confusion counts and the AUC
    per = M.score_counts(preds, "label", "score", "prediction")
    metrics = M.exact_metric_strings(M.confusion_from_score_counts(per),
                                     M.auc_fraction(preds, "label", "score", per_score=per))
    b = bronze(spark, sf_dir)
    return G.kpi_summary(S.silver(b, columns=G.COLUMNS["kpi_totals"]), metrics, S.news_summary(b), PIPELINE_VERSION)


# M1 -------------------------------------------------------------------------
def _index_sql(col: str) -> str:
    return O.sql(["silver"], f"""
SELECT {col}, COUNT(*) AS count,
       CAST(row_number() OVER (ORDER BY COUNT(*) DESC, {col}) - 1 AS DOUBLE) AS {col}_idx
FROM silver GROUP BY {col}""")


def _index_query(col: str):
    def run(spark, sf_dir):
        s = silver(spark, sf_dir, [col])
        model = M.indexer([col]).fit(s)
        return model.transform(s.groupBy(col).count())
    return run


register("mode_index", _index_sql("shipping_mode"))(_index_query("shipping_mode"))
register("market_index", _index_sql("market"))(_index_query("market"))


# F12, F13, N3 ---------------------------------------------------------------
_NEWS_CODE = ("CASE " + " ".join(f"WHEN news_risk_level = {O.q(k)} THEN {v}" for k, v in K.NEWS_LEVEL_CODES)
              + f" ELSE {K.NEWS_LEVEL_CODE_DEFAULT} END")
_LPI_CODE = ("CASE " + " ".join(f"WHEN logistics_risk_tier = {O.q(k)} THEN {v}" for k, v in K.LPI_TIER_CODES)
             + f" ELSE {K.LPI_TIER_CODE_DEFAULT} END")


@register("ml_encodings", O.sql(["silver"], f"""
SELECT news_risk_level, logistics_risk_tier, CAST({_NEWS_CODE} AS DOUBLE) AS news_risk_numeric,
       CAST({_LPI_CODE} AS DOUBLE) AS lpi_risk_numeric, COUNT(*) AS count,
       CAST(SUM(CAST(COALESCE(lead_time_days, 14) AS BIGINT)) AS BIGINT) AS lead_time_total,
       {O.decimal_mean('COALESCE(supplier_quality_score, 3.0)', 2)} AS avg_quality
FROM silver GROUP BY 1, 2, 3, 4"""))
def q_ml_encodings(spark, sf_dir):
    cols = ["news_risk_level", "logistics_risk_tier", "lead_time_days", "supplier_quality_score",
            "late_delivery_risk"]
    df = M.model_frame(silver(spark, sf_dir, cols))
    from chainsight.functions.exact import decimal_mean
    return df.groupBy("news_risk_level", "logistics_risk_tier", "news_risk_numeric", "lpi_risk_numeric").agg(
        F.count(F.lit(1)).alias("count"), F.sum(F.col("lead_time_days").cast("long")).alias("lead_time_total"),
        decimal_mean("supplier_quality_score", 2).alias("avg_quality"))


# G14 ------------------------------------------------------------------------
@register("class_balance", O.sql(["silver"], """
SELECT CAST(late_delivery_risk AS DOUBLE) AS label, COUNT(*) AS count FROM silver GROUP BY 1"""))
def q_class_balance(spark, sf_dir):
    return G.class_balance(M.model_frame(silver(spark, sf_dir, ["late_delivery_risk"])))


# M3 -------------------------------------------------------------------------
_FILLS = {"route_delay_rate": "COALESCE(route_delay_rate, 0.5)",
          "route_avg_delay_days": "COALESCE(route_avg_delay_days, 0.0)",
          "weather_risk_score": "COALESCE(weather_risk_score, 1.0)",
          "lpi_score": "COALESCE(lpi_score, 3.0)",
          "supplier_quality_score": "COALESCE(supplier_quality_score, 3.0)",
          "supplier_esg_score": "COALESCE(supplier_esg_score, 3.0)",
          "lead_time_days": "COALESCE(lead_time_days, 14)",
          "news_risk_numeric": _NEWS_CODE, "lpi_risk_numeric": _LPI_CODE}


def _standardize_sql() -> str:
    fills = _FILLS
    sel = ",\n       ".join(f"CAST({fills.get(c, c)} AS DOUBLE) AS {c}" for c in K.FEATURE_COLS
                           if c not in ("shipping_mode_idx", "market_idx"))
    body = f"""
, mode_idx AS (SELECT shipping_mode, row_number() OVER (ORDER BY COUNT(*) DESC, shipping_mode) - 1 AS shipping_mode_idx
               FROM silver GROUP BY shipping_mode)
, market_idx AS (SELECT market, row_number() OVER (ORDER BY COUNT(*) DESC, market) - 1 AS market_idx
                 FROM silver GROUP BY market)
, feats AS (
  SELECT {sel},
         CAST(mi.shipping_mode_idx AS DOUBLE) AS shipping_mode_idx, CAST(ki.market_idx AS DOUBLE) AS market_idx
  FROM silver s JOIN mode_idx mi USING (shipping_mode) JOIN market_idx ki USING (market))
, long AS (UNPIVOT feats ON {', '.join(K.FEATURE_COLS)} INTO NAME feature VALUE v)
, pos AS (SELECT * FROM (VALUES {', '.join(f"({O.q(c)}, {i})" for i, c in enumerate(K.FEATURE_COLS))}) t(feature, position))
SELECT feature, CAST(position AS INTEGER) AS position, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std
FROM long JOIN pos USING (feature) GROUP BY feature, position"""
    return O.with_ctes("silver").rstrip() + body


@register("standardize", _standardize_sql())
def q_standardize(spark, sf_dir):
    from pyspark.ml import Pipeline
    # two estimators (the indexer, the scaler) each make a pass: persist once
    inputs = sorted(set(K.FEATURE_COLS) - set(M.INDEXED.values()) | set(M.INDEXED))
    df = M.model_frame(model_silver(spark, sf_dir)).select(*inputs).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = Pipeline(stages=[*M.indexers(), M.assembler(), M.scaler()]).fit(df)
    finally:
        df.unpersist()
    sc = model.stages[-1]
    rows = [(name, i, float(m), float(s)) for i, (name, m, s) in
            enumerate(zip(K.FEATURE_COLS, sc.mean.toArray(), sc.std.toArray()))]
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("position", T.IntegerType()),
                           T.StructField("mean", T.DoubleType()), T.StructField("std", T.DoubleType())])
    out = spark.createDataFrame(rows, schema)
    return out.select("feature", "position", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


# The fitted model ----------------------------------------
_MODELS: dict[tuple[str, str], PipelineModel] = {}


# Silver columns the model, its split and its prediction table read.
MODEL_INPUT = sorted(set(K.FEATURE_COLS) - {"shipping_mode_idx", "market_idx", "lpi_risk_numeric",
                                             "news_risk_numeric"}
                     | {"shipping_mode", "market", "logistics_risk_tier", "news_risk_level",
                        "late_delivery_risk", "order_country", "order_region", "is_delayed"}
                     | set(M.LINE_KEY))


def model_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir, MODEL_INPUT)


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return M.train_test_split(M.model_frame(model_silver(spark, sf_dir)))


def fitted_model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """Fit once per session and input folder (a fitted model is an artifact,
    like the one ``sinks.save_model`` writes)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        train, _ = split(spark, sf_dir)
        _MODELS[key] = M.fit(spark, train, partitions=spark.sparkContext.defaultParallelism)
    return _MODELS[key]


_IS_TRAIN = (f"CAST('0x' || substr(md5(CAST(order_id AS VARCHAR) || '|' || CAST(line_number AS VARCHAR)), 1, 8) AS BIGINT)"
             f" % 100 < {K.TRAIN_PERCENT}")


@register("split_counts", O.sql(["silver"], f"""
SELECT CASE WHEN {_IS_TRAIN} THEN 'train' ELSE 'test' END AS side, CAST(late_delivery_risk AS DOUBLE) AS label,
       COUNT(*) AS count
FROM silver GROUP BY 1, 2"""))
def q_split_counts(spark, sf_dir):
    df = M.model_frame(model_silver(spark, sf_dir))
    side = F.when(M.split_flag(), F.lit("train")).otherwise(F.lit("test"))
    return df.groupBy(side.alias("side"), "label").count()


_TEST_COLUMNS = [c for c in K.FEATURE_COLS if c not in ("shipping_mode_idx", "market_idx")]


@register("model_test_rows", O.sql(["silver"], f"""
SELECT order_id, line_number, late_delivery_risk AS actual_risk, shipping_mode, market,
       {', '.join(f"CAST({_FILLS.get(c, c)} AS DOUBLE) AS {c}" for c in _TEST_COLUMNS)}
FROM silver WHERE NOT ({_IS_TRAIN})"""))
def q_model_test_rows(spark, sf_dir):
    """Actuals and features of every row that the model is tested on."""
    _, test = split(spark, sf_dir)
    return test.select(*M.LINE_KEY, F.col("late_delivery_risk").alias("actual_risk"), "shipping_mode", "market",
                       *[F.col(c).cast("double").alias(c) for c in _TEST_COLUMNS])


# --- the stored model: five trees of depth three, fitted on the training rows of sf0.001
STORED_MODEL = os.path.join(os.path.dirname(os.path.dirname(__file__)), "models", "risk_small.json")


def stored_model() -> TR.Ensemble:
    return TR.Ensemble.load(STORED_MODEL)


def stored_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with the stored model's category indexes."""
    train, test = split(spark, sf_dir)
    return tuple(TR.with_indexes(df, stored_model(), M.INDEXED) for df in (train, test))


def _walk_sql(side: str, body: str) -> str:
    """Rows of one side with their features as a list, every node that each one reaches in every
    tree (node by node, through the table of nodes), and the margin before each tree."""
    model = stored_model()
    number = {c: f"CAST({_FILLS.get(c, c)} AS DOUBLE)" for c in K.FEATURE_COLS}
    for c, out in M.INDEXED.items():
        whens = " ".join(f"WHEN {O.q(v)} THEN {i}" for i, v in enumerate(model.indexes[c]))
        number[out] = f"CAST(CASE {c} {whens} ELSE {len(model.indexes[c])} END AS DOUBLE)"
    scaled = ", ".join(f"({number[c]} - CAST('{m!r}' AS DOUBLE)) * CAST('{s!r}' AS DOUBLE)"
                       for c, m, s in zip(model.features, model.mean, model.scale))

    def cell(v) -> str:
        return "NULL" if v is None else f"CAST('{v!r}' AS DOUBLE)" if isinstance(v, float) else str(v)
    nodes = ", ".join(f"({n.tree}, {n.node}, {cell(n.left)}, {cell(n.right)}, {cell(n.feature)}, {cell(n.threshold)}, {cell(n.value)})"
                      for n in model.nodes)
    weights = ", ".join(f"({i}, CAST('{w!r}' AS DOUBLE))" for i, w in enumerate(model.weights))
    return O.with_ctes("silver").replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f"""
, nodes AS (SELECT * FROM (VALUES {nodes}) t(tree, node, l, r, feature, threshold, value))
, weights AS (SELECT * FROM (VALUES {weights}) t(tree, weight))
, side AS (
  SELECT *, row_number() OVER () AS rn, CAST(late_delivery_risk AS DOUBLE) AS label, [{scaled}] AS f
  FROM silver WHERE {'' if side == 'train' else 'NOT '}({_IS_TRAIN}))
, walk AS (
  SELECT rn, f, tree, 0 AS node FROM side, weights
  UNION ALL
  SELECT rn, f, w.tree, CASE WHEN f[n.feature + 1] <= n.threshold THEN n.l ELSE n.r END
  FROM walk w JOIN nodes n ON w.tree = n.tree AND w.node = n.node WHERE n.feature IS NOT NULL)
, leaves AS (
  SELECT rn, w.tree, weight * value AS part
  FROM walk w JOIN nodes n ON w.tree = n.tree AND w.node = n.node JOIN weights g ON w.tree = g.tree WHERE n.feature IS NULL)
, margins AS (SELECT rn, SUM(part) AS margin FROM leaves GROUP BY rn)
""" + body.strip()


@register("risk_predictions", _walk_sql("test", """
SELECT order_id, line_number, order_country, order_region, market, shipping_mode, delay_days, is_delayed,
       late_delivery_risk AS actual_risk, CASE WHEN margin > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS predicted_risk,
       round(1 / (1 + exp(-2 * margin)), 6) AS late_probability
FROM side JOIN margins USING (rn)"""))
def q_risk_predictions(spark, sf_dir):
    """Test rows scored by the stored model's expression."""
    _, test = stored_split(spark, sf_dir)
    return TR.score(test, stored_model()).select(
        *M.LINE_KEY, "order_country", "order_region", "market", "shipping_mode", "delay_days", "is_delayed",
        F.col("late_delivery_risk").alias("actual_risk"), F.col("prediction").alias("predicted_risk"),
        F.round("late_probability", 6).alias("late_probability"))


@register("feature_importance", _walk_sql("train", f"""
, before AS (
  SELECT rn, tree, COALESCE(SUM(part) OVER (PARTITION BY rn ORDER BY tree ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS margin
  FROM leaves)
, targets AS (
  SELECT rn, tree, CASE WHEN tree = 0 THEN y ELSE 4 * y / (1 + exp(2 * y * margin)) END AS target
  FROM before JOIN (SELECT rn, CASE WHEN label = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y FROM side) s USING (rn))
, sums AS (
  SELECT tree, node, COUNT(*) AS n, SUM(target * target) - SUM(target) * SUM(target) / COUNT(*) AS spread
  FROM walk JOIN targets USING (rn, tree) GROUP BY tree, node)
, gains AS (
  SELECT d.feature, s.spread - COALESCE(a.spread, 0) - COALESCE(b.spread, 0) AS weight
  FROM nodes d JOIN sums s ON d.tree = s.tree AND d.node = s.node
  LEFT JOIN sums a ON d.tree = a.tree AND d.l = a.node LEFT JOIN sums b ON d.tree = b.tree AND d.r = b.node
  WHERE d.feature IS NOT NULL)
SELECT name AS feature, round(COALESCE(SUM(weight), 0) / (SELECT SUM(weight) FROM gains), 6) AS importance
FROM (SELECT unnest([{', '.join(map(O.q, K.FEATURE_COLS))}]) AS name, unnest(range(0, {len(K.FEATURE_COLS)})) AS feature) f
LEFT JOIN gains USING (feature) GROUP BY name ORDER BY importance DESC, name LIMIT {K.TOP_K}"""))
def q_feature_importance(spark, sf_dir):
    """M10 + T6, from the gains that the stored model's splits have on the training rows."""
    train, _ = stored_split(spark, sf_dir)
    gains = TR.node_gains(TR.node_statistics(train, stored_model()), stored_model())
    shares = TR.importances(gains).select("feature", F.round("importance", 6).alias("importance"))
    return TK.top_importances(shares, K.TOP_K)


_INDEX_WHENS = {out: "CAST(CASE {} {} ELSE {} END AS DOUBLE)".format(
    c, " ".join(f"WHEN {O.q(v)} THEN {i}" for i, v in enumerate(stored_model().indexes[c])), len(stored_model().indexes[c]))
    for c, out in M.INDEXED.items()}


@register("split_gains", O.with_ctes("silver").rstrip() + f"""
, feats AS (
  SELECT CAST(late_delivery_risk AS BIGINT) AS late,
         {', '.join(f"CAST({_INDEX_WHENS.get(c) or _FILLS.get(c, c)} AS DOUBLE) AS {c}" for c in K.FEATURE_COLS)}
  FROM silver WHERE {_IS_TRAIN})
, long AS (UNPIVOT feats ON {', '.join(K.FEATURE_COLS)} INTO NAME feature VALUE v)
, placed AS (
  SELECT feature, late, v, min(v) OVER (PARTITION BY feature) AS lo, max(v) OVER (PARTITION BY feature) AS hi FROM long)
, cells AS (
  SELECT feature, CAST(least(floor((v - lo) / (hi - lo) * 1024), 1023) AS INTEGER) AS cell,
         COUNT(*) AS n, SUM(late) AS p, min(v) AS low, max(v) AS high
  FROM placed WHERE hi > lo GROUP BY 1, 2)
, sums AS (
  SELECT feature, high, lead(low) OVER o AS next, CAST(SUM(n) OVER o AS DOUBLE) AS n, CAST(SUM(p) OVER o AS DOUBLE) AS p,
         CAST(SUM(n) OVER (PARTITION BY feature) AS DOUBLE) AS m, CAST(SUM(p) OVER (PARTITION BY feature) AS DOUBLE) AS q
  FROM cells WINDOW o AS (PARTITION BY feature ORDER BY cell))
, cuts AS (
  SELECT feature, (high + next) / 2 AS threshold, n, m,
         (4 * q * (m - q) / m - 4 * p * (n - p) / n - 4 * (q - p) * ((m - n) - (q - p)) / (m - n)) / m AS gain
  FROM sums WHERE next IS NOT NULL)
SELECT feature, round(threshold, 6) AS threshold, round(gain, 6) AS gain, CAST(n AS BIGINT) AS left_rows, CAST(m - n AS BIGINT) AS right_rows
FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, threshold) AS place FROM cuts) c WHERE place = 1""")
def q_split_gains(spark, sf_dir):
    """M5: the best first split of every feature, from the training rows' histogram."""
    train, _ = stored_split(spark, sf_dir)
    return TR.split_gains(TR.split_histogram(train)).select(
        "feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 6).alias("gain"), "left_rows", "right_rows")


# --- a model fitted while the query runs
@register("fitted_predictions")
def q_fitted_predictions(spark, sf_dir):
    _, test = split(spark, sf_dir)
    return M.predictions_table(fitted_model(spark, sf_dir), test)


@register("fitted_importance")
def q_fitted_importance(spark, sf_dir):
    return TK.top_importances(M.feature_importances(spark, fitted_model(spark, sf_dir)), K.TOP_K)


@register("model_metrics")
def q_model_metrics(spark, sf_dir):
    _, test = split(spark, sf_dir)
    pred = M.predictions_table(fitted_model(spark, sf_dir), test) \
        .withColumn("label", F.col("actual_risk").cast("double"))
    # a row for each score, kept so that the test rows are scored once for all three readers of it
    per = M.score_counts(pred, "label", "late_probability", "predicted_risk").persist(StorageLevel.MEMORY_AND_DISK)
    acc = M.accuracy_f1(pred, "label", "predicted_risk", per_score=per).select("accuracy", "f1", "n")
    auc = M.area_under_roc(pred, "label", "late_probability", per_score=per).select("auc").scalar()
    return acc.withColumn("auc", auc)
